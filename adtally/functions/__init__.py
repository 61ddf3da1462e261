"""Subpackage of adtally."""
