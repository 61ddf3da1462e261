"""adtally — ad-event metrics on Spark: partner billing with excess-click
fraud split out, partner-group metrics per 5 minutes, display metrics, with
a dead letter for malformed events; batch and Structured Streaming forms
share the same pipeline functions."""

__version__ = "0.1.0"
