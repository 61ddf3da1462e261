"""Operators for a training-data pipeline (token output, LM scoring, crawl
revisits, decontamination, classifiers, fingerprints, deduplication, mixing).

Nothing else in the library imports this package. Functions that run inside
Python workers are pickled by value, so executors need no installed copy.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(sys.modules[__name__])
