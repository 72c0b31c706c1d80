"""Operators of a large-scale training-data pipeline, as Spark jobs.

Nothing outside this package imports it. Functions that run in Python workers
are shipped by value, so workers need Spark and the listed libraries only, not
this package on their path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
