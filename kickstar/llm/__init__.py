"""Operators for preparing training data: archives, licences, quality rules, URL rules,
mixing, decontamination, near-duplicate joins, token files, line deduplication and
token-count rollups. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
