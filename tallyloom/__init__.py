"""Spark-native curation of labelled image/text tables and scoring of generated answers."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
