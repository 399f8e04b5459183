"""Claim-evidence analytics on Spark: labelled pairs, features, classifiers and evidence search."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no copy of the
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
