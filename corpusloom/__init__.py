"""Spark-native curation of web text for language-model training."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so a
# cluster does not need the package installed on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
