"""Listing change capture and normalisation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Arrow functions travel to the executors with their code, so a cluster needs
# no copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
