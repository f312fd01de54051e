"""Operators for training-data preparation on Spark.

Nothing else in the library imports this subpackage; ``queries.py`` holds its
registered queries. Functions that run in tasks travel with their code.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
