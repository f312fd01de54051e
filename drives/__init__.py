"""Registered queries: every operator on the provided tables, with its check in SQL.

Dirty inputs are built from clean columns of whole tables inside the query, so
the SQL can state the expected result from the clean columns.
"""

import sys

from pyspark import cloudpickle

from drives import cells, changes, offers, pages, runs  # noqa: F401
from drives.registry import ORACLES, QUERIES

# Functions handed to Spark travel with their code, whatever the workers can import.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLES", "QUERIES"]
