"""Registered queries over the given tables, each with its SQL counterpart."""

import sys

from pyspark import cloudpickle

from catalogue.registry import oracle_sql, queries

# as for the package itself: the executors need no copy of the workbook writer
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["oracle_sql", "queries"]
