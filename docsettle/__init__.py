"""Documents to bookkeeping tables, as Spark jobs over many documents at once."""

import sys

from pyspark import cloudpickle

# the workbook scan travels to the executors with the job, which need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
