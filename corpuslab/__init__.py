"""corpuslab: text-corpus features, entity labelling, model evaluation,
request-log analytics and vector compression as PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# What runs in Python workers travels with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
