"""paperloom: build, clean, check and query archives of documents with Spark."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the task, so executors need
# pyarrow and numpy but no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
