"""review_topics: review intents and topic modelling as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
