"""millrace: PySpark-native operators for turning unreliable records into trustworthy tables."""

import sys

from pyspark import cloudpickle

# Executors get our functions with the task, so that nothing has to be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
