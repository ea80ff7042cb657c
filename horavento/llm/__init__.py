"""Operators of a large-scale training-data pipeline (text, vectors, pages).

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries only if it can be imported.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel with the task: executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
