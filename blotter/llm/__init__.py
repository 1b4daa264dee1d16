"""Operators for preparing language-model training text.

Every operator is a function on DataFrames; ``catalog`` registers one query
per operator. Python functions run on executors travel with the job (pickled
by value), so a cluster needs no copy of this package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
