"""Operators for training-data pipelines, one module each.

Nothing else in the library imports this subpackage; ``catalog`` holds the
registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# in-task helpers travel with the tasks: executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
