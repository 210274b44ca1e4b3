"""Training-data operators: the thirteen numbered operators, their queries and shared helpers.

Functions of this package travel to the executors with the task, so no executor has to have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
