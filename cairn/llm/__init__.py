"""Operators for large text corpora (training-data pipelines).

One module per operator, ``queries`` with the registered queries and ``oracles`` with their
SQL twins. Nothing outside this subpackage imports it. Functions that run inside Python
workers are pickled by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
