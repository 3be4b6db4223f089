"""Training-data operators: scoring, packing, tokenizing, sampling, duplicate
removal, quality, licence and toxicity rules over text tables.

Functions that run inside Spark tasks are pickled by value, so executors need
no copy of this package on their path. What a task uses must therefore not reach
code outside this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
