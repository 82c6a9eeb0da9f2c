"""Training-data operators for large document tables.

Functions that run inside Spark tasks are shipped by value, so executors need
only the libraries they import (numpy, pyarrow, xxhash, tokenizers), not this
package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
