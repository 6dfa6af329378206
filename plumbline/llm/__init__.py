"""Operators of a training-data pipeline over documents, pages and embeddings.

Functions that run inside tasks are sent to the executors with the job, so the package need not
be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
