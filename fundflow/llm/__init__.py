"""Training-data operators: language ID, URL reputation, exact and near
duplicates, mixing, embedding duplicates, quality, sharding, packing, chat
formatting, token alignment, whitening and personal data.  Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
