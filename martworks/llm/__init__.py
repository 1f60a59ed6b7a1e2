"""Operators for preparing training corpora, each over whole tables."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions travel with the tasks that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
