"""Tables kept up to date by streams of landed files; every run drains what has landed and ends."""

import sys

from pyspark import cloudpickle

# The keyed state travels to the Python workers with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
