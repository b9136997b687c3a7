"""Training-data operators: cleaning, de-duplication, decontamination, formatting and encoding of text corpora."""
import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel with the query, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
