"""Training-data operators: mixing, toxicity, near-duplicates, quality cutoffs,
packing, line deduplication, token histograms, URL rules, personal data and
embedding links.

Nothing else in the library imports this package. Functions that run inside
Spark tasks are pickled by value, so executors need numpy, pyarrow and the
small text libraries, but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
