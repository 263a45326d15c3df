"""Training-data operators: fingerprints, near-duplicates, archives, mixing,
repeated passages, training order, licences, toxicity, decontamination and
secrets.  Nothing outside this package imports it.

The functions that run inside tasks are sent to the workers by value, so the
executors need the libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
