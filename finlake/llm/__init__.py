"""Operators of a training-data pipeline (near-duplicates, decontamination, packing, ...).

Nothing else in the library imports this subpackage. The functions that run
inside tasks travel with the job (pickled by value), so executors need the
third-party packages but not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
