"""Operators for preparing large text collections, and their queries.

Nothing outside this package and ``corpus_pipeline.py`` imports it. Its functions
travel to the workers by value, so that these need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
