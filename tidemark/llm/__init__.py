"""Operators for preparing training text: mixing, quality, near duplicates, fingerprints, extraction, packing.

Nothing else in the library imports this folder. Every operator takes DataFrames and returns DataFrames; its module
docstring says what it does with nulls, empty and long texts, ties, repeated rows and empty tables. Columns that an
operator doesn't need are never read, so extra columns and clashing names do no harm.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
