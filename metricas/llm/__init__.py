"""Operators for preparing training data: deduplication, packing, tokenising,
personal data, language identification, nearest neighbours and web archives.

Nothing outside this subpackage imports it. Functions that Spark ships to its
executors are pickled by value, so the executors need numpy, pyarrow and the
tokenizer libraries, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
