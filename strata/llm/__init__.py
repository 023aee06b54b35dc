"""Operators for preparing language-model training corpora.

Nothing else in the library imports this package.  Its functions run inside
Python workers, so they travel with the job by value: executors need numpy
and pyarrow, but no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
