"""Training-data operators: quality, deduplication, scoring, filtering and mixing.

Nothing else in the library imports this package.  Task functions are pickled by
value, so executors need only numpy, pyarrow and the public libraries named in the
README, not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
