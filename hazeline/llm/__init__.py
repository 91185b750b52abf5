"""Operators for preparing training corpora, each with a registered query.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries when it is there.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
