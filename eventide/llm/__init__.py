"""Operators of a large-scale training-data pipeline.

Self-contained: nothing else in the library imports this subpackage.  The
registered queries are in ``queries.py``; ``corpus_pipeline.py`` at the top of
the repository chains some of the operators.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the workers by value, so that a
# cluster needs no copy of the library on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
