"""Training-data operators: deduplication, quality, licences, chat logs, language-model scores and mixing.

One module per operator, each a ``DataFrame -> DataFrame`` function with its own parameters.
``queries.py`` applies them to the given tables; ``oracles.py`` holds the SQL that checks them.
Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers whole, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
