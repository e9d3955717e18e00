"""Training-data operators over whole text tables.

Each module holds one operator with its general interface; ``queries`` holds
the thin ``opN_<name>`` registry entries and ``oracle`` their DuckDB SQL.
Nothing outside this subpackage imports it (``__spark_entry__.py`` adds its
queries only when it is present).
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
