"""tierwise: a layered (bronze / silver / gold) sales pipeline on Spark.

Every operator is a function from DataFrame(s) to DataFrame. Nothing is
collected to the driver; every plan is declared with the DataFrame API so
Catalyst can prune columns, push filters and pick join strategies.
"""

from tierwise.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
