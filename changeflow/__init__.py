"""changeflow — change-data-capture decoding and order analytics on Spark.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark SQL built-ins, so the same code serves batch tables and streams.
"""

from changeflow.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
__version__ = "0.1.0"
