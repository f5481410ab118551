"""quire: an incremental content-feed pipeline expressed as Spark jobs.

Feeds, items, rule sets, caches and run history are DataFrames; every step is a
table-in / table-out function whose logical plan Catalyst optimises.
"""

from quire.session import get_session, checkpoint_dir, state_dir

__all__ = ["get_session", "checkpoint_dir", "state_dir"]
