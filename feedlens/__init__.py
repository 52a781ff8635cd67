"""feedlens: message-listening analytics as PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from feedlens.schema import MESSAGE_COLUMNS, MESSAGE_SCHEMA, to_messages
from feedlens.session import build_session, scratch_dir

# functions of this package travel to the executors whole, so it need not be
# installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "MESSAGE_COLUMNS",
    "MESSAGE_SCHEMA",
    "build_session",
    "scratch_dir",
    "to_messages",
]
