"""Column builders: metrics (SC-*, AGG-2, MET-1), name flattening, keys, row index."""

from adlake.functions.metrics import *  # noqa: F401,F403
from adlake.functions.names import flatten_names  # noqa: F401
from adlake.functions.keys import surrogate_key, date_key  # noqa: F401
