"""Custom operators composed from DataFrame primitives."""

from ballotlens.operators.latest import asof_latest, latest_by  # noqa: F401
from ballotlens.operators.ranges import count_active_per_epoch  # noqa: F401
