"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from ballotlens.functions.core import (  # noqa: F401
    epoch_seconds,
    seconds_between,
    json_num,
    parse_json_strings,
    ratio,
    pct,
    asc_last,
)
