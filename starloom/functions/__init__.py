"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from starloom.functions.scalar import (  # noqa: F401
    STATE_NAMES,
    bin_right_closed,
    composite_key,
    is_weekend,
    item_text,
    map_with_passthrough,
    month_start,
    null_if_in,
    safe_bigint,
    safe_double,
    weekday_name,
)
