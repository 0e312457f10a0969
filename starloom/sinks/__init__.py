"""Sinks (inventory K1-K4): table writes, delimited exports, rule output."""

from starloom.sinks.tables import (  # noqa: F401
    open_warehouse,
    read_warehouse,
    write_csv,
    write_rules,
    write_warehouse,
)
