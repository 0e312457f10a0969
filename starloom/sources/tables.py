"""Paths of the driver's Parquet tables; scans select their own columns."""

from __future__ import annotations


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"
