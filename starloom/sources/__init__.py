"""Sources: driver tables, delimited files with preambles, order capture."""

from starloom.sources.tables import table_path  # noqa: F401
from starloom.sources.delimited import (  # noqa: F401
    header_record,
    read_sheet_csv,
    read_trimmed_csv,
)
from starloom.sources.records import quoted_records  # noqa: F401
