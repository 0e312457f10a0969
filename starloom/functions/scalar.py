"""Scalar column functions for conforming and keying (inventory C1-C22).

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference for identical results):
# state code -> state name; codes not listed pass through unchanged.
STATE_NAMES = {
    "NSW": "New South Wales",
    "VIC": "Victoria",
    "QLD": "Queensland",
    "SA": "South Australia",
    "WA": "Western Australia",
    "TAS": "Tasmania",
    "NT": "Northern Territory",
    "ACT": "Australian Capital Territory",
}

# Cell texts that mean "missing" in the rule-mining input.
MISSING_TOKENS = ("-9", "nan", "None", "Unknown", "Undetermined")

# Speed bins (right-closed) and their labels.
SPEED_EDGES = (0, 60, 80, 100, 200)
SPEED_LABELS = ("Low", "Medium", "High", "Very High")

WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_with_passthrough(col: str | Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary lookup; keys not in the map keep their own value."""
    if not mapping:
        return _c(col)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, _c(col)), _c(col))


def null_if_in(col: str | Column, values: Iterable) -> Column:
    """Replace whole-cell sentinel values by null."""
    c = _c(col)
    vals = list(values)
    return F.when(~c.isin(vals) | c.isNull(), c)


def safe_bigint(col: str | Column) -> Column:
    """C14+C15: ``to_numeric(errors='coerce')`` then nullable integer.

    Text that does not parse (``<40``) becomes null instead of raising under
    ANSI mode; ``'100.0'`` parses (via double) to 100.
    """
    return _try_double(_c(col)).try_cast("bigint")


def _try_double(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def safe_double(col: str | Column) -> Column:
    """``to_numeric(errors='coerce')``: unparseable text becomes null."""
    return _try_double(_c(col))


def bin_right_closed(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """C20: ``pd.cut`` semantics: bins (e0,e1], (e1,e2], ...; values at or below
    the first edge, above the last edge, or null become null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    c = _c(col)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def composite_key(*cols: str | Column, sep: str = "_", null_text: str = "nan") -> Column:
    """``f"{a}_{b}_{c}_{d}".replace(" ", "_")``.

    A null renders as ``nan`` (pandas formatting), so neither ``concat``
    (null-propagating) nor plain ``concat_ws`` (null-skipping) is used.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null_text)) for c in cols]
    return F.replace(F.concat_ws(sep, *parts), F.lit(" "), F.lit("_"))


def month_start(year: str | Column, month: str | Column) -> Column:
    """``Year-Month-01`` as a date."""
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1))


def weekday_name(date: str | Column) -> Column:
    """English weekday name (``Monday`` ... ``Sunday``), looked up: formatting a date takes longer. Only dates
    are: under ANSI mode ``element_at`` of a null index is no null."""
    name = F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(_c(date)))
    return F.when(_c(date).isNotNull(), name)


def is_weekend(date: str | Column) -> Column:
    """Saturday or Sunday (``dayofweek``: Sunday=1, Saturday=7)."""
    return F.dayofweek(_c(date)).isin(1, 7)


def item_text(feature: str, col: str | Column) -> Column:
    """``feature=value`` item text; null stays null."""
    return F.concat(F.lit(f"{feature}="), _c(col).cast("string"))
