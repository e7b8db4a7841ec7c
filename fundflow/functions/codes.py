"""Code-table lookups, built as CASE expressions from the fixed pairs.

The tables are a dozen entries, so a CASE chain is the cheapest plan: it
stays inside whole-stage codegen and needs no join or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundflow.config import AREA_NAMES, ELEMENT_TO_AREA


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def lookup(c, pairs: Iterable[tuple[str, str]], default: Column | None = None) -> Column:
    """``CASE c WHEN k1 THEN v1 ... ELSE default END``.  A NULL key never
    matches (falls to ``default``); without a default unmatched keys are NULL."""
    c = _col(c)
    expr = None
    for key, value in pairs:
        expr = (F.when(c == F.lit(key), F.lit(value)) if expr is None
                else expr.when(c == F.lit(key), F.lit(value)))
    if expr is None:
        return default if default is not None else F.lit(None).cast("string")
    return expr.otherwise(default) if default is not None else expr


def area_from_element(element, area) -> Column:
    """Program element -> area code; unmatched elements keep ``area``."""
    return lookup(element, ELEMENT_TO_AREA, default=_col(area))


def area_name(area) -> Column:
    """Area code -> area name; unknown codes fall back to the code itself."""
    a = _col(area)
    return lookup(a, AREA_NAMES, default=a.cast("string"))


def area_code_from_name(name) -> Column:
    """Area name -> area code; unknown names give NULL."""
    return lookup(name, [(v, k) for k, v in AREA_NAMES])
