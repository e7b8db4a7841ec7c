"""Text column functions with the source workflow's NULL behaviour."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from fundflow.functions.codes import lookup

ColumnOrName = Column | str

# A number written as text: optional sign, digits with an optional decimal
# point, optional exponent, surrounding white space allowed.  Text such as
# "1,234", "n/a" or "12d" is not a number (Java's parser would accept "12d").
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_NUMBER_TEXT = r"^\s*[+-]?(?i)(inf|infinity|nan)\s*$"
# Hexadecimal integers ("0x1A") are numbers too.
HEX_NUMBER_TEXT = r"^\s*([+-]?)0[xX]([0-9a-fA-F]+)\s*$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: ColumnOrName) -> Column:
    """Strip leading and trailing white space of every kind (tabs, newlines,
    Unicode spaces), not just blanks as ``trim`` does."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def text_to_number(c: ColumnOrName) -> Column:
    """Text -> double; anything that is not a plain decimal number is NULL.

    ANSI casts raise on bad text and ``try_cast`` accepts Java suffixes
    ("1d", "1f"), so the text is checked against a pattern first.
    Hexadecimal integers ("0x1A", "-0xff") are read as numbers.
    """
    c = _col(c)
    plain = c.rlike(NUMBER_TEXT)
    special = c.rlike(SPECIAL_NUMBER_TEXT)
    sign = F.when(F.regexp_extract(c, HEX_NUMBER_TEXT, 1) == F.lit("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    hex_value = F.conv(F.regexp_extract(c, HEX_NUMBER_TEXT, 2), 16, 10).try_cast("double") * sign
    return (F.when(plain | special, F.trim(c).try_cast("double"))
             .when(c.rlike(HEX_NUMBER_TEXT), hex_value))


def as_number(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Cast the named columns to double: text is parsed with
    :func:`text_to_number`, numeric columns are widened, absent columns are
    skipped (open schemas)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for n in names:
        t = types.get(n)
        if t is None:
            continue
        if isinstance(t, NumericType):
            exprs[n] = F.col(n).cast("double")
        elif isinstance(t, StringType):
            exprs[n] = text_to_number(n)
        else:
            exprs[n] = text_to_number(F.col(n).cast("string"))
    return df.withColumns(exprs) if exprs else df


def period_from_filename(c: ColumnOrName) -> Column:
    """Text before the first underscore of a file name; NULL when the name
    starts with an underscore."""
    return F.nullif(F.substring_index(_col(c), "_", 1), F.lit(""))


def recode(c: ColumnOrName, pairs: Iterable[tuple[str, str]]) -> Column:
    """Replace listed values; every other value (and NULL) passes through."""
    c = _col(c)
    return lookup(c, pairs, default=c)


def matches_any(c: ColumnOrName, fragments: Iterable[str]) -> Column:
    """Unanchored regex match against any fragment (fragments are matched
    literally).  NULL input gives NULL, which filters treat as false.  Without
    fragments nothing matches, NULL included."""
    pattern = "|".join(re.escape(f) for f in fragments)
    return _col(c).rlike(pattern) if pattern else F.lit(False)
