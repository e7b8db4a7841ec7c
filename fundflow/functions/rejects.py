"""Cells that cannot be read as what their column holds.

A cell with text that is no number (or date) becomes NULL, as in the source,
which only warns.  :func:`mark_rejects` keeps such cells in the same pass:
behind every row come copies of it, one for each of its unreadable cells, that
carry file, column and text.  A roll-up that groups by these three as well
counts the cells while it sums the rows; what has them NULL is the data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.functions.dates import parse_ymd, serial_to_date
from fundflow.functions.text import text_to_number

REJECT_COLUMNS = ("reject_file", "reject_column", "reject_text")


def mark_rejects(df: DataFrame, numbers: Iterable[str] = (), dates: Iterable[str] = (), serials: Iterable[str] = (),
                 file: str = "source_file") -> DataFrame:
    """``df`` with :data:`REJECT_COLUMNS`, NULL in its own rows, and one more
    row for each cell of the named text columns whose text is not blank and
    cannot be read as a number, a year-month-day date or a day serial.
    Columns that are absent or of another type hold no such cells."""
    text = {n for n, t in df.dtypes if t == "string"}
    parsed = {**{n: text_to_number(n) for n in numbers}, **{n: parse_ymd(n) for n in dates},
              **{n: serial_to_date(n) for n in serials}}
    name = F.col(file) if file in df.columns else F.lit(None).cast("string")
    bad = [F.when((F.trim(n) != "") & value.isNull(), F.struct(name.alias("f"), F.lit(n).alias("c"), F.col(n).alias("t")))
           for n, value in parsed.items() if n in text]
    none = F.struct(*[F.lit(None).cast("string").alias(c) for c in "fct"])
    cells = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array().cast("array<struct<f:string,c:string,t:string>>")
    out = df.withColumn("__cell", F.explode(F.concat(F.array(none), cells)))
    return out.select(*df.columns, *[F.col(f"__cell.{k}").alias(c) for k, c in zip("fct", REJECT_COLUMNS)])
