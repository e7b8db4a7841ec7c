"""Output writers.  Outputs are directories of part files written in
parallel by the executors (never gathered to one task)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

CSV_OPTIONS = {
    "header": "true",
    "nullValue": "NA",
    "emptyValue": '""',
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "dateFormat": "yyyy-MM-dd",
    "timeZone": "UTC",  # the pattern's Z
}


# A floating number in exponent notation: sign, leading digit, other digits, exponent.
_EXPONENT = r"^(-?)(\d)\.(\d+)E(-?\d+)$"


def plain_number(c: Column) -> Column:
    """A floating number as text without an exponent, at any magnitude: the
    shortest digits that read back as the same number, whole numbers without
    a point (``5``, ``12345678.9``, ``0.0001``).  NaN and infinities keep
    their names."""
    s = c.cast("string")
    frac = F.regexp_replace(F.regexp_extract(s, _EXPONENT, 3), "0+$", "")
    digits = F.concat(F.regexp_extract(s, _EXPONENT, 2), frac)
    exp = F.regexp_extract(s, _EXPONENT, 4).try_cast("int")
    whole = F.rpad(digits, exp + 1, F.lit("0"))
    rest = F.substring(frac, exp + 1, F.length(frac))
    large = F.when(F.length(frac) <= exp, whole).otherwise(F.concat(F.substring(digits, F.lit(1), exp + 1), F.lit("."), rest))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    wide = F.concat(F.regexp_extract(s, _EXPONENT, 1), F.when(exp >= 0, large).otherwise(small))
    return (F.when(c == 0, F.lit("0")).when(s.contains("E"), wide)
            .otherwise(F.regexp_replace(s, r"\.0$", "")))


def plain_numbers(df: DataFrame) -> DataFrame:
    """Every floating column as :func:`plain_number` text."""
    cols = {f.name: plain_number(F.col(f.name)) for f in df.schema.fields
            if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(cols) if cols else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, NULL written as ``NA``, numbers without exponents,
    timestamps in UTC."""
    df = plain_numbers(df)
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv_output(spark, path: str, schema=None) -> DataFrame:
    """Read back a :func:`write_csv` output (``NA`` -> NULL)."""
    r = spark.read.options(**{k: CSV_OPTIONS[k] for k in ("header", "nullValue", "escape", "timestampFormat",
                                                          "dateFormat", "timeZone")})
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet, optionally partitioned (e.g. by ``period`` so a
    latest-period read prunes to one folder)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
