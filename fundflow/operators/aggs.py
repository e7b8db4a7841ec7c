"""Aggregations, fills and the running total.

Measures are chosen by type from the schema at plan-building time (no job),
as the source chooses "every numeric column".  All aggregates here are
algebraic (sum / count / max), so Spark runs them as partial + final
HashAggregate: a hot key is combined map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def lenient_sum(c: str) -> Column:
    """Sum that skips NULLs and NaNs; a group without values sums to 0."""
    return F.coalesce(F.sum(known(c)), F.lit(0)).alias(c)


def known(c: str) -> Column:
    """The value, NULL where it is NaN: missing either way."""
    return F.when(~F.isnan(c), F.col(c))


def strict_sum(c: str) -> Column:
    """Sum that is NULL as soon as one value in the group is NULL.
    Built from sum and two counts so it still aggregates partially."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c)).alias(c)


def sum_all_numeric(df: DataFrame, keys: Sequence[str], strict: bool = False) -> DataFrame:
    """Group by ``keys`` and sum every other numeric column.  Non-numeric,
    non-key columns are dropped (as the source's numeric-only summary)."""
    keys = list(keys)
    cols = numeric_columns(df, keys)
    agg = strict_sum if strict else lenient_sum
    if not cols:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*[agg(c) for c in cols])


def partial_sums(df: DataFrame, keys: Sequence[str], cols: Sequence[str], strict: bool = False) -> DataFrame:
    """First stage of a two-level sum: per group, the sum and non-NULL
    count of each column plus the row count.  :func:`combine_sums` over a
    coarser key then gives exactly the strict or lenient sum of the rows
    (``strict`` in both: a lenient sum skips NaNs here already)."""
    aggs = []
    for c in cols:
        aggs += [F.sum(c if strict else known(c)).alias(f"__s_{c}"), F.count(c).alias(f"__n_{c}")]
    aggs.append(F.count(F.lit(1)).alias("__rows"))
    return df.groupBy(*keys).agg(*aggs)


def combine_sums(df: DataFrame, keys: Sequence[str], cols: Sequence[str], strict: bool = False,
                 rows: str | None = None) -> DataFrame:
    """Second stage of :func:`partial_sums`: strict (NULL if any input row
    was NULL) or lenient (NULLs and NaNs skipped, none left -> 0) sums; with
    ``rows`` also the number of rows, under that name."""
    aggs = [F.sum("__rows").alias(rows)] if rows else []
    for c in cols:
        s = F.sum(f"__s_{c}")
        if strict:
            aggs.append(F.when(F.sum(f"__n_{c}") == F.sum("__rows"), s).alias(c))
        else:
            aggs.append(F.coalesce(s, F.lit(0)).alias(c))
    return df.groupBy(*keys).agg(*aggs)


def max_all_numeric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group by ``keys`` and take the max of every other numeric column
    (NULLs and NaNs skipped)."""
    keys = list(keys)
    cols = numeric_columns(df, keys)
    if not cols:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*[F.max(known(c)).alias(c) for c in cols])


def zero_fill_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """NULL (and NaN) -> 0 in every numeric column."""
    cols = numeric_columns(df, exclude)
    return df.fillna(0, subset=cols) if cols else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    if not cols:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols})


def latest_period(df: DataFrame, col: str = "period") -> DataFrame:
    """Keep rows whose ``col`` equals the column's maximum (NULLs skipped;
    rows with NULL ``col`` never match).

    The maximum is a one-row aggregate joined back by equality, so the plan
    is a broadcast hash join of a single row -- no global window, no
    driver round trip.
    """
    mx = "__max_" + col
    top = df.agg(F.max(col).alias(mx))
    return df.join(F.broadcast(top), F.col(col) == F.col(mx), "inner").drop(mx)


def latest_value(df: DataFrame, col: str = "period") -> object:
    """The column's maximum (NULLs skipped), by one aggregate job that reads
    that column only -- of a table partitioned by it, no data column.  A
    filter on the value prunes the partitions of other values."""
    return df.agg(F.max(col)).first()[0]


def at_latest(df: DataFrame, col: str = "period") -> DataFrame:
    """:func:`latest_period` with the maximum as a literal: for written tables
    partitioned by ``col``, of which only the latest partition is read."""
    top = latest_value(df, col)
    return df.filter(F.col(col) == F.lit(top)) if top is not None else df.limit(0)


def running_total(
    df: DataFrame,
    value: str,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    name: str,
) -> DataFrame:
    """Cumulative sum of ``value`` within ``partition_by`` ordered by
    ``order_by`` (rows frame: all earlier rows through the current row)."""
    w = (Window.partitionBy(*partition_by).orderBy(*order_by)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(name, F.sum(value).over(w))


def round_doubles(df: DataFrame, scale: int = 2) -> DataFrame:
    """Round every double column to ``scale`` places (money to cents)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: F.round(c, scale) for c in cols}) if cols else df
