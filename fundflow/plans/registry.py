"""Registry of queries over the driver tables and their oracle SQL.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is
the DuckDB SQL that must give the same rows.  Double columns are rounded
to cents on both sides.  Every query reads whole driver tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundflow.operators import round_doubles
from fundflow.plans.roles import DriverFlow

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Stage the award lists and measured key sets in the shared checkpoint
# folder (broadcast under a checked bound).  False exercises the
# unmeasured path: pre-aggregation + shuffle joins, planner's choice.
STAGED = True


def register(name: str, sql: str | None, reuse: tuple[str, ...] = ()):
    """Register a query.  ``reuse`` names the intermediates ("ledger",
    "txn") the query reads more than once; they are written once per call."""
    def deco(fn: Callable[[DriverFlow], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(DriverFlow(spark, sf_dir, staged=STAGED, reuse=reuse)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco
