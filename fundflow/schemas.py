"""Declared schemas of the six feeds (after header cleaning).

Landed CSV is all text; Parquet may carry types.  The feed functions cast
the typed columns declared here (``as_number`` / date parsing) instead of
inferring per file, so a period file whose column happens to look numeric
or textual cannot change the feed's schema.  The streaming ingest needs a
landing schema up front; ``landing_schema`` gives the all-text one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, DT = T.StringType(), T.DoubleType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ACTIVE = _schema(("sector", S), ("sub_sector", S), ("activity_name", S), ("award_number", S),
                 ("total_estimated_cost", D), ("start_date", DT), ("end_date", DT), ("u_s_org_local", S),
                 ("aor_cor_or_activity_manager", S), ("funding_type", S), ("pepfar_funding", S))
EXPIRED = _schema(("sector", S), ("sub_sector", S), ("activity_name", S), ("award_number", S), ("end_date", DT),
                  ("u_s_org_local", S), ("aor_cor_or_activity_manager", S), ("funding_type", S))
CLOSE_OUT = _schema(("award_number", S), ("to_be_deobligated", S), ("status", S))
PLAN = _schema(("award_number", S), ("implementing_mechanism", S), ("program_area", S),
               ("planned_subobligations_for_the_next_months", D), ("total_obligations_this_fy", D),
               ("projected_monthly_burn_rate", D), ("un_sub_obligated_funds", D), ("planned_sub_oblig_date", DT),
               ("approved_budget_cop_op", D), ("unliquidated_obligations_at_the_beginning_of_the_fy", D),
               ("comments", S))
LEDGER = _schema(("award_number", S), ("document_number", S), ("obligation_type", S), ("distribution", S),
                 ("program_element", S), ("program_area", S), ("bilateral_obl_number", S), ("document_amt", S),
                 ("obligation_amt", S), ("subobligation_amt", S), ("disbursement_amt", S), ("undisbursed_amt", S),
                 ("last_qtr_accrual_amt", S), ("pipeline_amt", S))
TRANSACTIONS = _schema(("award_number", S), ("document_number", S), ("obl_document_number", S),
                       ("transaction_date", S), ("transaction_amt", S), ("transaction_event", S),
                       ("transaction_event_type", S), ("program_element", S), ("distribution", S),
                       ("program_area", S))


def with_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the declared columns that ``df`` lacks, as NULLs: for a caller who
    knows that a landing has no such column (a feed by itself refuses)."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def typed_columns(schema: T.StructType, kind: type) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, kind)]


def landing_schema(schema: T.StructType) -> T.StructType:
    """The all-text schema of a CSV landing of this feed."""
    return _schema(*[(f.name, S) for f in schema.fields])
