"""Feed normalisers: one function per extract.

Each takes the extract *as landed* -- all period files of one feed in one
DataFrame, with a ``period`` column taken from the file name (see
:mod:`fundflow.sources.landing`) and optionally ``source_file`` -- and
returns the cleaned feed.  Work that the source does per file and then
repeats after binding the files (the transaction roll-up) is done once
here: sums are associative, so one partial + final aggregation equals the
per-file sums re-summed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from fundflow.config import (
    ACTIVE_COLUMNS,
    CLOSEOUT_COLUMNS,
    DEFAULT,
    DISBURSEMENT_EVENT,
    EXPIRED_COLUMNS,
    LEDGER_AMOUNT_COLUMNS,
    LEDGER_COLUMNS,
    LEDGER_HEADER_DRIFT,
    OBLIGATION_EVENT_TYPES,
    ORG_RECODE,
    PLAN_DATE_COLUMN,
    PLAN_HEADER_DRIFT,
    PLAN_NUMERIC_COLUMNS,
    SUB_SECTOR_RECODE,
    TXN_COLUMNS,
    FlowConfig,
)
from fundflow.functions import (
    REJECT_COLUMNS,
    area_code_from_name,
    area_from_element,
    as_number,
    fiscal_period,
    mark_rejects,
    matches_any,
    parse_period,
    parse_ymd,
    quarter_start,
    recode,
    serial_to_date,
    trim_ws,
)
from fundflow.operators import (
    KeySet,
    can_broadcast,
    combine_sums,
    nan_to_null,
    numeric_columns,
    partial_sums,
    resolve_key,
    sum_all_numeric,
    zero_fill_numeric,
)
from fundflow import schemas
from fundflow.schemas import typed_columns
from fundflow.sources.headers import rename_drift

SOURCE_FILE = "source_file"
#: Writes a DataFrame and reads it back.
Cut = Callable[[DataFrame], DataFrame]
TXN_KEYS = ("award_number", "period", "program_area")
LEDGER_KEYS = ("award_number", "period", "program_area", "bilateral_obl_number")


def _declared(df: DataFrame, names: Iterable[str], feed: str) -> list[str]:
    """``names``, all of which the landing must have."""
    names = list(names)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{feed}: columns missing from the landing: {', '.join(missing)}")
    return names


def text_ingest(df: DataFrame, keep: Iterable[str] = ("period", SOURCE_FILE)) -> DataFrame:
    """Read every column as text (the two accounting feeds are ingested as
    text and cast explicitly, so a stray number format never changes the
    schema).  Columns in ``keep`` keep their type: amounts that already
    land as numbers are cast directly instead of round-tripping through
    text (same values, no per-row string work)."""
    keep = set(keep)
    return df.select([F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in df.columns])


def _award_common(df: DataFrame, sector: str) -> DataFrame:
    """Start and end dates pass through as landed, like every column not named here."""
    return (df.filter(F.col("sector") == F.lit(sector))
              .withColumns({
                  "award_number": trim_ws("award_number"),
                  "sub_sector": recode("sub_sector", SUB_SECTOR_RECODE),
                  "u_s_org_local": recode("u_s_org_local", ORG_RECODE),
              }))


def active_awards(raw: DataFrame, cfg: FlowConfig = DEFAULT, marked: bool = False) -> DataFrame:
    """active awards of the configured sector; keys trimmed, values
    recoded, numeric columns zero-filled, rows without a key dropped and
    activities whose name contains an excluded fragment removed (a NULL
    name is removed too).  ``marked``, here and in the other feeds: unreadable
    cells are marked (:func:`fundflow.functions.mark_rejects`)."""
    df = _award_common(raw, cfg.active_sector)
    numbers = typed_columns(schemas.ACTIVE, DoubleType)
    df = mark_rejects(df, numbers=numbers) if marked else df
    df = as_number(df, numbers)
    df = zero_fill_numeric(df, exclude=REJECT_COLUMNS)
    df = df.select(*_declared(df, ACTIVE_COLUMNS, "active awards"), *_marks(df)).dropna(subset=["award_number"])
    return df.filter(~matches_any("activity_name", cfg.remove_awards))


def _marks(df: DataFrame) -> list[str]:
    return [c for c in REJECT_COLUMNS if c in df.columns]


def expired_awards(raw: DataFrame, cfg: FlowConfig = DEFAULT) -> DataFrame:
    """expired awards; like F1 but keeps ``sector``, no zero fill and no
    name exclusion."""
    df = _award_common(raw, cfg.expired_sector)
    return df.select(*_declared(df, EXPIRED_COLUMNS, "expired awards")).dropna(subset=["award_number"])


def close_out(raw: DataFrame) -> DataFrame:
    """close-out tracker rows with a trimmed, non-NULL key."""
    df = raw.withColumn("award_number", trim_ws("award_number"))
    return df.select(*_declared(df, CLOSEOUT_COLUMNS, "close-out tracker")).dropna(subset=["award_number"])


def plan(raw: DataFrame, cfg: FlowConfig = DEFAULT, marked: bool = False) -> DataFrame:
    """sub-obligation plan, open schema.  Drops "Total" rows (and rows
    whose mechanism is NULL), maps area names to codes (unknown -> NULL),
    casts the known amount columns and the planned date, NaN -> NULL ->
    0 in every numeric column.  Other columns pass through; amounts among
    them that land as text (CSV) are named in ``cfg.plan_extra_amounts``, so
    that one type holds for the whole feed.  Amounts the feed knows but the
    landing lacks stay absent (the schema is open)."""
    df = rename_drift(raw, PLAN_HEADER_DRIFT)
    df = df.withColumn("award_number", trim_ws("award_number"))
    df = df.filter(F.col("implementing_mechanism") != F.lit("Total"))
    if marked:
        df = mark_rejects(df, numbers=[*PLAN_NUMERIC_COLUMNS, *cfg.plan_extra_amounts], dates=[PLAN_DATE_COLUMN])
    df = df.drop("filename", SOURCE_FILE, "implementing_mechanism").dropna(subset=["award_number"])
    df = df.withColumnRenamed("program_area", "program_area_name")
    df = df.withColumn("program_area", area_code_from_name("program_area_name"))
    df = as_number(df, [*PLAN_NUMERIC_COLUMNS, *cfg.plan_extra_amounts])
    kind = dict(df.dtypes).get(PLAN_DATE_COLUMN)
    if kind:
        df = df.withColumn(PLAN_DATE_COLUMN, parse_ymd(PLAN_DATE_COLUMN, text=kind == "string"))
    df = zero_fill_numeric(nan_to_null(df))
    return df.drop("program_area_name")


def ledger_lines(raw: DataFrame, cfg: FlowConfig = DEFAULT, marked: bool = False) -> DataFrame:
    """Row-level part of F5 before key resolution: text ingest, drift
    rename, type / distribution filters, amounts cast, area code,
    outlays = disbursement + accrual (NULL if either is NULL)."""
    df = text_ingest(rename_drift(raw, LEDGER_HEADER_DRIFT), keep=("period", SOURCE_FILE, *LEDGER_AMOUNT_COLUMNS))
    df = df.filter(F.col("obligation_type").isin(*cfg.event_types)
                   & F.col("distribution").isin(*cfg.distributions))
    extra = [c for c in ("period", SOURCE_FILE) if c in df.columns]
    df = df.select(*_declared(df, LEDGER_COLUMNS, "ledger"), *extra)
    df = mark_rejects(df, numbers=LEDGER_AMOUNT_COLUMNS) if marked else df
    df = as_number(df, LEDGER_AMOUNT_COLUMNS)
    df = df.withColumn("program_area", area_from_element("program_element", "program_area"))
    return df.withColumn("total_disbursement_outlays",
                         F.col("disbursement_amt") + F.col("last_qtr_accrual_amt"))


LEDGER_CANDIDATES = ("award_number", "document_number")


def ledger(raw: DataFrame, all_keys: DataFrame | KeySet, cfg: FlowConfig = DEFAULT, cut: Cut | None = None) -> DataFrame:
    """accounting pipeline ledger rolled up to award x period x area x
    bilateral agreement (per source file, as the source never merges
    files).  Keys resolve to the award number if it is a known award, else
    the document number; rows matching neither are dropped.  Sums are
    strict by default: one unparseable amount makes the group NULL.

    With a measured key set small enough to broadcast, keys are resolved
    map-side row by row.  Otherwise the lines are first pre-aggregated on
    the candidate key columns (sum, non-NULL count, row count), so the
    shuffle joins of the resolution see one row per candidate group, and
    the strict / lenient sums are finished after resolution; ``cut`` writes
    that pre-aggregation (see :func:`fundflow.operators.resolve_key`).
    """
    df = ledger_lines(raw, cfg)
    keys = list(LEDGER_KEYS) + ([SOURCE_FILE] if SOURCE_FILE in df.columns else [])
    measures = numeric_columns(df, keys)
    if can_broadcast(all_keys):
        df = resolve_key(df, all_keys, LEDGER_CANDIDATES)
        out = sum_all_numeric(df.select(*keys, *measures), keys, strict=cfg.strict_ledger_sum)
    else:
        pre = partial_sums(df, [*keys, "document_number"], measures, strict=cfg.strict_ledger_sum)
        pre = resolve_key(pre, all_keys, LEDGER_CANDIDATES, cut=cut)
        out = combine_sums(pre, keys, measures, strict=cfg.strict_ledger_sum)
    return out.drop(SOURCE_FILE) if SOURCE_FILE in keys else out


TXN_CANDIDATES = ("award_number", "document_number", "obl_document_number")
TXN_MEASURES = ("transaction_amt", "transaction_disbursement", "transaction_obligation", "avg_monthly_exp_rate")


def transaction_measures(raw: DataFrame, cfg: FlowConfig = DEFAULT, per: Iterable[str] = (),
                         marked: bool = False) -> DataFrame:
    """Row-level part of F6 before key resolution: distribution filter,
    amount cast, date -> quarter start -> fiscal period, area code,
    conditional measures.  Keeps the three candidate key columns, and the
    columns ``per``."""
    per = list(per)
    df = text_ingest(raw, keep=("period", SOURCE_FILE, "transaction_amt", "transaction_date", *per))
    file = [SOURCE_FILE] if marked and SOURCE_FILE in df.columns and SOURCE_FILE not in per else []
    df = df.select(*_declared(df, TXN_COLUMNS, "transactions"), *per, *file)
    df = df.filter(F.col("distribution").isin(*cfg.distributions))
    df = mark_rejects(df, numbers=["transaction_amt"], serials=["transaction_date"]) if marked else df
    per = [*per, *_marks(df)]
    serial_is_text = dict(df.dtypes).get("transaction_date") == "string"
    df = as_number(df, ["transaction_amt"])
    df = df.withColumns({
        "transaction_date": quarter_start(serial_to_date("transaction_date", cfg.serial_offset_days,
                                                         text=serial_is_text)),
        "program_area": area_from_element("program_element", "program_area"),
    })
    amt = F.col("transaction_amt")
    df = df.withColumns({
        "transaction_disbursement": F.when(F.col("transaction_event") == F.lit(DISBURSEMENT_EVENT), amt),
        "transaction_obligation": F.when(F.col("transaction_event_type").isin(*OBLIGATION_EVENT_TYPES), amt),
    })
    df = df.withColumn("avg_monthly_exp_rate", F.col("transaction_disbursement") / F.lit(3.0))
    df = df.withColumn("period", fiscal_period("transaction_date", cfg.null_period_label))
    return df.select(*TXN_CANDIDATES, "transaction_date", "period", "program_area", *TXN_MEASURES, *per)


def transaction_lines(raw: DataFrame, active_keys: DataFrame | KeySet, cfg: FlowConfig = DEFAULT,
                      cut: Cut | None = None) -> DataFrame:
    """Row-level F6 with keys resolved (3 steps, *active* keys only):
    one row per kept transaction."""
    df = resolve_key(transaction_measures(raw, cfg), active_keys, TXN_CANDIDATES, cut=cut)
    return df.drop("document_number", "obl_document_number")


def with_fiscal(rolled: DataFrame) -> DataFrame:
    """F6's columns, fiscal year and quarter parsed back out of the label."""
    fiscal_year, quarter = parse_period("period")
    rolled = rolled.withColumns({"fiscal_year": fiscal_year, "quarter": quarter})
    return rolled.select("award_number", "fiscal_year", "quarter", "period", "program_area", *TXN_MEASURES)


def transactions(raw: DataFrame, active_keys: DataFrame | KeySet, cfg: FlowConfig = DEFAULT,
                 cut: Cut | None = None) -> DataFrame:
    """transactions rolled up to award x fiscal period x area (lenient
    sums), with the fiscal year and quarter parsed back out of the label.

    With a measured key set small enough to broadcast, keys are resolved
    map-side and the roll-up is one partial + final aggregation.  Otherwise
    lines are pre-aggregated on (candidate keys, period, area) -- a
    map-side-combined shuffle that a hot award cannot skew -- and only the
    pre-aggregated rows, which ``cut`` writes, go through the resolution joins.
    """
    lines = transaction_measures(raw, cfg)
    if can_broadcast(active_keys):
        df = resolve_key(lines, active_keys, TXN_CANDIDATES)
        return with_fiscal(sum_all_numeric(df.select(*TXN_KEYS, *TXN_MEASURES), TXN_KEYS))
    return finish_transactions(transaction_partials(lines), active_keys, cut)


def transaction_partials(lines: DataFrame, per: Iterable[str] = ()) -> DataFrame:
    """Lines of :func:`transaction_measures` summed by candidate keys, period
    and area (and the columns ``per``): sums that :func:`finish_transactions`
    merges, whatever they were split by."""
    return partial_sums(lines, [*TXN_CANDIDATES, "period", "program_area", *per], TXN_MEASURES)


def finish_transactions(partials: DataFrame, active_keys: DataFrame | KeySet, cut: Cut | None = None,
                        written: bool = False) -> DataFrame:
    """F6 from :func:`transaction_partials`: keys resolved, sums merged.
    ``written``: the partial sums are a scan of files."""
    got = resolve_key(partials, active_keys, TXN_CANDIDATES, cut=cut, written=written)
    return with_fiscal(combine_sums(got, TXN_KEYS, TXN_MEASURES))
