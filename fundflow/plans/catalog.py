"""Workflow-level registered queries (feeds, datasets, checks).

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is
the DuckDB SQL that must give the same rows.  Double columns are rounded
to cents on both sides.  Every query reads whole driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from fundflow.operators import stage
from fundflow.plans import checks, rejects
from fundflow.plans import oracle as O
from fundflow.plans.registry import register
from fundflow.plans.roles import DriverFlow


# --- feeds (F1-F6) ---------------------------------------------------------

@register("feed_active", O.with_ctes("SELECT * FROM f_active", ["total_estimated_cost"]))
def feed_active(f: DriverFlow) -> DataFrame:
    """F1 active awards."""
    return f.active


@register("feed_expired", O.with_ctes("SELECT * FROM f_expired"))
def feed_expired(f: DriverFlow) -> DataFrame:
    """F2 expired awards."""
    return f.expired


@register("feed_closeout", O.with_ctes("SELECT * FROM f_closeout", ["to_be_deobligated"]))
def feed_closeout(f: DriverFlow) -> DataFrame:
    """F3 close-out tracker."""
    return f.closeout


@register("feed_plan", O.with_ctes("SELECT * FROM f_plan", O.PLAN_NUM))
def feed_plan(f: DriverFlow) -> DataFrame:
    """F4 sub-obligation plan."""
    return f.plan


@register("ledger_rollup", O.with_ctes("SELECT * FROM f_ledger", O.LEDGER_NUM))
def ledger_rollup(f: DriverFlow) -> DataFrame:
    """F5 ledger roll-up (strict sums, 2-step key resolution)."""
    return f.ledger


@register("txn_rollup", O.with_ctes("SELECT * FROM f_txn", O.TXN_NUM))
def txn_rollup(f: DriverFlow) -> DataFrame:
    """F6 transaction roll-up (3-step key resolution, fiscal periods)."""
    return f.txn_rollup


def _cells(feed: str, table: str, where: str, columns) -> str:
    """Cells of a role extract that hold text which ``parsed`` makes NULL."""
    return " UNION ALL ".join(f"SELECT '{feed}' AS feed, '{c}' AS column_name, {c} AS text FROM {table} "
                              f"WHERE {where} AND trim({c}) <> '' AND {parsed} IS NULL" for c, parsed in columns)


_LEDGER_AMOUNTS = [c for c in O.LEDGER_NUM if c != "total_disbursement_outlays"]


@register("rejected_cells", O.with_ctes(f"""
SELECT feed, CAST(NULL AS VARCHAR) AS source_file, column_name, text, count(*) AS n FROM (
{_cells('plan', 'r_plan', "implementing_mechanism <> 'Total'",
        [*[(c, O.num(c)) for c in O.PLAN_NUM], ('planned_sub_oblig_date', O.YMD)])} UNION ALL
{_cells('ledger', 'r_ledger', f"obligation_type IN ({O.inlist(O.EVENT_TYPE_FILTER)}) AND distribution IN "
        f"({O.inlist(O.DISTRIBUTION_FILTER)})", [(c, O.num(c)) for c in _LEDGER_AMOUNTS])} UNION ALL
{_cells('transactions', 'r_txn', f"distribution IN ({O.inlist(O.DISTRIBUTION_FILTER)})",
        [(c, O.num(c)) for c in ('transaction_amt', 'transaction_date')])}) x
GROUP BY ALL"""))
def rejected_cells(f: DriverFlow) -> DataFrame:
    """Cells that could not be read, from the passes that make the feeds."""
    def cut(df: DataFrame) -> DataFrame:
        return stage(df, "marked")

    return rejects.all_cells([rejects.active_awards(f.raw_award, cut, f.cfg)[1], rejects.plan(f.raw_plan, cut, f.cfg)[1],
                              rejects.ledger(f.raw_ledger, f.all_keys, cut, f.cfg)[1],
                              rejects.transactions(f.raw_txn, f.active_keys, cut, f.cfg)[1]])


@register("ledger_quarantined", O.with_ctes("SELECT * FROM f_ledger", O.LEDGER_NUM))
def ledger_quarantined(f: DriverFlow) -> DataFrame:
    """F5 as it comes out of the pass that quarantines: the same roll-up."""
    return rejects.ledger(f.raw_ledger, f.all_keys, lambda df: stage(df, "marked"), f.cfg)[0]


# --- datasets (D0-D3) ------------------------------------------------------

@register("txn_cumulative", O.with_ctes("SELECT * FROM d0", O.D0_NUM))
def txn_cumulative(f: DriverFlow) -> DataFrame:
    """D0 transactions with the running fiscal-year disbursement."""
    return f.txn


@register("pipeline_dataset", O.with_ctes("SELECT * FROM d1", O.D1_NUM), reuse=("ledger",))
def pipeline_dataset(f: DriverFlow) -> DataFrame:
    """D1 award pipeline dataset."""
    return f.pipeline


@register("pipeline_dataset_laid_out", O.with_ctes("SELECT * FROM d1", O.D1_NUM))
def pipeline_dataset_laid_out(f: DriverFlow) -> DataFrame:
    """D1 over inputs bucketed by award and period: no exchange in its joins."""
    return f.pipeline_by_layout


@register("txn_dataset", O.with_ctes(
    "SELECT * FROM d2", ["transaction_disbursement", "transaction_obligation", "transaction_amt",
                         "avg_monthly_exp_rate", "last_qtr_accrual_amt"]), reuse=("ledger", "txn"))
def txn_dataset(f: DriverFlow) -> DataFrame:
    """D2 transaction dataset."""
    return f.txn_dataset


@register("expired_dataset", O.with_ctes("SELECT * FROM d3", ["undisbursed_amt", "to_be_deobligated"]))
def expired_dataset(f: DriverFlow) -> DataFrame:
    """D3 expired awards dataset (latest period)."""
    return f.expired_dataset


# --- checks (K1-K10) -------------------------------------------------------

_AP = ["award_number", "period"]


@register("coverage_awards", O.with_ctes(f"""
SELECT a.activity_name, a.award_number, a.period, s.subobligation_summary, p.pipeline, t.transaction
FROM (SELECT DISTINCT activity_name, award_number, period FROM f_active) a
LEFT JOIN (SELECT DISTINCT award_number, period, 'exists' AS subobligation_summary FROM f_plan) s ON {O.ns('a', 's', _AP)}
LEFT JOIN (SELECT DISTINCT award_number, period, 'exists' AS pipeline FROM f_ledger) p ON {O.ns('a', 'p', _AP)}
LEFT JOIN (SELECT DISTINCT award_number, period, 'exists' AS transaction FROM d0) t ON {O.ns('a', 't', _AP)}"""))
def coverage_awards(f: DriverFlow) -> DataFrame:
    """K1 award-period coverage across plan, ledger and transactions."""
    return checks.coverage_awards(f.active, f.plan, f.ledger, f.txn)


@register("coverage_areas", O.with_ctes("""
SELECT coalesce(x.program_area, t.program_area) AS program_area, coalesce(x.period, t.period) AS period,
       x.subobligation, x.pipeline, t.transaction
FROM (
  SELECT coalesce(s.program_area, p.program_area) AS program_area, coalesce(s.period, p.period) AS period,
         s.subobligation, p.pipeline
  FROM (SELECT DISTINCT pl.program_area, pl.period, 'yes' AS subobligation
        FROM f_active a JOIN f_plan pl ON a.award_number IS NOT DISTINCT FROM pl.award_number
                                   AND a.period IS NOT DISTINCT FROM pl.period
        WHERE pl.program_area IS NOT NULL) s
  FULL JOIN (SELECT DISTINCT program_area, period, 'yes' AS pipeline FROM f_ledger
             WHERE award_number IN (SELECT award_number FROM k_active)) p
    ON s.program_area IS NOT DISTINCT FROM p.program_area AND s.period IS NOT DISTINCT FROM p.period) x
FULL JOIN (SELECT DISTINCT program_area, period, 'yes' AS transaction FROM d0
           WHERE award_number IN (SELECT award_number FROM k_active)) t
  ON x.program_area IS NOT DISTINCT FROM t.program_area AND x.period IS NOT DISTINCT FROM t.period"""))
def coverage_areas(f: DriverFlow) -> DataFrame:
    """K2 program-area coverage per period."""
    return checks.coverage_areas(f.active, f.plan, f.txn, f.ledger, f.active_keys)


@register("missing_area", O.with_ctes(f"""
SELECT DISTINCT a.award_number, a.period, a.activity_name, p.program_area
FROM f_active a LEFT JOIN f_plan p ON {O.ns('a', 'p', _AP)}
WHERE a.activity_name IS NOT NULL AND p.program_area IS NULL"""))
def missing_area(f: DriverFlow) -> DataFrame:
    """K3 named active award-periods without a mapped plan area."""
    return checks.missing_area(f.active, f.plan)


_SPOT_L = ", ".join(f"l.{c}" for c in ["bilateral_obl_number", *O.LEDGER_NUM])
_SPOT_T = ", ".join(f"t.{c}" for c in O.D0_NUM)


@register("area_spotlight", O.with_ctes(f"""
SELECT x.award_number, a.activity_name, x.period, x.program_area_x, x.bilateral_obl_number,
  {", ".join(f"x.{c}" for c in O.LEDGER_NUM)}, x.program_area_y, {", ".join(f"x.{c}" for c in O.D0_NUM)}
FROM (
  SELECT coalesce(l.award_number, t.award_number) AS award_number, coalesce(l.period, t.period) AS period,
    l.program_area AS program_area_x, {_SPOT_L}, t.program_area AS program_area_y, {_SPOT_T}
  FROM (SELECT * FROM f_ledger WHERE award_number IN (SELECT award_number FROM k_active) AND program_area = 'PO.2') l
  FULL JOIN (SELECT * FROM d0 WHERE award_number IN (SELECT award_number FROM k_active) AND program_area = 'PO.2') t
    ON {O.ns('l', 't', _AP)}) x
LEFT JOIN (SELECT award_number, activity_name, period FROM f_active) a ON {O.ns('x', 'a', _AP)}""",
    O.LEDGER_NUM + O.D0_NUM))
def area_spotlight(f: DriverFlow) -> DataFrame:
    """K4 one program area: ledger FULL JOIN transactions, with activity names."""
    return checks.area_spotlight(f.active, f.ledger, f.txn, f.active_keys, f.cfg)


@register("recon_awards", O.with_ctes(f"""
SELECT r.award_number, r.activity_name, r.period, r.raw_total_estimated_cost, n.new_total_estimated_cost,
  r.raw_total_estimated_cost - n.new_total_estimated_cost AS TEA_diff
FROM (SELECT award_number, activity_name, period, total_estimated_cost AS raw_total_estimated_cost FROM f_active) r
LEFT JOIN (SELECT DISTINCT award_number, period, total_estimated_cost AS new_total_estimated_cost FROM d1) n
  ON {O.ns('r', 'n', _AP)}""", ["raw_total_estimated_cost", "new_total_estimated_cost", "TEA_diff"]),
          reuse=("ledger",))
def recon_awards(f: DriverFlow) -> DataFrame:
    """K5 estimated cost, raw vs pipeline dataset."""
    return checks.recon_awards(f.active, f.pipeline)


def _recon_txn_sql(reported: str) -> str:
    return O.with_ctes(f"""
SELECT award_number, period, raw_transaction_amt, new_transaction_amt,
  raw_transaction_amt - new_transaction_amt AS transaction_diff
FROM (
  SELECT r.award_number, r.period, coalesce(r.raw_transaction_amt, 0) AS raw_transaction_amt,
    coalesce(n.new_transaction_amt, 0) AS new_transaction_amt
  FROM (SELECT s.award_number, s.period, s.amt AS raw_transaction_amt
        FROM (SELECT award_number, period, coalesce(sum(transaction_amt), 0) AS amt FROM d0 GROUP BY 1, 2) s
        LEFT JOIN (SELECT DISTINCT award_number, activity_name FROM f_active) a ON {O.ns('s', 'a', ['award_number'])}) r
  LEFT JOIN (SELECT s.award_number, s.period, s.amt AS new_transaction_amt
        FROM (SELECT award_number, period, coalesce(sum(transaction_amt), 0) AS amt FROM {reported} GROUP BY 1, 2) s
        LEFT JOIN (SELECT DISTINCT award_number, activity_name FROM f_active) a ON {O.ns('s', 'a', ['award_number'])}) n
  ON {O.ns('r', 'n', _AP)}) x""", ["raw_transaction_amt", "new_transaction_amt", "transaction_diff"])


@register("recon_txn_pipeline", _recon_txn_sql("d1"), reuse=("ledger", "txn"))
def recon_txn_pipeline(f: DriverFlow) -> DataFrame:
    """K6 transaction amounts, raw vs pipeline dataset."""
    return checks.recon_txn_pipeline(f.txn, f.active, f.pipeline)


@register("recon_txn_dataset", _recon_txn_sql("d2"), reuse=("ledger", "txn"))
def recon_txn_dataset(f: DriverFlow) -> DataFrame:
    """K7 transaction amounts, raw vs transaction dataset."""
    return checks.recon_txn_dataset(f.active, f.txn, f.txn_dataset)


_K8_M = ["document_amt", "disbursement_amt", "last_qtr_accrual_amt", "undisbursed_amt"]
_K8_DIFF = [("document_amt", "document_dif"), ("disbursement_amt", "disbursement_dif"),
            ("last_qtr_accrual_amt", "last_qtr_accrual_diff"), ("undisbursed_amt", "undisbursed_diff")]
_K8_OUT = ["raw_document_amt", "new_document_amt", "document_dif", "raw_disbursement_amt",
           "new_disbursement_amt", "disbursement_dif", "raw_last_qtr_accrual_amt",
           "new_last_qtr_accrual_amt", "last_qtr_accrual_diff", "raw_undisbursed_amt",
           "new_undisbursed_amt", "undisbursed_diff"]


@register("recon_ledger", O.with_ctes(f"""
SELECT award_number, activity_name, period,
  {", ".join(f"raw_{m}, new_{m}, raw_{m} - new_{m} AS {d}" for m, d in _K8_DIFF)}
FROM (
  SELECT r.award_number, r.activity_name, r.period,
    {", ".join(f"coalesce(r.raw_{m}, 0) AS raw_{m}, coalesce(n.new_{m}, 0) AS new_{m}" for m in _K8_M)}
  FROM (SELECT s.*, a.activity_name
        FROM (SELECT award_number, period, {", ".join(f"coalesce(sum({m}), 0) AS raw_{m}" for m in _K8_M)}
              FROM f_ledger GROUP BY award_number, period) s
        LEFT JOIN (SELECT DISTINCT award_number, activity_name, total_estimated_cost, period FROM f_active) a
          ON {O.ns('s', 'a', _AP)}) r
  LEFT JOIN (SELECT award_number, activity_name, period,
               {", ".join(f"coalesce(sum({m}), 0) AS new_{m}" for m in _K8_M)}
             FROM d1 GROUP BY award_number, activity_name, period) n
    ON {O.ns('r', 'n', ['award_number', 'period', 'activity_name'])}) x""", _K8_OUT), reuse=("ledger",))
def recon_ledger(f: DriverFlow) -> DataFrame:
    """K8 ledger amounts, raw vs pipeline dataset."""
    return checks.recon_ledger(f.ledger, f.active, f.pipeline)


@register("distinct_keys", O.with_ctes("SELECT DISTINCT award_number, activity_name FROM f_active"))
def distinct_keys(f: DriverFlow) -> DataFrame:
    """K9 distinct active (award, activity)."""
    return checks.distinct_activities(f.active)


@register("anti_join_keys", O.with_ctes("""
SELECT DISTINCT award_number FROM f_plan p
WHERE NOT EXISTS (SELECT 1 FROM f_active a WHERE a.award_number IS NOT DISTINCT FROM p.award_number)"""))
def anti_join_keys(f: DriverFlow) -> DataFrame:
    """K10 plan awards that are not active."""
    return checks.plan_awards_not_active(f.plan, f.active)
