"""DuckDB SQL for every registered query (the correctness oracle).

Each query is ``WITH <shared CTEs> <final select>``; DuckDB only evaluates
the CTEs a query references.  The SQL is written from the workflow's
rules, independently of the Spark code; only the fixed code tables are
shared (rendered as CASE expressions from :mod:`fundflow.config`).

Double columns are rounded to cents on both sides (sums run in different
orders in the two engines); ``+ 0.0`` turns a rounded ``-0.0`` into 0.
"""

from __future__ import annotations

from fundflow.config import (
    AREA_NAMES,
    DISTRIBUTION_FILTER,
    ELEMENT_TO_AREA,
    EVENT_TYPE_FILTER,
    NEW_AGREEMENTS,
    ORG_RECODE,
    SUB_SECTOR_RECODE,
)

NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def inlist(vals) -> str:
    return ", ".join(q(v) for v in vals)


def case_map(col: str, pairs, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in pairs)
    tail = f" ELSE {default}" if default is not None else ""
    return f"CASE {col} {whens}{tail} END"


def num(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, {q(NUM_RE)}) THEN TRY_CAST(trim({x}) AS DOUBLE) END)"


def trim_ws(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def strict(x: str, alias: str) -> str:
    return f"CASE WHEN count({x}) = count(*) THEN sum({x}) END AS {alias}"


def lenient(x: str, alias: str) -> str:
    return f"coalesce(sum({x}), 0) AS {alias}"


def fy_label(d: str) -> str:
    """Fiscal label of a date expression; NULL date -> NULL label."""
    fd = f"({d} + INTERVAL 3 MONTH)"
    return f"('FY' || CAST(year({fd}) % 100 AS VARCHAR) || 'Q' || CAST(quarter({fd}) AS VARCHAR))"


def ns(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def rounded(sql: str, cols) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, 2) + 0.0 AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) rq"


SUB_SECTOR = case_map("sub_sector", SUB_SECTOR_RECODE, "sub_sector")
ORG = case_map("u_s_org_local", ORG_RECODE, "u_s_org_local")
ELEMENT_AREA = case_map("program_element", ELEMENT_TO_AREA, "program_area")
AREA_NAME = case_map("program_area", AREA_NAMES, "program_area")
NAME_AREA = case_map("program_area", [(v, k) for k, v in AREA_NAMES])
SERIAL = "datediff('day', date '1899-12-30', CAST(l_shipdate AS DATE))"
NEW_AGREEMENT_RE = "|".join(NEW_AGREEMENTS)

ROLE_CTES = f"""
r_period AS (
  SELECT DISTINCT o_custkey AS custkey, concat('FY', year(d) % 100, 'Q', quarter(d)) AS period
  FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS d FROM orders) x),
r_award AS (
  SELECT c_mktsegment AS sector,
    CASE n_regionkey WHEN 0 THEN 'AFG' WHEN 1 THEN 'PCMD' WHEN 2 THEN 'FAMILY HEALTH' ELSE n_name END AS sub_sector,
    CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 20 = 0 THEN concat(c_name, ' MEL') ELSE c_name END AS activity_name,
    CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE concat('  AW', c_custkey, ' ') END AS award_number,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS total_estimated_cost,
    CASE WHEN c_custkey % 3 = 0 THEN '2023-10-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 00:00:00'
         ELSE lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '/01/2023' END AS start_date,
    CASE WHEN c_custkey % 7 <> 0 THEN '2027-09-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' END
      AS end_date,
    CASE n_regionkey WHEN 0 THEN 'International' WHEN 1 THEN 'US' ELSE 'Local' END AS u_s_org_local,
    concat('Manager ', c_custkey % 5) AS aor_cor_or_activity_manager,
    CASE c_custkey % 2 WHEN 0 THEN 'Core' ELSE 'OCO' END AS funding_type,
    CASE WHEN c_custkey % 4 <> 0 THEN 'Yes' END AS pepfar_funding,
    period
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN r_period ON c_custkey = custkey),
r_closeout AS (
  SELECT CASE WHEN c_custkey % 3 = 0 THEN concat('CO', c_custkey) ELSE concat('AW', c_custkey) END AS award_number,
    c_acctbal AS to_be_deobligated, CASE WHEN c_acctbal > 0 THEN 'Open' ELSE 'Closed' END AS status, period
  FROM customer JOIN r_period ON c_custkey = custkey
  WHERE c_mktsegment = 'MACHINERY'),
r_plan AS (
  SELECT concat('AW', o_custkey) AS award_number,
    CASE WHEN o_orderkey % 25 = 0 THEN 'Total' WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'Mechanism' END AS implementing_mechanism,
    CASE o_orderkey % 4 WHEN 0 THEN 'HIV/AIDS' WHEN 1 THEN 'TB' WHEN 2 THEN 'Malaria' ELSE 'Other' END AS program_area,
    CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS un_sub_obligated_funds,
    CAST(o_orderkey % 400 AS VARCHAR) AS planned_subobligations_for_the_next_months,
    CAST(o_orderkey % 600 AS VARCHAR) AS total_obligations_this_fy,
    CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 70 AS VARCHAR) END AS projected_monthly_burn_rate,
    CASE o_orderkey % 6 WHEN 0 THEN '2024-01-31' WHEN 1 THEN '24-02-28' WHEN 2 THEN '240131' WHEN 3 THEN '2024 Jan 31'
      WHEN 4 THEN '99/12/5' ELSE 'soon' END AS planned_sub_oblig_date,
    CAST(o_orderkey % 800 AS VARCHAR) AS approved_budget_cop_op,
    CAST(o_orderkey % 50 AS VARCHAR) AS unliquidated_obligations_at_the_beginning_of_the_fy,
    CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderkey % 333 AS VARCHAR) END AS bridge_amount,
    CASE WHEN o_orderkey % 6 = 0 THEN concat('note ', o_orderkey % 7) END AS comments,
    concat('FY', year(d) % 100, 'Q', quarter(d)) AS period
  FROM (SELECT *, CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS d FROM orders) x),
r_ledger AS (
  SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'ZZ' WHEN o_orderkey % 33 = 0 THEN NULL ELSE concat('AW', o_custkey) END AS award_number,
    CASE WHEN o_orderkey % 20 = 0 THEN concat('D', o_orderkey) ELSE concat('AW', o_custkey) END AS document_number,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'OBLG_UNI' WHEN '2-HIGH' THEN 'OBLG_SUBOB' ELSE 'OTHER' END AS obligation_type,
    CASE o_orderstatus WHEN 'F' THEN '656-M' WHEN 'O' THEN '656-GH-M' ELSE 'OTHER' END AS distribution,
    CASE o_orderkey % 5 WHEN 0 THEN 'A047' WHEN 1 THEN 'A048' WHEN 2 THEN 'A141' WHEN 3 THEN 'A051' END AS program_element,
    CASE WHEN o_orderkey % 3 = 0 THEN 'DR.4' END AS program_area,
    CASE o_orderkey % 3 WHEN 0 THEN '656-DOAG-656-22-019-IH' WHEN 1 THEN '656-DOAG-OLD' END AS bilateral_obl_number,
    CASE WHEN o_orderkey % 29 = 0 THEN '1,234' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS document_amt,
    CAST(o_orderkey % 700 AS VARCHAR) AS obligation_amt, CAST(o_orderkey % 650 AS VARCHAR) AS subobligation_amt,
    CAST(o_orderkey % 900 AS VARCHAR) AS disbursement_amt,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS last_qtr_accrual_amt,
    CAST(o_orderkey % 777 AS VARCHAR) AS undisbursed_amt,
    CAST(o_orderkey % 555 AS VARCHAR) AS pipeline_amt,
    concat('FY', year(d) % 100, 'Q', quarter(d)) AS period
  FROM (SELECT *, CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS d FROM orders) x),
r_txn AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'AW4' WHEN l_linenumber = 1 THEN 'ZZ' WHEN l_linenumber = 2 THEN NULL
              ELSE concat('AW', o_custkey) END AS award_number,
    CASE WHEN l_linenumber = 1 THEN concat('AW', o_custkey) ELSE concat('D', l_orderkey, '-', l_linenumber) END
      AS document_number,
    concat('AW', o_custkey) AS obl_document_number,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST({SERIAL} AS VARCHAR) END AS transaction_date,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS transaction_amt,
    CASE WHEN l_linestatus = 'F' THEN 'DISB' ELSE 'OBLG' END AS transaction_event,
    CASE l_returnflag WHEN 'A' THEN 'OBLG_SUBOB' WHEN 'R' THEN 'OBLG_UNI' ELSE 'OTHER' END AS transaction_event_type,
    CASE l_linenumber % 4 WHEN 0 THEN 'A047' WHEN 1 THEN 'A048' WHEN 2 THEN 'A141' END AS program_element,
    CASE WHEN l_orderkey % 2 = 0 THEN 'DR.4' END AS program_area,
    CASE WHEN l_discount > 0.07 THEN 'OTHER' ELSE '656-W' END AS distribution
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PLAN_NUM = ["un_sub_obligated_funds", "planned_subobligations_for_the_next_months", "total_obligations_this_fy",
            "projected_monthly_burn_rate", "approved_budget_cop_op",
            "unliquidated_obligations_at_the_beginning_of_the_fy", "bridge_amount"]


def ymd(x: str) -> str:
    """Year-month-day text in the layouts that the role extracts write."""
    layouts = ((r"^\d{4}-", "%Y-%m-%d"), (r"^\d{4}/", "%Y/%m/%d"), (r"^\d{2}-", "%y-%m-%d"), (r"^\d{2}/", "%y/%m/%d"),
               (r"^\d{8}$", "%Y%m%d"), (r"^\d{6}$", "%y%m%d"), (r"^\d{4} [A-Z]", "%Y %b %d"))
    whens = " ".join(f"WHEN regexp_matches({x}, {q(p)}) THEN try_strptime({x}, {q(f)})" for p, f in layouts)
    return f"CAST(CASE {whens} END AS DATE)"


YMD = ymd("planned_sub_oblig_date")

FEED_CTES = f"""
f_active AS (
  SELECT * FROM (
    SELECT {SUB_SECTOR} AS sub_sector, activity_name, {trim_ws('award_number')} AS award_number,
      coalesce(total_estimated_cost, 0) AS total_estimated_cost, start_date, end_date, {ORG} AS u_s_org_local,
      aor_cor_or_activity_manager, funding_type, pepfar_funding, period
    FROM r_award WHERE sector = 'BUILDING') x
  WHERE award_number IS NOT NULL AND NOT regexp_matches(activity_name, 'MEL')),
f_expired AS (
  SELECT * FROM (
    SELECT sector, {SUB_SECTOR} AS sub_sector, activity_name, {trim_ws('award_number')} AS award_number,
      end_date, {ORG} AS u_s_org_local, aor_cor_or_activity_manager, funding_type, period
    FROM r_award WHERE sector = 'MACHINERY') x
  WHERE award_number IS NOT NULL),
f_closeout AS (
  SELECT * FROM (
    SELECT {trim_ws('award_number')} AS award_number, to_be_deobligated, status, period FROM r_closeout) x
  WHERE award_number IS NOT NULL),
f_plan AS (
  SELECT * FROM (
    SELECT {trim_ws('award_number')} AS award_number,
      {", ".join(f"coalesce({num(c)}, 0) AS {c}" for c in PLAN_NUM)},
      {YMD} AS planned_sub_oblig_date, comments, period, {NAME_AREA} AS program_area
    FROM r_plan WHERE implementing_mechanism <> 'Total') x
  WHERE award_number IS NOT NULL),
k_active AS (SELECT DISTINCT award_number FROM f_active),
k_expired AS (SELECT DISTINCT award_number FROM f_expired),
k_all AS (SELECT award_number FROM k_active UNION SELECT award_number FROM k_expired),
l_lines AS (
  SELECT award_number, document_number, bilateral_obl_number, period,
    {num('document_amt')} AS document_amt, {num('disbursement_amt')} AS disbursement_amt,
    {num('undisbursed_amt')} AS undisbursed_amt, {num('last_qtr_accrual_amt')} AS last_qtr_accrual_amt,
    {num('pipeline_amt')} AS pipeline_amt, {ELEMENT_AREA} AS program_area
  FROM r_ledger
  WHERE obligation_type IN ({inlist(EVENT_TYPE_FILTER)}) AND distribution IN ({inlist(DISTRIBUTION_FILTER)})),
l_keyed AS (
  SELECT *, CASE WHEN award_number IN (SELECT award_number FROM k_all) THEN award_number
                 WHEN document_number IN (SELECT award_number FROM k_all) THEN document_number END AS rkey
  FROM l_lines),
f_ledger AS (
  SELECT rkey AS award_number, period, program_area, bilateral_obl_number,
    {strict('document_amt', 'document_amt')}, {strict('disbursement_amt', 'disbursement_amt')},
    {strict('undisbursed_amt', 'undisbursed_amt')}, {strict('last_qtr_accrual_amt', 'last_qtr_accrual_amt')},
    {strict('pipeline_amt', 'pipeline_amt')},
    {strict('disbursement_amt + last_qtr_accrual_amt', 'total_disbursement_outlays')}
  FROM l_keyed WHERE rkey IS NOT NULL
  GROUP BY rkey, period, program_area, bilateral_obl_number),
t_lines AS (
  SELECT award_number, document_number, obl_document_number, transaction_event, transaction_event_type,
    {num('transaction_amt')} AS transaction_amt,
    CAST(date_trunc('quarter', date '1899-12-30' + CAST(floor({num('transaction_date')} - 1) AS INTEGER)) AS DATE) AS qd,
    {ELEMENT_AREA} AS program_area
  FROM r_txn WHERE distribution IN ({inlist(DISTRIBUTION_FILTER)})),
t_keyed AS (
  SELECT *, CASE WHEN award_number IN (SELECT award_number FROM k_active) THEN award_number
                 WHEN document_number IN (SELECT award_number FROM k_active) THEN document_number
                 WHEN obl_document_number IN (SELECT award_number FROM k_active) THEN obl_document_number END AS rkey
  FROM t_lines),
t_measures AS (
  SELECT rkey AS award_number, program_area, transaction_amt,
    CASE WHEN transaction_event = 'DISB' THEN transaction_amt END AS transaction_disbursement,
    CASE WHEN transaction_event_type IN ('OBLG_SUBOB', 'OBLG_UNI') THEN transaction_amt END AS transaction_obligation,
    coalesce({fy_label('qd')}, 'FYNAQNA') AS period
  FROM t_keyed WHERE rkey IS NOT NULL),
t_sum AS (
  SELECT award_number, period, program_area,
    {lenient('transaction_amt', 'transaction_amt')},
    {lenient('transaction_disbursement', 'transaction_disbursement')},
    {lenient('transaction_obligation', 'transaction_obligation')},
    {lenient('transaction_disbursement / 3', 'avg_monthly_exp_rate')}
  FROM t_measures GROUP BY award_number, period, program_area),
f_txn AS (
  SELECT award_number,
    CAST(TRY_CAST(substr(split_part(period, 'Q', 1), 3, 2) AS DOUBLE) + 2000 AS INTEGER) AS fiscal_year,
    CAST(TRY_CAST(split_part(period, 'Q', 2) AS DOUBLE) AS INTEGER) AS quarter,
    period, program_area, transaction_amt, transaction_disbursement, transaction_obligation, avg_monthly_exp_rate
  FROM t_sum),
d0 AS (
  SELECT award_number, period, program_area, transaction_amt, transaction_disbursement,
    transaction_obligation, avg_monthly_exp_rate,
    sum(transaction_disbursement) OVER (PARTITION BY award_number, fiscal_year, program_area ORDER BY quarter
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_transaction_disbursement_fy
  FROM f_txn)"""

LEDGER_NUM = ["document_amt", "disbursement_amt", "undisbursed_amt", "last_qtr_accrual_amt",
              "pipeline_amt", "total_disbursement_outlays"]
TXN_NUM = ["transaction_amt", "transaction_disbursement", "transaction_obligation", "avg_monthly_exp_rate"]
D0_NUM = TXN_NUM + ["cumulative_transaction_disbursement_fy"]
D1_NUM = ["total_estimated_cost", *LEDGER_NUM, *PLAN_NUM, *D0_NUM]


def _zero(cols) -> str:
    return ", ".join(f"coalesce({c}, 0) AS {c}" for c in cols)


DATASET_CTES = f"""
d1_j AS (
  SELECT a.*, l.program_area, l.bilateral_obl_number, {", ".join("l." + c for c in LEDGER_NUM)}
  FROM f_active a LEFT JOIN f_ledger l ON {ns('a', 'l', ['award_number', 'period'])}),
d1_p AS (
  SELECT j.*, p.* EXCLUDE (award_number, period, program_area)
  FROM d1_j j LEFT JOIN f_plan p ON {ns('j', 'p', ['award_number', 'period', 'program_area'])}),
d1_t AS (
  SELECT j.*, {", ".join("t." + c for c in D0_NUM)}
  FROM d1_p j LEFT JOIN d0 t ON {ns('j', 't', ['award_number', 'period', 'program_area'])}),
d1_z AS (
  SELECT * REPLACE ({_zero(D1_NUM)}), {AREA_NAME} AS program_area_name FROM d1_t),
d1_c AS (SELECT DISTINCT award_number, period, comments FROM d1_z WHERE comments IS NOT NULL),
d1 AS (
  SELECT z.* EXCLUDE (comments), c.comments
  FROM d1_z z LEFT JOIN d1_c c ON {ns('z', 'c', ['award_number', 'period'])}),
d1_latest AS (SELECT * FROM d1 WHERE period = (SELECT max(period) FROM d1)),
d2_accrual AS (
  SELECT award_number, period, program_area, {lenient('last_qtr_accrual_amt', 'last_qtr_accrual_amt')}
  FROM d1_latest GROUP BY award_number, period, program_area),
d2_base AS (
  SELECT b.award_number, b.activity_name, t.transaction_disbursement, t.transaction_obligation,
    t.transaction_amt, t.avg_monthly_exp_rate, t.period, t.program_area
  FROM (SELECT DISTINCT award_number, activity_name FROM f_active) b
  LEFT JOIN d0 t ON {ns('b', 't', ['award_number'])}),
d2 AS (
  SELECT * REPLACE ({_zero(['transaction_disbursement', 'transaction_obligation', 'transaction_amt',
                            'avg_monthly_exp_rate', 'last_qtr_accrual_amt'])}),
    {AREA_NAME} AS program_area_name
  FROM (SELECT b.*, a.last_qtr_accrual_amt FROM d2_base b
        LEFT JOIN d2_accrual a ON {ns('b', 'a', ['award_number', 'period', 'program_area'])}) x),
d3_pipe AS (
  SELECT award_number, period, bilateral_obl_number, {lenient('undisbursed_amt', 'undisbursed_amt')},
    CASE WHEN regexp_matches(bilateral_obl_number, {q(NEW_AGREEMENT_RE)}) THEN 'new' ELSE 'old' END AS doag_new_old
  FROM f_ledger WHERE award_number IN (SELECT award_number FROM f_expired)
  GROUP BY award_number, period, bilateral_obl_number),
d3_j AS (
  SELECT e.*, p.bilateral_obl_number, p.undisbursed_amt, p.doag_new_old, c.to_be_deobligated, c.status
  FROM f_expired e
  LEFT JOIN d3_pipe p ON {ns('e', 'p', ['award_number', 'period'])}
  LEFT JOIN f_closeout c ON {ns('e', 'c', ['award_number', 'period'])}),
d3 AS (SELECT * FROM d3_j WHERE period = (SELECT max(period) FROM d3_j))"""

PREFIX = "WITH " + ",".join([ROLE_CTES, FEED_CTES, DATASET_CTES])


def with_ctes(final_select: str, money=()) -> str:
    return PREFIX + "\n" + rounded(final_select, money)
