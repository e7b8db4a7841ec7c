"""Operator-level registered queries: one per scan / filter / scalar /
join / aggregate / window building block, each over whole driver tables
(through the role extracts where the operator needs feed-shaped input)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.config import (
    DISTRIBUTION_FILTER,
    EVENT_TYPE_FILTER,
    LEDGER_HEADER_DRIFT,
    PLAN_HEADER_DRIFT,
    NEW_AGREEMENTS,
    ORG_RECODE,
    REMOVE_AWARDS,
    SUB_SECTOR_RECODE,
)
from fundflow.functions import (
    area_code_from_name,
    area_from_element,
    area_name,
    fiscal_period,
    matches_any,
    parse_period,
    parse_ymd,
    period_from_filename,
    quarter_start,
    recode,
    serial_to_date,
    text_to_number,
    trim_ws,
)
from fundflow.operators import (
    in_keys,
    keys_df,
    latest_period,
    left_join_ns,
    max_all_numeric,
    nan_to_null,
    resolve_key,
    running_total,
    shared_dir,
    spread_attribute,
    sum_all_numeric,
    zero_fill_numeric,
)
from fundflow.operators.hot_keys import left_join_hot
from fundflow.plans import datasets, feeds, increments
from fundflow.plans import oracle as O
from fundflow.plans.registry import register
from fundflow.plans.roles import DriverFlow, excel_serial
from fundflow.sources import (normalize_headers, read_csv_folder, read_csv_output, read_deliveries, rename_drift,
                              sync_landing, union_all_by_name, write_csv)

AP = ["award_number", "period"]
APA = ["award_number", "period", "program_area"]
MONEY = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"


def _money_text(c):
    return c.cast("decimal(18,2)").cast("string")


def _orders_label() -> str:
    return "concat('FY', year(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH) % 100, 'Q', " \
           "quarter(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH))"


# --- sources / sinks (S1-S7) -------------------------------------------------

@register("scan_union_by_name", O.with_ctes("""
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL BY NAME
SELECT s_name AS name, s_suppkey AS key, s_acctbal AS balance, s_nationkey AS nationkey FROM supplier""",
    ["balance"]))
def scan_union_by_name(f: DriverFlow) -> DataFrame:
    """Union by column name, columns missing on one side -> NULL."""
    c = f.t("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                               F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = f.t("supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"),
                               F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nationkey"))
    return union_all_by_name([c, s])


@register("period_from_filename", O.with_ctes(f"""
SELECT o_orderkey, file_name, nullif(regexp_extract(file_name, '^[^_]+'), '') AS period
FROM (SELECT o_orderkey,
        CASE o_orderkey % 3 WHEN 0 THEN label || '_ledger.xlsx' WHEN 1 THEN '_' || label || '.csv'
             ELSE label || '.csv' END AS file_name
      FROM (SELECT o_orderkey, {_orders_label()} AS label FROM orders) x) y"""))
def period_from_filename_q(f: DriverFlow) -> DataFrame:
    """period = file name up to the first underscore (NULL if none before it)."""
    o = f.t("orders")
    label = fiscal_period(F.to_date("o_orderdate"), null_label=None)
    k = F.col("o_orderkey") % 3
    name = (F.when(k == 0, F.concat(label, F.lit("_ledger.xlsx")))
             .when(k == 1, F.concat(F.lit("_"), label, F.lit(".csv")))
             .otherwise(F.concat(label, F.lit(".csv"))))
    df = o.select("o_orderkey", name.alias("file_name"))
    return df.withColumn("period", period_from_filename("file_name"))


@register("normalize_headers", O.with_ctes("""
SELECT c_custkey AS customer_key, c_name AS customer_name_local, c_nationkey AS nation_key,
  c_acctbal AS balance_percent, c_custkey AS award_number, c_mktsegment AS u_s_org_local,
  c_nationkey AS customer_key_2, c_name AS x2024_name, c_custkey AS amount, c_nationkey AS amount_2, c_custkey + 1 AS amount_2_2
FROM customer""", ["balance_percent"]))
def normalize_headers_q(f: DriverFlow) -> DataFrame:
    """S3: spreadsheet headers -> snake_case (with %/# words, de-duplication)."""
    c = f.t("customer")
    df = c.select(F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Customer Name (Local)"),
                  F.col("c_nationkey").alias("NationKey"), F.col("c_acctbal").alias("Balance %"),
                  F.col("c_custkey").alias("Award #"), F.col("c_mktsegment").alias("U.S. Org (Local)"),
                  F.col("c_nationkey").alias("customer key"), F.col("c_name").alias("2024 Name"),
                  F.col("c_custkey").alias("Amount"), F.col("c_nationkey").alias("amount"),
                  (F.col("c_custkey") + 1).alias("Amount 2"))
    return normalize_headers(df)


@register("rename_drift", O.with_ctes("SELECT o_orderkey, o_totalprice AS last_qtr_accrual_amt FROM orders",
                                      ["last_qtr_accrual_amt"]))
def rename_drift_q(f: DriverFlow) -> DataFrame:
    """Old header renamed per file before a by-name union."""
    o = f.t("orders").withColumn("yr", F.year("o_orderdate"))
    old = o.filter(F.col("yr") < 1998).select("o_orderkey", F.col("o_totalprice").alias("last_qtr_adj_amt"))
    new = o.filter(F.col("yr") >= 1998).select(F.col("o_totalprice").alias("last_qtr_accrual_amt"), "o_orderkey")
    return union_all_by_name([rename_drift(old, LEDGER_HEADER_DRIFT), rename_drift(new, LEDGER_HEADER_DRIFT)])


_AMOUNT_TEXT_SQL = f"""
CASE WHEN o_orderkey % 29 = 0 THEN '1,234' WHEN o_orderkey % 31 = 0 THEN 'x'
     WHEN o_orderkey % 37 = 0 THEN '7d' WHEN o_orderkey % 41 = 0 THEN ' ' || {MONEY.format('o_totalprice')} || ' '
     WHEN o_orderkey % 43 = 0 THEN '1.5e3' ELSE {MONEY.format('o_totalprice')} END"""


@register("text_ingest_cast", O.with_ctes(f"""
SELECT o_orderkey, amount_text, {O.num('amount_text')} AS amount
FROM (SELECT o_orderkey, {_AMOUNT_TEXT_SQL} AS amount_text FROM orders) x""", ["amount"]))
def text_ingest_cast(f: DriverFlow) -> DataFrame:
    """Amounts as text -> double; bad text ('1,234', 'x', '7d') -> NULL."""
    k = F.col("o_orderkey")
    m = _money_text(F.col("o_totalprice"))
    text = (F.when(k % 29 == 0, F.lit("1,234")).when(k % 31 == 0, F.lit("x"))
             .when(k % 37 == 0, F.lit("7d")).when(k % 41 == 0, F.concat(F.lit(" "), m, F.lit(" ")))
             .when(k % 43 == 0, F.lit("1.5e3")).otherwise(m))
    df = feeds.text_ingest(f.t("orders").select("o_orderkey", text.alias("amount_text")), keep=("o_orderkey",))
    return df.withColumn("amount", text_to_number("amount_text"))


@register("csv_roundtrip", O.with_ctes("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
  CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN c_name || ', "quoted"' ELSE c_name END AS name,
  CASE c_custkey % 4 WHEN 0 THEN '12345678.9' WHEN 1 THEN '0.0001' WHEN 2 THEN '-120000000000000000000'
       ELSE regexp_replace(CAST(c_acctbal AS VARCHAR), '\\.0$', '') END AS amount,
  strftime(TIMESTAMP '2023-10-01' + to_hours(CAST(c_custkey % 1000 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS stamped
FROM customer"""))
def csv_roundtrip(f: DriverFlow) -> DataFrame:
    """CSV sink (header, NULL as NA, quoting, plain decimals, UTC), read back as written text."""
    k = F.col("c_custkey")
    name = (F.when(k % 7 == 0, F.lit(None).cast("string"))
             .when(k % 5 == 0, F.concat(F.col("c_name"), F.lit(', "quoted"'))).otherwise(F.col("c_name")))
    amount = (F.when(k % 4 == 0, F.lit(12345678.9)).when(k % 4 == 1, F.lit(0.0001)).when(k % 4 == 2, F.lit(-1.2e20))
               .otherwise(F.col("c_acctbal")))
    stamp = F.timestamp_seconds(F.unix_timestamp(F.lit("2023-10-01 00:00:00Z"), "yyyy-MM-dd HH:mm:ssX") + k % 1000 * 3600)
    df = f.t("customer").select("c_custkey", name.alias("name"), amount.alias("amount"), stamp.alias("stamped"))
    path = f"{shared_dir(f.spark)}/fundflow-out/customers-{uuid.uuid4().hex}"
    write_csv(df, path)
    return read_csv_output(f.spark, path, "c_custkey string, name string, amount string, stamped string")


# The last two clean to one name.
_LANDED = ["Award Number", "Implementing Mechanism", "Program Area", "Un-Sub-Obligated Funds", "Comments", "Amount",
           "Amount:"]


@register("landing_scan", O.with_ctes("""
SELECT award_number, implementing_mechanism, program_area, un_sub_obligated_funds, comments,
  planned_subobligations_for_the_next_months AS amount, total_obligations_this_fy AS amount_2,
  CASE WHEN substr(period, -1) <= '2' THEN NULL ELSE bridge_amount END AS bridge_amount,
  unliquidated_obligations_at_the_beginning_of_the_fy,
  'FY00Q' || substr(period, -1) AS period, 'FY00Q' || substr(period, -1) || '_plan.csv' AS source_file
FROM r_plan"""))
def landing_scan(f: DriverFlow) -> DataFrame:
    """The plan extract written as CSV period files with two
    header layouts (an old column name, a repeated header, an added column),
    scanned as one folder."""
    folder = f"{shared_dir(f.spark)}/fundflow-out/landing-{uuid.uuid4().hex}"
    old, new = PLAN_HEADER_DRIFT[0]
    for quarter in "1234":
        late = quarter > "2"
        df = f.raw_plan.filter(F.col("period").endswith(quarter))
        df = df.select("award_number", "implementing_mechanism", "program_area", "un_sub_obligated_funds", "comments",
                       "planned_subobligations_for_the_next_months", "total_obligations_this_fy", new,
                       *(["bridge_amount"] if late else []))
        df = df.toDF(*_LANDED, new if late else old, *(["Bridge Amount"] if late else []))
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/FY00Q{quarter}_plan.csv")
    return read_csv_folder(f.spark, folder, PLAN_HEADER_DRIFT, pattern="FY*.csv")


@register("landing_manifest", O.with_ctes("""
SELECT award_number, CASE WHEN quarter = '2' THEN 'corrected' ELSE implementing_mechanism END AS implementing_mechanism,
  un_sub_obligated_funds, 'FY00Q' || quarter AS period, 'FY00Q' || quarter || '_plan.csv' AS source_file,
  CASE WHEN quarter = '1' THEN 1 ELSE 2 END AS delivery
FROM (SELECT *, substr(period, -1) AS quarter FROM r_plan) x
WHERE quarter IN ('1', '4') OR quarter = '2' AND comments IS NOT NULL"""))
def landing_manifest(f: DriverFlow) -> DataFrame:
    """S1 re-delivery: three period files are synced, then one is corrected
    (fewer rows, another value), one withdrawn and one added; only the
    corrected and the added one are read by the second sync."""
    root = f"{shared_dir(f.spark)}/fundflow-out/landed-{uuid.uuid4().hex}"

    def land(quarter: str, df: DataFrame) -> None:
        (df.filter(F.col("period").endswith(quarter))
         .select("award_number", "implementing_mechanism", "un_sub_obligated_funds").toDF(*_LANDED[:2], _LANDED[3])
         .write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{root}/in/FY00Q{quarter}_plan.csv"))

    for quarter in "123":
        land(quarter, f.raw_plan)
    sync_landing(f.spark, f"{root}/in", f"{root}/table")
    corrected = f.raw_plan.filter("comments IS NOT NULL").withColumn("implementing_mechanism", F.lit("corrected"))
    land("2", corrected)
    land("4", f.raw_plan)
    sync_landing(f.spark, f"{root}/in", f"{root}/table", pattern="FY00Q[124]*")
    return read_deliveries(f.spark, f"{root}/table")


# --- filters and predicates (P6-P13) ----------------------------------------

@register("filter_sector", O.with_ctes("SELECT * FROM r_award WHERE sector = 'BUILDING'", ["total_estimated_cost"]))
def filter_sector(f: DriverFlow) -> DataFrame:
    """Equality filter on a constant (sector)."""
    return f.raw_award.filter(F.col("sector") == F.lit(f.cfg.active_sector))


@register("drop_total_rows", O.with_ctes("SELECT * FROM r_plan WHERE implementing_mechanism <> 'Total'"))
def drop_total_rows(f: DriverFlow) -> DataFrame:
    """Inequality filter that also drops NULLs."""
    return f.raw_plan.filter(F.col("implementing_mechanism") != F.lit("Total"))


@register("filter_in_list", O.with_ctes(f"""
SELECT * FROM r_ledger WHERE obligation_type IN ({O.inlist(EVENT_TYPE_FILTER)})
  AND distribution IN ({O.inlist(DISTRIBUTION_FILTER)})"""))
def filter_in_list(f: DriverFlow) -> DataFrame:
    """Static IN-list filters on two columns."""
    return f.raw_ledger.filter(F.col("obligation_type").isin(*EVENT_TYPE_FILTER)
                               & F.col("distribution").isin(*DISTRIBUTION_FILTER))


@register("filter_not_regex", O.with_ctes(
    f"SELECT * FROM r_award WHERE NOT regexp_matches(activity_name, {O.q('|'.join(REMOVE_AWARDS))})",
    ["total_estimated_cost"]))
def filter_not_regex(f: DriverFlow) -> DataFrame:
    """P10: drop rows whose name contains an excluded fragment (NULL names dropped)."""
    return f.raw_award.filter(~matches_any("activity_name", REMOVE_AWARDS))


@register("drop_null_keys", O.with_ctes("SELECT * FROM r_award WHERE award_number IS NOT NULL",
                                        ["total_estimated_cost"]))
def drop_null_keys(f: DriverFlow) -> DataFrame:
    """Keep rows with a non-NULL key."""
    return f.raw_award.dropna(subset=["award_number"])


@register("semi_join_keys", O.with_ctes(
    "SELECT * FROM r_ledger WHERE award_number IN (SELECT award_number FROM k_active)"))
def semi_join_keys(f: DriverFlow) -> DataFrame:
    """Dynamic IN-list as a semi join against the active key set."""
    return in_keys(f.raw_ledger, f.active_keys)


@register("all_keys", O.with_ctes("SELECT award_number FROM k_all"))
def all_keys(f: DriverFlow) -> DataFrame:
    """Active + expired keys, de-duplicated."""
    return keys_df(f.all_keys)


@register("latest_period", O.with_ctes(
    "SELECT * FROM f_expired WHERE period = (SELECT max(period) FROM f_expired)"))
def latest_period_q(f: DriverFlow) -> DataFrame:
    """Rows of the latest (string-max) period."""
    return latest_period(f.expired)


@register("latest_by_statistics", O.with_ctes(
    "SELECT * FROM f_expired WHERE period = (SELECT max(period) FROM f_expired)"))
def latest_by_statistics(f: DriverFlow) -> DataFrame:
    """The same rows of the written list, the maximum from its files' statistics."""
    return f.expired_latest


# --- scalar functions (C1-C21) -----------------------------------------------

@register("trim_keys", O.with_ctes(
    f"SELECT award_number AS raw_award_number, {O.trim_ws('award_number')} AS award_number FROM r_award"))
def trim_keys(f: DriverFlow) -> DataFrame:
    """Trim all white space at both ends."""
    return f.raw_award.select(F.col("award_number").alias("raw_award_number"),
                              trim_ws("award_number").alias("award_number"))


@register("recode_values", O.with_ctes(f"""
SELECT sub_sector AS raw_sub_sector, {O.SUB_SECTOR} AS sub_sector,
       u_s_org_local AS raw_u_s_org_local, {O.ORG} AS u_s_org_local FROM r_award"""))
def recode_values(f: DriverFlow) -> DataFrame:
    """Value recodes, unmatched values pass through."""
    return f.raw_award.select(
        F.col("sub_sector").alias("raw_sub_sector"), recode("sub_sector", SUB_SECTOR_RECODE).alias("sub_sector"),
        F.col("u_s_org_local").alias("raw_u_s_org_local"), recode("u_s_org_local", ORG_RECODE).alias("u_s_org_local"))


@register("map_codes_fallback", O.with_ctes(
    f"SELECT program_element, program_area AS raw_program_area, {O.ELEMENT_AREA} AS program_area FROM r_txn"))
def map_codes_fallback(f: DriverFlow) -> DataFrame:
    """Program element -> area code, falling back to the row's area."""
    return f.raw_txn.select("program_element", F.col("program_area").alias("raw_program_area"),
                            area_from_element("program_element", "program_area").alias("program_area"))


@register("map_codes_names", O.with_ctes(f"""
SELECT program_area, {O.AREA_NAME} AS program_area_name
FROM (SELECT {O.ELEMENT_AREA} AS program_area FROM r_txn) x"""))
def map_codes_names(f: DriverFlow) -> DataFrame:
    """Area code -> area name, unknown codes fall back to the code."""
    df = f.raw_txn.select(area_from_element("program_element", "program_area").alias("program_area"))
    return df.withColumn("program_area_name", area_name("program_area"))


@register("map_names_codes", O.with_ctes(
    f"SELECT program_area AS program_area_name, {O.NAME_AREA} AS program_area FROM r_plan"))
def map_names_codes(f: DriverFlow) -> DataFrame:
    """Area name -> area code, unknown names -> NULL."""
    return f.raw_plan.select(F.col("program_area").alias("program_area_name"),
                             area_code_from_name("program_area").alias("program_area"))


def _injected_balance():
    k = F.col("c_custkey")
    return (F.when(k % 11 == 0, F.lit(None).cast("double"))
             .when(k % 13 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")))


_INJECTED_SQL = """(SELECT c_custkey, c_name, CASE WHEN c_custkey % 11 = 0 THEN NULL
  WHEN c_custkey % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS balance FROM customer)"""


@register("zero_fill_numeric", O.with_ctes(f"""
SELECT c_custkey, c_name, coalesce(CASE WHEN isnan(balance) THEN NULL ELSE balance END, 0) AS balance
FROM {_INJECTED_SQL} x""", ["balance"]))
def zero_fill_numeric_q(f: DriverFlow) -> DataFrame:
    """NULL and NaN -> 0 in every numeric column (chosen by type)."""
    return zero_fill_numeric(f.t("customer").select("c_custkey", "c_name", _injected_balance().alias("balance")))


@register("nan_to_null", O.with_ctes(f"""
SELECT c_custkey, c_name, CASE WHEN isnan(balance) THEN NULL ELSE balance END AS balance
FROM {_INJECTED_SQL} x""", ["balance"]))
def nan_to_null_q(f: DriverFlow) -> DataFrame:
    """C11: NaN -> NULL in every floating column."""
    return nan_to_null(f.t("customer").select("c_custkey", "c_name", _injected_balance().alias("balance")))


@register("parse_ymd", O.with_ctes(f"""
SELECT o_orderkey, date_text, {O.ymd('date_text')} AS planned_date
FROM (SELECT o_orderkey,
        CASE WHEN o_orderkey % 17 = 0 THEN 'not a date'
             ELSE CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
               WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 2 THEN strftime(o_orderdate, '%Y%m%d')
               WHEN 3 THEN strftime(o_orderdate, '%y-%m-%d') WHEN 4 THEN strftime(o_orderdate, '%y%m%d')
               ELSE strftime(o_orderdate, '%Y %b %d') END END AS date_text
      FROM orders) x"""))
def parse_ymd_q(f: DriverFlow) -> DataFrame:
    """Year-month-day text in several layouts -> date; bad text -> NULL."""
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    layouts = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "yy-MM-dd", "yyMMdd", "yyyy MMM dd")
    text = F.when(k % 17 == 0, F.lit("not a date"))
    for i, layout in enumerate(layouts):
        text = text.when(k % 6 == i, F.date_format(d, layout))
    df = f.t("orders").select("o_orderkey", text.alias("date_text"))
    return df.withColumn("planned_date", parse_ymd("date_text"))


_SERIAL_TEXT_SQL = f"""(SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 3 THEN CAST({O.SERIAL} AS VARCHAR) || '.9' WHEN 4 THEN 'abc'
       ELSE CAST({O.SERIAL} AS VARCHAR) END AS serial_text FROM lineitem)"""


def _serial_text(f: DriverFlow) -> DataFrame:
    ln = F.col("l_linenumber")
    serial = excel_serial(F.col("l_shipdate")).cast("string")
    text = (F.when(ln == 3, F.concat(serial, F.lit(".9"))).when(ln == 4, F.lit("abc")).otherwise(serial))
    return f.t("lineitem").select("l_orderkey", "l_linenumber", text.alias("serial_text"))


_SERIAL_DATE_SQL = f"date '1899-12-30' + CAST(floor({O.num('serial_text')} - 1) AS INTEGER)"


@register("serial_to_date", O.with_ctes(f"""
SELECT l_orderkey, l_linenumber, serial_text, {_SERIAL_DATE_SQL} AS txn_date FROM {_SERIAL_TEXT_SQL} x"""))
def serial_to_date_q(f: DriverFlow) -> DataFrame:
    """Spreadsheet serial text -> date, one day earlier, fraction floored."""
    return _serial_text(f).withColumn("txn_date", serial_to_date("serial_text", f.cfg.serial_offset_days))


@register("fiscal_period", O.with_ctes(f"""
SELECT l_orderkey, l_linenumber, quarter_start, coalesce({O.fy_label('quarter_start')}, 'FYNAQNA') AS period
FROM (SELECT l_orderkey, l_linenumber,
        CAST(date_trunc('quarter', {_SERIAL_DATE_SQL}) AS DATE) AS quarter_start FROM {_SERIAL_TEXT_SQL} x) y"""))
def fiscal_period_q(f: DriverFlow) -> DataFrame:
    """Quarter floor, +3 months, FY<yy>Q<q> label (NULL date -> FYNAQNA)."""
    df = _serial_text(f).select(
        "l_orderkey", "l_linenumber",
        quarter_start(serial_to_date("serial_text", f.cfg.serial_offset_days)).alias("quarter_start"))
    return df.withColumn("period", fiscal_period("quarter_start", f.cfg.null_period_label))


@register("parse_period", O.with_ctes(f"""
SELECT period,
  CAST(TRY_CAST(substr(split_part(period, 'Q', 1), 3, 2) AS DOUBLE) + 2000 AS INTEGER) AS fiscal_year,
  CAST(TRY_CAST(split_part(period, 'Q', 2) AS DOUBLE) AS INTEGER) AS quarter
FROM (SELECT DISTINCT coalesce({O.fy_label('qs')}, 'FYNAQNA') AS period
      FROM (SELECT CAST(date_trunc('quarter', {_SERIAL_DATE_SQL}) AS DATE) AS qs FROM {_SERIAL_TEXT_SQL} x) y) z"""))
def parse_period_q(f: DriverFlow) -> DataFrame:
    """Label -> fiscal year (2000 + yy) and quarter; FYNAQNA -> NULLs."""
    labels = _serial_text(f).select(
        fiscal_period(quarter_start(serial_to_date("serial_text", f.cfg.serial_offset_days)),
                      f.cfg.null_period_label).alias("period")).distinct()
    fy, q = parse_period("period")
    return labels.select("period", fy.alias("fiscal_year"), q.alias("quarter"))


@register("conditional_measures", O.with_ctes(f"""
SELECT award_number, document_number, obl_document_number, qd AS transaction_date,
  coalesce({O.fy_label('qd')}, 'FYNAQNA') AS period, program_area, transaction_amt,
  CASE WHEN transaction_event = 'DISB' THEN transaction_amt END AS transaction_disbursement,
  CASE WHEN transaction_event_type IN ('OBLG_SUBOB', 'OBLG_UNI') THEN transaction_amt END AS transaction_obligation,
  CASE WHEN transaction_event = 'DISB' THEN transaction_amt END / 3 AS avg_monthly_exp_rate
FROM t_lines""", list(feeds.TXN_MEASURES)))
def conditional_measures(f: DriverFlow) -> DataFrame:
    """Disbursement / obligation picked by event, monthly rate = /3."""
    return feeds.transaction_measures(f.raw_txn, f.cfg)


@register("resolve_key_2", O.with_ctes("""
SELECT rkey AS award_number, document_number, bilateral_obl_number, period, program_area, document_amt
FROM l_keyed WHERE rkey IS NOT NULL""", ["document_amt"]))
def resolve_key_2(f: DriverFlow) -> DataFrame:
    """Award if a known award, else document number; neither -> dropped."""
    df = resolve_key(feeds.ledger_lines(f.raw_ledger, f.cfg), f.all_keys, feeds.LEDGER_CANDIDATES)
    return df.select("award_number", "document_number", "bilateral_obl_number", "period", "program_area",
                     "document_amt")


@register("resolve_key_3", O.with_ctes(f"""
SELECT rkey AS award_number, qd AS transaction_date, coalesce({O.fy_label('qd')}, 'FYNAQNA') AS period,
  program_area, transaction_amt
FROM t_keyed WHERE rkey IS NOT NULL""", ["transaction_amt"]))
def resolve_key_3(f: DriverFlow) -> DataFrame:
    """3-step resolution (award, document, obligating document), active keys."""
    return feeds.transaction_lines(f.raw_txn, f.active_keys, f.cfg).select(
        "award_number", "transaction_date", "period", "program_area", "transaction_amt")


@register("resolve_key_3_shuffled", O.with_ctes(f"""
SELECT rkey AS award_number, qd AS transaction_date, coalesce({O.fy_label('qd')}, 'FYNAQNA') AS period,
  program_area, transaction_amt
FROM t_keyed WHERE rkey IS NOT NULL""", ["transaction_amt"]))
def resolve_key_3_shuffled(f: DriverFlow) -> DataFrame:
    """C21 with a key set of unknown size: one salted shuffle join."""
    return feeds.transaction_lines(f.raw_txn, keys_df(f.active_keys), f.cfg, f.resolved).select(
        "award_number", "transaction_date", "period", "program_area", "transaction_amt")


@register("ledger_rollup_shuffled", O.with_ctes("SELECT * FROM f_ledger", O.LEDGER_NUM))
def ledger_rollup_shuffled(f: DriverFlow) -> DataFrame:
    """F5 with a key set of unknown size: pre-aggregation, then the salted join."""
    return feeds.ledger(f.raw_ledger, keys_df(f.all_keys), f.cfg, f.resolved)


@register("tag_agreement", O.with_ctes(f"""
SELECT bilateral_obl_number,
  CASE WHEN regexp_matches(bilateral_obl_number, {O.q('|'.join(NEW_AGREEMENTS))}) THEN 'new' ELSE 'old' END AS doag_new_old
FROM r_ledger"""))
def tag_agreement(f: DriverFlow) -> DataFrame:
    """Unanchored match against the new-agreement list; NULL -> 'old'."""
    return f.raw_ledger.select(
        "bilateral_obl_number",
        F.when(matches_any("bilateral_obl_number", NEW_AGREEMENTS), F.lit("new")).otherwise(F.lit("old"))
         .alias("doag_new_old"))


@register("txn_incremental", O.with_ctes("SELECT * FROM d0", O.D0_NUM))
def txn_incremental(f: DriverFlow) -> DataFrame:
    """A8/D0 kept up to date: after a first delivery with one wrong and one
    surplus file, the wrong one is corrected, the surplus one withdrawn and one
    added; the stored sums then equal a full roll-up."""
    root = f"{shared_dir(f.spark)}/fundflow-out/increments-{uuid.uuid4().hex}"

    def file(quarter: int) -> str:
        return f"{root}/in/FY24Q{quarter}_txn.parquet"

    def land(quarter: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(file(quarter))

    def lines(kind: str) -> DataFrame:
        return f.raw_txn.filter(F.col("transaction_event_type") == kind)

    def follow(pattern: str) -> None:
        sync_landing(f.spark, f"{root}/in", f"{root}/landed", fmt="parquet", pattern=pattern)
        increments.refresh(f.spark, f"{root}/landed", f"{root}/state", f.active_keys, f.cfg, f.resolved)

    land(1, lines("OBLG_SUBOB"))
    land(4, lines("OBLG_UNI"))
    # The surplus file holds the lines of the second quarter's, whose join with the orders need not run for each delivery.
    surplus = f.spark.read.parquet(file(4))
    land(2, surplus.withColumn("transaction_amt", F.lit("7")))
    follow("FY24Q*")
    land(2, surplus)
    land(3, lines("OTHER"))
    follow("FY24Q[123]*")
    return datasets.cumulative_transactions(increments.read_rollup(f.spark, f"{root}/state"))


# --- joins (J1-J8) ---------------------------------------------------------------

@register("left_join_nullsafe", O.with_ctes("SELECT * FROM d1_j",
                                            ["total_estimated_cost", *O.LEDGER_NUM]))
def left_join_nullsafe(f: DriverFlow) -> DataFrame:
    """Left join on 2 keys, NULL matches NULL."""
    return left_join_ns(f.active, f.ledger, AP)


@register("left_join_hot_key", O.with_ctes("""
SELECT activity_name, period, count(*) AS n, round(sum(amt), 2) AS transaction_amt
FROM (SELECT a.activity_name, a.period, CAST(t.transaction_amt AS DOUBLE) AS amt
      FROM r_txn t LEFT JOIN f_active a ON t.award_number IS NOT DISTINCT FROM a.award_number) x
GROUP BY 1, 2""", ["transaction_amt"]))
def left_join_hot_key(f: DriverFlow) -> DataFrame:
    """J1 where one award has a third of all left rows: it is found by a
    sketch and spread; row counts and sums by activity and period."""
    left = f.raw_txn.select("award_number", "document_number", "transaction_amt")
    joined = left_join_hot(left, f.active.select("award_number", "activity_name", "period"), "award_number")
    return (joined.groupBy("activity_name", "period")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("transaction_amt").cast("double")).alias("transaction_amt")))


@register("left_join_nullsafe3", O.with_ctes("SELECT * FROM d1_p",
                                             ["total_estimated_cost", *O.LEDGER_NUM, *O.PLAN_NUM]))
def left_join_nullsafe3(f: DriverFlow) -> DataFrame:
    """Left join on 3 keys; an award-period without ledger rows has a NULL
    area and meets plan rows whose area is NULL."""
    return left_join_ns(left_join_ns(f.active, f.ledger, AP), f.plan, APA)


@register("full_join_coalesce", O.with_ctes("""
SELECT coalesce(s.program_area, p.program_area) AS program_area, coalesce(s.period, p.period) AS period,
       s.subobligation, p.pipeline
FROM (SELECT DISTINCT program_area, period, 'yes' AS subobligation FROM f_plan) s
FULL JOIN (SELECT DISTINCT program_area, period, 'yes' AS pipeline FROM f_ledger) p
  ON s.program_area IS NOT DISTINCT FROM p.program_area AND s.period IS NOT DISTINCT FROM p.period"""))
def full_join_coalesce(f: DriverFlow) -> DataFrame:
    """Full outer join on 2 keys, keys coalesced, NULL keys matching."""
    from fundflow.operators import full_join_ns
    keys = ["program_area", "period"]
    s = f.plan.select(*keys).distinct().withColumn("subobligation", F.lit("yes"))
    p = f.ledger.select(*keys).distinct().withColumn("pipeline", F.lit("yes"))
    return full_join_ns(s, p, keys)


@register("spread_attribute", O.with_ctes(f"""
SELECT p.* EXCLUDE (comments), c.comments
FROM f_plan p LEFT JOIN (SELECT DISTINCT award_number, period, comments FROM f_plan WHERE comments IS NOT NULL) c
  ON {O.ns('p', 'c', AP)}""", O.PLAN_NUM))
def spread_attribute_q(f: DriverFlow) -> DataFrame:
    """Each distinct comment of an award-period re-attached to all its rows."""
    return spread_attribute(f.plan, AP, "comments")


# --- aggregations and window (A1-A8, W1) --------------------------------------------

_NAN_LEDGER = {c: f"CASE WHEN bilateral_obl_number = '656-DOAG-OLD' THEN CAST('NaN' AS DOUBLE) ELSE {c} END"
               for c in ("document_amt", "undisbursed_amt")}
_KNOWN = "CASE WHEN NOT isnan({0}) THEN {0} END"


@register("sum_all_numeric", O.with_ctes(f"""
SELECT award_number, period, {", ".join(f"coalesce(sum({_KNOWN.format(c)}), 0) AS {c}" for c in O.LEDGER_NUM)}
FROM (SELECT * REPLACE ({", ".join(f"{e} AS {c}" for c, e in _NAN_LEDGER.items())}) FROM f_ledger) x
GROUP BY award_number, period""", O.LEDGER_NUM))
def sum_all_numeric_q(f: DriverFlow) -> DataFrame:
    """A1: group sum over every numeric column, NULLs and NaNs skipped, none left -> 0."""
    old = F.col("bilateral_obl_number") == "656-DOAG-OLD"
    return sum_all_numeric(f.ledger.withColumns({
        c: F.when(old, F.lit(float("nan"))).otherwise(F.col(c)) for c in _NAN_LEDGER}), AP)


@register("strict_sum", O.with_ctes(f"""
SELECT award_number, period, {O.strict('document_amt', 'document_amt')},
  {O.strict('last_qtr_accrual_amt', 'last_qtr_accrual_amt')}
FROM l_lines GROUP BY award_number, period""", ["document_amt", "last_qtr_accrual_amt"]))
def strict_sum_q(f: DriverFlow) -> DataFrame:
    """A3: strict group sum -- one NULL (unparseable amount) makes the group NULL."""
    df = feeds.ledger_lines(f.raw_ledger, f.cfg).select(*AP, "document_amt", "last_qtr_accrual_amt")
    return sum_all_numeric(df, AP, strict=True)


@register("max_all_numeric", O.with_ctes("""
SELECT award_number, activity_name, period, max(CASE WHEN funding_type = 'Core' THEN total_estimated_cost END)
  AS total_estimated_cost
FROM f_active GROUP BY award_number, activity_name, period""", ["total_estimated_cost"]))
def max_all_numeric_q(f: DriverFlow) -> DataFrame:
    """A4: group max over every numeric column, NULLs and NaNs skipped."""
    core = F.col("funding_type") == "Core"
    active = f.active.withColumn("total_estimated_cost", F.when(core, F.col("total_estimated_cost"))
                                 .otherwise(F.lit(float("nan"))))
    return max_all_numeric(active, ["award_number", "activity_name", "period"])


@register("accrual_latest", O.with_ctes("""
SELECT award_number, period, program_area,
  coalesce(sum(CASE WHEN bilateral_obl_number IS NOT NULL THEN last_qtr_accrual_amt END), 0) AS last_qtr_accrual_amt
FROM d1_latest GROUP BY award_number, period, program_area""", ["last_qtr_accrual_amt"]), reuse=("ledger",))
def accrual_latest(f: DriverFlow) -> DataFrame:
    """Accrual of the pipeline dataset's latest period per award x area, NaNs skipped."""
    known = F.col("bilateral_obl_number").isNotNull()
    return datasets.latest_accrual(f.pipeline.withColumn("last_qtr_accrual_amt", F.when(
        known, F.col("last_qtr_accrual_amt")).otherwise(F.lit(float("nan")))))


@register("running_total_fy", O.with_ctes(f"""
SELECT award_number, period, amount,
  sum(amount) OVER (PARTITION BY award_number, fiscal_year ORDER BY quarter
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_amount
FROM (SELECT award_number, period, fiscal_year, quarter, sum(l_extendedprice) AS amount
      FROM (SELECT 'AW' || CAST(o_custkey AS VARCHAR) AS award_number, period,
              CAST(TRY_CAST(substr(split_part(period, 'Q', 1), 3, 2) AS DOUBLE) + 2000 AS INTEGER) AS fiscal_year,
              CAST(TRY_CAST(split_part(period, 'Q', 2) AS DOUBLE) AS INTEGER) AS quarter, l_extendedprice
            FROM (SELECT o_custkey, l_extendedprice,
                    {O.fy_label("CAST(date_trunc('quarter', CAST(l_shipdate AS DATE)) AS DATE)")} AS period
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) a) b
      GROUP BY award_number, period, fiscal_year, quarter) c""", ["amount", "running_amount"]))
def running_total_fy(f: DriverFlow) -> DataFrame:
    """Running total within award x fiscal year ordered by quarter."""
    li = f.t("lineitem").join(f.t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    df = li.select(F.concat(F.lit("AW"), F.col("o_custkey").cast("string")).alias("award_number"),
                   fiscal_period(quarter_start(F.to_date("l_shipdate")), null_label=None).alias("period"),
                   "l_extendedprice")
    df = df.groupBy(*AP).agg(F.sum("l_extendedprice").alias("amount"))
    fy, q = parse_period("period")
    df = df.withColumns({"fiscal_year": fy, "quarter": q})
    df = running_total(df, "amount", ["award_number", "fiscal_year"], ["quarter"], "running_amount")
    return df.select("award_number", "period", "amount", "running_amount")
