"""End-to-end quarterly run over CSV landing folders (fixture G5)."""

import datetime as dt
import os

from fundflow.plans.run import FEED_FOLDERS, SPREADSHEET_FEEDS, Landing, build, run_quarter
from fundflow.sources import read_csv_output


def _csv(folder, name, header, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")


def landing(root):
    serial = str((dt.date(2023, 11, 15) - dt.date(1899, 12, 30)).days)
    _csv(f"{root}/active_awards", "FY24Q1_Active Awards.csv",
         ["Sector", "Sub Sector", "Activity Name", "Award Number", "Total Estimated Cost", "U.S. Org (Local)",
          "Start Date", "End Date", "AOR/COR or Activity Manager", "Funding Type", "PEPFAR Funding"],
         [["IHO", "AFG", "Act 1", " A1 ", "1000", "US", "2023-10-01 00:00:00", "", "M", "Core", ""],
          ["IHO", "AFG", "Act 9 MEL", "A9", "5", "US", "", "", "M", "Core", ""]])
    _csv(f"{root}/expired_awards", "FY24Q1_Expired Awards.csv",
         ["Sector", "Sub Sector", "Activity Name", "Award Number", "U.S. Org (Local)", "End Date",
          "AOR/COR or Activity Manager", "Funding Type"],
         [["IHO", "PCMD", "Old", "E1", "US", "", "M", "Core"]])
    _csv(f"{root}/close_out_tracker", "FY24Q1_Close Out.csv",
         ["Award Number", "To Be Deobligated", "Status"], [["E1", "3", "Open"]])
    _csv(f"{root}/subobligation_summary", "FY24Q1_Sub.csv",
         ["Award Number", "Implementing Mechanism", "Program Area", "Un-Sub-Obligated Funds", "Comments"],
         [["A1", "M", "HIV/AIDS", "30", "c1"], ["A1", "M", "TB", "40", "c2"], ["A1", "Total", "TB", "70", ""]])
    hdr = ["Award Number", "Document Number", "Obligation Type", "Distribution", "Program Element", "Program Area",
           "Bilateral Obl Number", "Document Amt", "Disbursement Amt", "Last Qtr Adj Amt", "Undisbursed Amt",
           "Pipeline Amt", "Obligation Amt", "Subobligation Amt"]
    _csv(f"{root}/ledger", "FY24Q1_Pipeline.csv", hdr, [
        ["A1", "D", "OBLG_UNI", "656-M", "A047", "", "B1", "100", "1", "1", "1", "1", "", ""],
        ["A1", "D", "OBLG_UNI", "656-M", "A047", "", "B2", "50", "1", "1", "1", "1", "", ""],
        ["A1", "D", "OBLG_SUBOB", "656-W", "A048", "", "B1", "20", "1", "1", "1", "1", "", ""],
        ["E1", "D", "OBLG_SUBOB", "656-W", "A048", "", "656-DOAG-656-22-019-IH", "9", "1", "1", "4", "1", "", ""]])
    _csv(f"{root}/transactions", "FY24Q1_Transactions.csv",
         ["Award Number", "Document Number", "Obl Document Number", "Transaction Date", "Transaction Amt",
          "Transaction Event", "Transaction Event Type", "Program Element", "Distribution", "Program Area"],
         [["A1", "D", "D", serial, "12", "DISB", "OTHER", "A047", "656-W", ""]])


def test_run_quarter_g5(spark, scratch):
    root = os.path.join(scratch, "landing")
    landing(root)
    outs = build(spark, root)
    pipe = outs["pipeline"].collect()
    assert len(pipe) == 6
    assert sorted(r["transaction_amt"] for r in pipe) == [0.0, 0.0, 12.0, 12.0, 12.0, 12.0]
    k8 = {r["award_number"]: r for r in outs["pipeline_test_all"].collect()}
    assert (k8["A1"]["raw_document_amt"], k8["A1"]["new_document_amt"]) == (170.0, 340.0)
    assert (k8["E1"]["raw_document_amt"], k8["E1"]["new_document_amt"]) == (9.0, 0.0)   # Q21
    exp = outs["expired_awards"].collect()
    assert [(r["award_number"], r["doag_new_old"], r["undisbursed_amt"], r["status"]) for r in exp] == \
        [("E1", "new", 4.0, "Open")]
    out = os.path.join(scratch, "out")
    paths = run_quarter(spark, root, out)
    assert len(paths) == 8
    back = read_csv_output(spark, f"{out}/transaction")
    assert back.count() == 1


def test_command_line_run(spark, scratch, capsys):
    from fundflow.plans.run import main

    root = os.path.join(scratch, "landing")
    landing(root)
    out = os.path.join(scratch, "out")
    main([root, out, "--out-format", "parquet"])
    printed = capsys.readouterr().out.split()
    assert len(printed) == 8
    assert spark.read.parquet(f"{out}/pipeline").count() == 6


def test_run_quarter_parquet_landing(spark, scratch):
    """Same landing as G5, re-landed as Spark-written Parquet period folders."""
    csv_root = os.path.join(scratch, "csv")
    landing(csv_root)
    pq_root = os.path.join(scratch, "pq")
    for feed in sorted(os.listdir(csv_root)):
        for name in os.listdir(os.path.join(csv_root, feed)):
            df = spark.read.option("header", True).csv(os.path.join(csv_root, feed, name))
            df.coalesce(1).write.parquet(os.path.join(pq_root, feed, name.replace(".csv", ".parquet")))
    outs = build(spark, pq_root, fmt="parquet")
    assert outs["pipeline"].count() == 6
    k8 = {r["award_number"]: r for r in outs["pipeline_test_all"].collect()}
    assert (k8["A1"]["raw_document_amt"], k8["A1"]["new_document_amt"]) == (170.0, 340.0)
    assert {r["period"] for r in outs["pipeline"].collect()} == {"FY24Q1"}


def test_streamed_tables_feed_the_run(spark, scratch):
    """Period files ingested incrementally into period-partitioned tables,
    then one run over those tables (format "table")."""
    from fundflow.plans.run import FEED_FOLDERS
    from fundflow.streaming import ingest_new_period_files

    csv_root = os.path.join(scratch, "csv")
    landing(csv_root)
    pq_root, tables = os.path.join(scratch, "pq"), os.path.join(scratch, "tables")
    import pyarrow.csv as pcsv
    import pyarrow.parquet as pq

    for feed in FEED_FOLDERS.values():
        src, dst = os.path.join(csv_root, feed), os.path.join(pq_root, feed)
        os.makedirs(dst)
        rows = 0
        for name in os.listdir(src):
            t = pcsv.read_csv(os.path.join(src, name),
                              convert_options=pcsv.ConvertOptions(strings_can_be_null=True))
            t = t.cast(__import__("pyarrow").schema([(c, __import__("pyarrow").string()) for c in t.column_names]))
            pq.write_table(t, os.path.join(dst, name.replace(".csv", ".parquet")))
            rows += t.num_rows
        schema = spark.read.parquet(dst).schema
        n = ingest_new_period_files(spark, dst, os.path.join(tables, feed), schema,
                                    feed, checkpoint=os.path.join(scratch, "ckpt", feed))
        assert n == rows
    outs = build(spark, tables, fmt="table")
    assert outs["pipeline"].count() == 6
    assert [r["award_number"] for r in outs["expired_awards"].collect()] == ["E1"]


def test_run_reads_line_breaks_in_spreadsheet_cells(spark, scratch):
    root = os.path.join(scratch, "landing")
    for feed in SPREADSHEET_FEEDS:
        folder = os.path.join(root, FEED_FOLDERS[feed])
        os.makedirs(folder)
        with open(os.path.join(folder, "FY24Q1_x.csv"), "w") as fh:
            fh.write('Banner\nAward Number,Comments,Amount\nA1,"one\ntwo",5\n')
        got = [tuple(r) for r in Landing(spark, root, skip_rows=1).read(feed).select("award_number", "comments", "amount").collect()]
        assert got == [("A1", "one\ntwo", "5")]


def test_run_with_banner_rows(spark, scratch):
    """Spreadsheet exports with a title row above the header (the source skips one row)."""
    root = os.path.join(scratch, "landing")
    landing(root)
    for feed in ("active_awards", "expired_awards", "close_out_tracker", "subobligation_summary"):
        folder = os.path.join(root, feed)
        for name in os.listdir(folder):
            p = os.path.join(folder, name)
            body = open(p).read()
            with open(p, "w") as fh:
                fh.write("Quarterly extract - do not edit\n" + body)
    outs = build(spark, root, skip_rows=1)
    assert outs["pipeline"].count() == 6
    assert [r["award_number"] for r in outs["expired_awards"].collect()] == ["E1"]


def test_run_over_landed_tables_follows_corrections(spark, scratch):
    root, tables = os.path.join(scratch, "landing"), os.path.join(scratch, "tables")
    landing(root)
    first = build(spark, root, landed_root=tables)
    assert rows_of(first["pipeline"]) == rows_of(build(spark, root)["pipeline"])
    folder = os.path.join(root, "ledger")
    path = os.path.join(folder, "FY24Q1_Pipeline.csv")
    text = open(path).read()
    with open(path, "w") as fh:
        fh.write(text.replace(",100,", ",1e2x,"))
    again, full = build(spark, root, landed_root=tables), build(spark, root)
    for name in ("pipeline", "pipeline_test_all", "expired_awards", "rejected_cells"):
        assert rows_of(again[name]) == rows_of(full[name])
    assert rows_of(again["rejected_cells"]) == [("1", "1e2x", "FY24Q1_Pipeline.csv", "document_amt", "ledger")]


def rows_of(df):
    return sorted(tuple(sorted(map(str, r))) for r in df.collect())


def test_publishing_is_all_or_nothing(spark, scratch, monkeypatch):
    import pytest

    from fundflow.plans import publish as P
    from fundflow.plans.run import publish_quarter

    root, out = os.path.join(scratch, "landing"), os.path.join(scratch, "out")
    landing(root)
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, out, "pipeline")
    folder = publish_quarter(spark, root, out, out_fmt="parquet", run_id="one")
    assert folder.endswith("/runs/one") and P.published(spark, out)[:2] == (1, "one")
    before = rows_of(P.read_published(spark, out, "pipeline"))
    assert len(before) == 6 and P.read_published(spark, out, "rejected_cells").count() == 0
    # The next run fails after some of its outputs: the previous one is still what counts.
    write, done = P.write_parquet, []

    def fail(df, path, **kw):
        if len(done) == 3:
            raise OSError("disk full")
        done.append(path)
        write(df, path, **kw)

    monkeypatch.setattr(P, "write_parquet", fail)
    os.remove(os.path.join(root, "transactions", "FY24Q1_Transactions.csv"))
    _csv(f"{root}/transactions", "FY24Q1_t.csv", ["Award Number", "Document Number", "Obl Document Number", "Transaction Date",
                                                  "Transaction Amt", "Transaction Event", "Transaction Event Type",
                                                  "Program Element", "Distribution", "Program Area"], [])
    with pytest.raises(OSError):
        publish_quarter(spark, root, out, out_fmt="parquet", run_id="two")
    assert len(done) == 3 and P.published(spark, out)[1] == "one"
    assert rows_of(P.read_published(spark, out, "pipeline")) == before
    monkeypatch.setattr(P, "write_parquet", write)
    with pytest.raises(Exception, match="(?i)exists"):  # a run id is used once
        publish_quarter(spark, root, out, out_fmt="parquet", run_id="two")
    publish_quarter(spark, root, out, run_id="three")   # as CSV
    assert P.published(spark, out)[:2] == (2, "three")
    assert {r["transaction_amt"] for r in P.read_published(spark, out, "pipeline").collect()} == {"0"}
    with pytest.raises(KeyError):
        P.read_published(spark, out, "other")
