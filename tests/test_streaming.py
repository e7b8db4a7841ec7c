"""Incremental landing with Structured Streaming (availableNow + checkpoint)."""

import os

from fundflow.streaming import ingest_new_period_files


def test_incremental_ingest_exactly_once(spark, scratch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    table = os.path.join(scratch, "table")
    ckpt = os.path.join(scratch, "ckpt")
    schema = "`Award Number` string, `Document Amt` double"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)

    def land(name, awards):
        pq.write_table(pa.table({"Award Number": awards, "Document Amt": [1.0] * len(awards)}),
                       os.path.join(landing, name))

    land("FY24Q1_ledger.parquet", ["A1", "A2"])
    land("FY24Q2_ledger.parquet", ["A1"])
    n1 = ingest_new_period_files(spark, landing, table, st, "ledger", checkpoint=ckpt)
    assert n1 == 3
    land("FY24Q3_ledger.parquet", ["A3"])
    n2 = ingest_new_period_files(spark, landing, table, st, "ledger", checkpoint=ckpt)
    assert n2 == 1
    n3 = ingest_new_period_files(spark, landing, table, st, "ledger", checkpoint=ckpt)
    assert n3 == 0
    df = spark.read.parquet(table)
    got = sorted((r["award_number"], r["period"]) for r in df.collect())
    assert got == [("A1", "FY24Q1"), ("A1", "FY24Q2"), ("A2", "FY24Q1"), ("A3", "FY24Q3")]


def test_incremental_ingest_csv(spark, scratch):
    from fundflow.schemas import LEDGER, landing_schema

    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    raw_names = ["Award Number", "Document Amt"]
    schema = landing_schema(LEDGER)
    st = type(schema)([f for f in schema.fields if f.name in ("award_number", "document_amt")])
    st = type(schema)([type(f)(n, f.dataType, True) for n, f in zip(raw_names, st.fields)])

    def land(name, rows):
        with open(os.path.join(landing, name), "w") as fh:
            fh.write(",".join(raw_names) + "\n" + "".join(f"{a},{b}\n" for a, b in rows))

    land("FY24Q1_ledger.csv", [("A1", "5"), ("A2", '"say ""hi"", ok"')])
    table, ckpt = os.path.join(scratch, "table"), os.path.join(scratch, "ckpt")
    assert ingest_new_period_files(spark, landing, table, st, "csv_ledger", fmt="csv", checkpoint=ckpt) == 2
    land("FY24Q2_ledger.csv", [("A3", "7")])
    assert ingest_new_period_files(spark, landing, table, st, "csv_ledger", fmt="csv", checkpoint=ckpt) == 1
    got = sorted((r["award_number"], r["document_amt"], r["period"]) for r in spark.read.parquet(table).collect())
    assert got == [("A1", "5", "FY24Q1"), ("A2", 'say "hi", ok', "FY24Q1"), ("A3", "7", "FY24Q2")]


def test_csv_rows_longer_than_the_header_stop_the_ingest(spark, scratch):
    import pytest
    from pyspark.sql.types import StringType, StructField, StructType

    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    schema = StructType([StructField("Award Number", StringType()), StructField("Document Amt", StringType())])

    def run(name, text):
        with open(os.path.join(landing, name), "w") as fh:
            fh.write(text)
        return ingest_new_period_files(spark, landing, os.path.join(scratch, "t"), schema, "x", fmt="csv",
                                       checkpoint=os.path.join(scratch, "c"))

    assert run("FY24Q1_a.csv", "Award Number,Document Amt\nA1,\nA2,2\n") == 2
    for ragged in ("A1,1,5\n", "A1\n", 'A1,"a\nb"\n'):
        with pytest.raises(Exception, match="more cells than the header"):
            run("FY24Q2_a.csv", "Award Number,Document Amt\n" + ragged)
    os.remove(os.path.join(landing, "FY24Q2_a.csv"))


def test_stream_and_batch_take_the_same_file(spark, scratch):
    """A line break in a quoted cell: with multi_line one row in both landings, without it an error in both."""
    import pytest
    from pyspark.sql.types import StringType, StructField, StructType

    from fundflow.sources import read_csv_folder

    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "FY24Q1_a.csv"), "w") as fh:
        fh.write('Award Number,Comments,Document Amt\nA1,"two\nlines",5\nA2,plain,6\n')
    schema = StructType([StructField(n, StringType()) for n in ("Award Number", "Comments", "Document Amt")])

    def stream(multi_line):
        out = os.path.join(scratch, f"t{multi_line}")
        ingest_new_period_files(spark, landing, out, schema, "x", fmt="csv", checkpoint=os.path.join(scratch, f"c{multi_line}"),
                                multi_line=multi_line)
        return spark.read.parquet(out)

    def rows(df):
        return sorted((r["award_number"], r["comments"], r["document_amt"], r["period"], r["source_file"]) for r in df.collect())

    want = [("A1", "two\nlines", "5", "FY24Q1", "FY24Q1_a.csv"), ("A2", "plain", "6", "FY24Q1", "FY24Q1_a.csv")]
    assert rows(stream(True)) == rows(read_csv_folder(spark, landing, multi_line=True)) == want
    for read in (lambda: rows(stream(False)), lambda: rows(read_csv_folder(spark, landing))):
        with pytest.raises(Exception, match="cells than the header"):
            read()


def test_csv_header_other_than_the_schema_stops_the_ingest(spark, scratch):
    import pytest
    from pyspark.sql.types import StringType, StructField, StructType

    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    schema = StructType([StructField("Award Number", StringType()), StructField("Document Amt", StringType())])
    with open(os.path.join(landing, "FY24Q1_a.csv"), "w") as fh:
        fh.write("Document Amt,Award Number\n1,A1\n")
    with pytest.raises(Exception, match="header"):
        ingest_new_period_files(spark, landing, os.path.join(scratch, "t"), schema, "x", fmt="csv",
                                checkpoint=os.path.join(scratch, "c"))


def test_row_count_over_many_batches(spark, scratch):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.types import StringType, StructField, StructType

    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    for i in range(6):
        pq.write_table(pa.table({"Award Number": [f"A{i}"]}), os.path.join(landing, f"FY24Q1_{i}.parquet"))
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        n = ingest_new_period_files(spark, landing, os.path.join(scratch, "t"),
                                    StructType([StructField("Award Number", StringType())]), "x",
                                    checkpoint=os.path.join(scratch, "c"), max_files_per_batch=1)
        assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "2"
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert n == 6
