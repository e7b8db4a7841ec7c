"""The stored transaction roll-up equals a full one, whatever is delivered."""

import datetime as dt
import os
import random

import pytest

from fundflow.operators import stage
from fundflow.plans import datasets, feeds, increments
from fundflow.session import session_with
from fundflow.sources import read_csv_folder, read_deliveries, sync_landing

HEADER = ["Award Number", "Document Number", "Obl Document Number", "Transaction Date", "Transaction Amt",
          "Transaction Event", "Transaction Event Type", "Program Element", "Distribution", "Program Area"]


def line(award, quarter, amt, event="DISB"):
    day = dt.date(2023, 3 * quarter - 1, 15)
    return [award, f"D{award}", "", str((day - dt.date(1899, 12, 30)).days), str(amt), event, "OBLG_UNI", "A047", "656-W", ""]


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(",".join(r) for r in [HEADER, *lines]) + "\n")


def rounded(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture
def flow(spark, scratch):
    folder, landed, state = f"{scratch}/in", f"{scratch}/landed", f"{scratch}/state"
    keys = spark.createDataFrame([("A1",), ("A2",), ("DA3",)], "award_number string")

    def run(k=keys):
        sync_landing(spark, folder, landed)
        done = increments.refresh(spark, landed, state, k)
        full = feeds.transactions(read_csv_folder(spark, folder), k)
        kept = increments.read_rollup(spark, state)
        assert kept.columns == full.columns and rounded(kept) == rounded(full)
        assert rounded(datasets.cumulative_transactions(kept)) == rounded(datasets.cumulative_transactions(full))
        return done

    return folder, run


def test_added_corrected_and_withdrawn_files(spark, flow):
    folder, run = flow
    rnd = random.Random(1)
    make = lambda quarters: [line(rnd.choice(["A1", "A2", "A3", "A9"]), rnd.choice(quarters), rnd.randrange(1000))
                             for _ in range(60)]
    land(folder, "FY23Q2_t.csv", make([1, 2]))
    land(folder, "FY23Q3_t.csv", make([2, 3]))
    first = run()
    assert first.files_read == ("FY23Q2_t.csv", "FY23Q3_t.csv") and first.periods == ("FY23Q2", "FY23Q3", "FY23Q4")
    assert run() == increments.Refresh(1, (), ())
    # Only the periods that the added, corrected and withdrawn files touch are merged again.
    land(folder, "FY23Q4_t.csv", make([4]))
    assert run().periods == ("FY24Q1",)
    land(folder, "FY23Q3_t.csv", [line("A1", 3, 5), line("A1", 3, "not a number")])
    again = run()
    assert again.files_read == ("FY23Q3_t.csv",) and again.periods == ("FY23Q3", "FY23Q4")
    os.remove(f"{folder}/FY23Q4_t.csv")
    gone = run()
    assert gone.files_read == () and gone.periods == ("FY24Q1",)


def test_other_active_keys_merge_every_period_without_reading_lines(spark, flow):
    folder, run = flow
    land(folder, "FY23Q2_t.csv", [line(a, q, 10 * q) for a in ("A1", "A2", "A3") for q in (1, 2, 3)])
    run()
    fewer = run(spark.createDataFrame([("A2",), ("DA1",)], "award_number string"))
    assert fewer.files_read == () and fewer.periods == ("FY23Q2", "FY23Q3", "FY23Q4")
    assert run(spark.createDataFrame([("X",)], "award_number string")).periods == ("FY23Q2", "FY23Q3", "FY23Q4")  # nothing is left
    assert run(spark.createDataFrame([("A1",)], "award_number string")).files_read == ()


def test_a_failed_refresh_is_made_up_for(spark, flow, monkeypatch):
    folder, run = flow
    land(folder, "FY23Q2_t.csv", [line("A1", 1, 1)])
    run()
    land(folder, "FY23Q2_t.csv", [line("A1", 1, 2), line("A2", 2, 3)])
    before = increments.finish_transactions

    def fail(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(increments, "finish_transactions", fail)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.setattr(increments, "finish_transactions", before)
    assert run().periods == ("FY23Q2", "FY23Q3")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_file_are_not_dealt_to_one_task(spark, scratch):
    folder, landed, state = f"{scratch}/in", f"{scratch}/landed", f"{scratch}/state"
    keys = spark.createDataFrame([("A1",), ("A2",)], "award_number string")
    land(folder, "FY23Q2_t.csv", [line("A1", 1, 1), line("A2", 2, 2)])
    land(folder, "FY23Q3_t.csv", [line("A1", 1, 3)])
    sync_landing(spark, folder, landed)
    increments.refresh(spark, landed, state, keys)
    land(folder, "FY23Q3_t.csv", [line("A1", 1, 4)])
    sync_landing(spark, folder, landed)
    increments.refresh(spark, landed, state, keys)
    raw = increments._of(read_deliveries(spark, landed), [("FY23Q3_t.csv", 2)], increments.FILE)
    stored = increments._of(increments._partials(spark, state), [("FY23Q2_t.csv", 1), ("FY23Q3_t.csv", 2)], increments.FILE)
    # Neither is dealt by file and delivery, and the files of other partitions are left out by the scan's own filter.
    for df, n in ((raw, 1), (stored, 3)):
        plan = plan_of(df)
        assert "hashpartitioning(" not in plan and "SortMergeJoin" not in plan
        assert "(delivery#" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert df.count() == n
    rolled = increments._of(increments._rollup(spark, state), increments._state(spark, state).periods, ["period", "version"])
    assert "hashpartitioning(" not in plan_of(rolled) and rolled.count() == 2
    assert increments._of(raw, [], increments.FILE).count() == 0


def test_a_large_manifest_does_not_deal_rows_by_file(spark, scratch):
    land(f"{scratch}/in", "FY23Q2_t.csv", [line("A1", 1, 1)])
    sync_landing(spark, f"{scratch}/in", f"{scratch}/landed")
    own = session_with(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    assert "hashpartitioning(" not in plan_of(read_deliveries(own, f"{scratch}/landed"))


def test_stored_sums_are_not_written_again(spark, scratch):
    folder, landed, state = f"{scratch}/in", f"{scratch}/landed", f"{scratch}/state"
    keys = spark.createDataFrame([("A1",), ("DA3",)], "award_number string")
    land(folder, "FY23Q2_t.csv", [line(a, q, 10 * q) for a in ("A1", "A2", "A3") for q in (1, 2)])
    sync_landing(spark, folder, landed)
    cuts = []

    def cut(df):
        cuts.append(df.columns)
        return stage(df, "cut")

    increments.refresh(spark, landed, state, keys, cut=cut)
    assert len(cuts) == 1 and "__chosen" in cuts[0]  # the chosen keys alone
    assert rounded(increments.read_rollup(spark, state)) == rounded(feeds.transactions(read_csv_folder(spark, folder), keys))
