"""Mixing, sharding, packing and chat formatting."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from helpers_llm import DOCS, best_fit, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundflow.llm import chat, mixing, packing, sharding

SETTINGS = settings(max_examples=10, deadline=None)


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        text = rnd.choice([None, "", " ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.randrange(1, 90)))])
        text = " ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.randrange(1, 90))) if rnd.random() < .9 else text
        rows.append((i, text, "en", "hot" if i % 3 == 0 else rnd.choice(["a", "b", "Z", "é", None]), i))
    rows += [rows[5], rows[5], (None, "null id", "en", "a", 1), (3, "other text of 3", "en", "b", 1), (9999, "y " * 30_000, "en", "b", 1)]
    return rows


# --- mixing ------------------------------------------------------------------

def targets(sizes, weights, epochs=3):
    """Water-filling by repeated resharing."""
    left, open_, out = float(sum(sizes.values())), set(sizes), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if epochs * sizes[s] < weights[s] * level}
        if not full:
            out.update({s: weights[s] * level for s in open_})
            break
        for s in full:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def want_targets(rows):
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    return sizes, targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})


@pytest.mark.parametrize("whole", [False, True])
def test_mix_meets_its_targets(spark, whole):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", taken int")
    out = mixing.mix_plan(docs, whole=whole).collect()
    sizes, want = want_targets(rows)
    assert sorted(((r["doc_id"], r["source"], r["size"]) for r in out), key=repr) == sorted(
        ((d, s, len(words(t))) for d, t, _, s, _ in rows), key=repr)
    taken = Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == sum(c["take"] for c in r["copies"])
        assert [c["copy"] for c in r["copies"]] == list(range(len(r["copies"])))
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        largest = max(len(words(x)) for _, x, _, y, _ in rows if y == s)
        assert abs(taken[s] - t) <= (largest / 2 + 1 if whole else 0.5)
    again = mixing.mix_plan(spark.createDataFrame(random.Random(1).sample(rows, len(rows)), DOCS).repartition(5), whole=whole)
    assert sorted((tuple(r) for r in again.collect()), key=repr) == sorted((tuple(r) for r in out), key=repr)


def test_positions_invert_the_schedule(spark):
    """A copy is due when the schedule's integral reaches its place in the source."""
    rows = corpus(200, 2)
    out = mixing.mix_plan(spark.createDataFrame(rows, DOCS)).collect()
    order = sorted({r["source"] for r in out}, key=lambda s: (s is None, (s or "").encode()))
    by = defaultdict(list)
    for r in out:
        a, b = mixing.TILT[order.index(r["source"]) % 3]
        for c in r["copies"]:
            t = c["position"]
            assert 0 <= t <= 1
            by[r["source"]].append((t, c["take"], (a * t + (b - a) * t * t / 2) / ((a + b) / 2), r["target"]))
    for copies in by.values():
        before = 0
        for _, take, share, target in sorted(copies):
            assert share == pytest.approx(before / target, abs=1e-9)
            before += take


def test_general_schedule(spark):
    """Three knots, one of them at weight zero, against numeric integration."""
    knots = [(0.0, 0.0), (0.5, 2.0), (1.0, 1.0)]
    df = spark.range(101).select((F.col("id") / 100).alias("share"), F.array(*[
        F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in knots]).alias("knots"))
    got = df.select("share", mixing.time_of(mixing.segments(F.col("knots")), F.col("share")).alias("t")).collect()

    def integral(t):
        return 2 * t * t if t <= 0.5 else 0.5 + 2 * (t - 0.5) - (t - 0.5) ** 2
    for r in got:
        assert integral(r["t"]) / integral(1.0) == pytest.approx(r["share"], abs=1e-9)


def test_curriculum_rows(spark):
    rows = corpus(300, 3)
    docs = spark.createDataFrame([(*r, "p") for r in rows], DOCS + ", `__id` string")
    out = mixing.curriculum(docs)
    assert out.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    plan = Counter()
    for r in mixing.mix_plan(docs, whole=True).collect():
        plan[r["doc_id"], r["size"]] += len(r["copies"])
    assert Counter({(d, len(words(t))): 0 for d, t in got}) | plan == plan
    sums = Counter()
    for (d, t), k in got.items():
        sums[d, len(words(t))] += k
    assert sums == Counter({k: v for k, v in plan.items() if v})


def test_curriculum_of_repeated_rows(spark):
    """As many copies of a row as the mix takes of its id, text and source, the row's own columns kept."""
    rows = [(1, "a b c", "en", "x", 1), (1, "a b c", "en", "y", 2), (1, "a b c", "de", "x", 3), (None, "n n n n", "en", "x", 4),
            (None, "n n n n", "en", "x", 5), (None, "n n n n", "en", None, 6), (2, "q " * 50, "en", "y", 7), (3, "r " * 9, "en", "z", 8)]
    rows += [(None, "hot " * 5, "en", "x", 100 + i) for i in range(200)] + [(9, "same same", "en", "y", 0)] * 50
    docs = spark.createDataFrame(rows, DOCS)
    key = lambda r: (r["doc_id"], r["source"], len(words(r["text"])))
    got = mixing.curriculum(docs).collect()
    want = Counter()
    for r in mixing.mix_plan(docs, whole=True).collect():
        want[r["doc_id"], r["source"], r["size"]] += len(r["copies"])
    assert Counter(map(key, got)) == +want
    assert {tuple(r) for r in got} <= set(rows) and {r["source"] for r in got} == {"x", "y", "z", None}
    # A row takes the copies of one place: rows of a key differ by two places' copies at most.
    per_row = Counter(r["n_chars"] for r in got if r["n_chars"] >= 100)
    assert set(per_row.values()) <= {1, 2, 3} and len(per_row) > 100


def test_mix_edge_cases(spark):
    assert mixing.mix_plan(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.curriculum(spark.createDataFrame([], DOCS)).count() == 0
    blank = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOCS)
    assert [(r["target"], r["taken"]) for r in mixing.mix_plan(blank).collect()] == [(0.0, 0), (0.0, 0)]
    one = spark.createDataFrame([(1, "a b c", "en", "a", 0)], DOCS)
    assert [(r["target"], r["taken"]) for r in mixing.mix_plan(one).collect()] == [(3.0, 3)]


# --- sharding ----------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 3, 8])
def test_shards(spark, n):
    rows = corpus(600, 4)
    out = sharding.shard_rows(spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", shard int"), n).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=repr) == sorted(
        ((d, size(t), zlib.crc32((t or "").encode())) for d, t, *_ in rows), key=repr)
    assert {r["law"] for r in out} == {"rows"} and {r["grown_shard"] for r in out} == {None}
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(n))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    # Every shard has the corpus's mixture, to within a row or two of each source.
    source = {(d, size(t)): s for d, t, _, s, _ in rows}
    total = Counter(source[r["doc_id"], r["size"]] for r in out)
    for k in range(n):
        mine = Counter(source[r["doc_id"], r["size"]] for r in out if r["shard"] == k)
        assert all(abs(mine[s] - total[s] / n) <= 2 for s in total)


def test_shard_ranks_match_brute_force(spark):
    """Sorting by fractional rank within the source, then equal cuts."""
    rows = [(i, f"t{i}", "en", "a" if i % 4 else "b", 0) for i in range(101)]
    docs = spark.createDataFrame(rows, DOCS)
    keys = docs.select("doc_id", "source", F.xxhash64(F.lit(sharding.SEED), "doc_id", F.crc32(F.col("text").cast("binary")),
                                                      (F.octet_length("text") + 1).cast("long")).alias("h")).collect()
    by = defaultdict(list)
    for r in sorted(keys, key=lambda r: r["h"]):
        by[r["source"]].append(r["doc_id"])
    order = sorted(((i + .5) / len(v), s, d) for s, v in by.items() for i, d in enumerate(v))
    want = {}
    for g, (_, _, d) in enumerate(order):
        shard = g * 4 // len(order)
        want[d] = (shard, g - math.ceil(shard * len(order) / 4))
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_rows(docs, 4).collect()}
    assert got == want


def test_shard_edge_cases_and_files(spark, scratch):
    assert sharding.shard_rows(spark.createDataFrame([], DOCS), 8).count() == 0
    few = spark.createDataFrame([(i, None, None, None, None) for i in range(3)], DOCS)
    assert sorted((r["shard"], r["slot"]) for r in sharding.shard_rows(few, 8).collect()) == [(0, 0), (2, 0), (5, 0)]
    docs = spark.createDataFrame([(i, f"text {i}", "en", f"s{i % 3}", 1) for i in range(50)], DOCS)
    sharding.write_shards(docs, f"{scratch}/shards", 4)
    back = spark.read.parquet(f"{scratch}/shards")
    odd = [(None, "a", "en", "s", 1), (1, "b", "en", "s", 2), (1, "c", "en", "s", 3), (1, "c", "en", "s", 3), (None, None, None, None, 4)]
    odd += [(None, "hot", "en", "s", 5)] * 30
    frame = spark.createDataFrame([(*r, "x") for r in odd], DOCS + ", `__number` string")
    sharding.write_shards(frame, f"{scratch}/odd", 3)
    rows_back = spark.read.parquet(f"{scratch}/odd").collect()
    assert Counter(tuple(r[c] for c in frame.columns) for r in rows_back) == Counter((*r, "x") for r in odd)
    assert sorted((r["shard"], r["slot"]) for r in rows_back) == sorted((k, i) for k, n in ((0, 12), (1, 12), (2, 11)) for i in range(n))
    assert back.count() == 50 and sorted(r[0] for r in back.groupBy("shard").count().select("count").collect()) == [12, 12, 13, 13]


# --- packing -----------------------------------------------------------------

pieces = st.lists(st.tuples(st.integers(1, 20), st.integers(0, 6), st.sampled_from("abc")), min_size=1, max_size=60)


@settings(max_examples=200, deadline=None)
@given(pieces, st.integers(1, 3))
def test_best_fit_matches_brute_force(rows, limit):
    rows = sorted(rows, reverse=True)
    got = packing.best_fit([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], 20, limit)
    assert got == best_fit(rows, 20, limit)


def test_pack(spark):
    rows = corpus(500, 5) + [(20_000 + i, "same text here", "en", "hot", 0) for i in range(40)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], DOCS + ", bin_id int")
    out = packing.pack(docs, capacity=100, max_per_source=2, group_rows=150).collect()
    # Whole texts: every document's pieces add up to its words and a separator.
    total = defaultdict(Counter)
    for r in out:
        total[r["doc_id"]][r["copy"]] += r["size"]
    want = Counter((d, len(words(t)) + 1) for d, t, *_ in rows)
    assert sum(r["size"] for r in out) == sum(k * s for (_, s), k in want.items())
    assert len({(r["doc_id"], r["copy"], r["piece"], r["size"]) for r in out}) == len(out)
    for d in (0, 5, 9999, 20_001):
        assert sorted(total[d].values()) == sorted(s for (x, s), k in want.items() if x == d for _ in range(k))
    text = {(d, s): (t or "").lower() for d, t, _, s, _ in rows}
    source = {}
    for d, t, _, s, _ in rows:
        source.setdefault(d, set()).add(s)
    bins = defaultdict(list)
    for r in out:
        bins[r["bin_id"]].append(r)
    for b in bins.values():
        assert sum(r["size"] for r in b) <= 100
        at = 0
        for r in sorted(b, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["size"]
        same = [r for r in b if r["doc_id"] is not None and r["doc_id"] >= 20_000]
        assert len(same) <= 1
        hot = [r for r in b if r["doc_id"] is not None and source[r["doc_id"]] == {"hot"}]
        assert len(hot) <= 2
    assert text
    again = packing.pack(spark.createDataFrame(random.Random(2).sample(rows, len(rows)), DOCS).repartition(6), 100, 2,
                         group_rows=150).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


# --- chat --------------------------------------------------------------------

controls = st.lists(st.sampled_from([*chat.CONTROL, "<", "[", "/INST]", "|", "s>", chat.JOINER, "<" + chat.JOINER + "/s>",
                                     "\n", "é", "𐐀", "x", " "]), max_size=8).map("".join)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<|end|>", ""]), controls), min_size=1, max_size=25))
def test_round_trip(spark, turns):
    rows = [(i // 4, i % 4, role, text) for i, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts")))
    out = out.withColumn("turns", chat.read_turns(F.col("formatted")))
    out = out.withColumn("said", F.transform("turns", lambda t: F.struct(t["role"], chat.unescape(t["content"]))))
    for r in out.withColumn("loss", chat.read_loss(F.col("turns"), F.col("loss_spans"))).collect():
        mine = [(role, text) for c, _, role, text in rows if c == r["conv_id"]]
        assert [tuple(x) for x in r["said"]] == mine
        assert r["loss"] == "".join(t for role, t in mine if role == "assistant")
        # Outside the marks no control string is left, and spans cut the output where they say.
        spans = [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss_spans"]]
        assert len(spans) == sum(role == "assistant" for role, _ in mine)
        assert not any(c in s for s in spans for c in chat.CONTROL)
        assert r["formatted"].count(chat.START) == r["formatted"].count(chat.END) == len(mine)


def test_typed_parts(spark):
    parts = [("text", "see </s> ", None, None), ("image", None, "s3-1", 64), ("text", " and ", None, None),
             ("audio", "ignored", "a-2", None), ("document", None, None, 7), ("video?", "as text", None, None)]
    df = spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", [("text", "ok", None, None), ("image", None, "g", 1), ("text", "!", None, None)]),
         (1, 2, None, []), (1, None, "system", None)],
        f"conv_id long, turn long, role string, parts array<{chat.PART_TYPE}>")
    r = chat.format_chats(df).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.read_loss(F.col("turns"), F.col("loss_spans"))).collect()[0]
    j = chat.JOINER
    assert r["formatted"] == ("<|start|>system<|text|><|end|><|start|>user<|text|>see <" + j + "/s> <|image|> and <|audio|><|document|>as text<|end|>"
                              "<|start|>assistant<|text|>ok<|image|>!<|end|><|start|><|text|><|end|>")
    assert r["loss"] == "ok!" and r["expanded"] == 64 + chat.EXPANSION["audio"] + 7 + 1
    assert [(a["type"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        ("image", "s3-1", 64), ("audio", "a-2", chat.EXPANSION["audio"]), ("document", None, 7), ("image", "g", 1)]
    for a in r["attachments"]:
        assert r["formatted"][a["at"]:].startswith(chat.PLACEHOLDERS[a["type"]])


def test_chat_edge_cases(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(1, 0, "user", None, "x"), (1, 0, "user", None, "x"), (None, 1, "assistant", "n", "x"), (2, 5, "assistant", "", "x"),
            (3, 0, "assistant", "z" * 100_000, "x")] + [(4, i, "assistant" if i % 2 else "user", f"t{i}", "x") for i in range(16000)]
    df = spark.createDataFrame(rows, schema).select("*", chat.text_parts(F.col("text")).alias("parts"))
    got = {r["conv_id"]: r for r in chat.format_chats(df).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.read_loss(F.col("turns"), F.col("loss_spans"))).collect()}
    assert {k: len(r["turns"]) for k, r in got.items()} == {1: 2, None: 1, 2: 1, 3: 1, 4: 16000}
    assert (got[None]["loss"], got[2]["loss"], got[1]["loss"]) == ("n", "", "") and len(got[3]["loss"]) == 100_000
    assert [t["content"] for t in got[4]["turns"]] == [f"t{i}" for i in range(16000)]
    assert got[4]["loss"] == "".join(f"t{i}" for i in range(1, 16000, 2))
    assert chat.format_chats(df.limit(0)).count() == 0
    assert hashlib.sha256(b"").hexdigest()
