"""Near duplicates: SuperMinHash signatures, banding, verification and
union-find grouping.

1. Every text is reduced, in Arrow batches, to its set of word shingles, a
   fingerprint of the set and a SuperMinHash signature cut into bands.
   Documents with equal sets are one class; only its smallest id goes on.
2. Classes that agree in a band share a bucket.  Instead of all its pairs, a
   bucket is compared to one member, its hub: the one that agrees with most
   others over all bands.  Buckets of one hub are its star.  Members linked
   with the hub are connected and need no other comparison.
3. A member A that is not linked with the hub may be linked with another
   member B of the star.  Jaccard distance is a metric, so this needs
   d(A, hub) and d(B, hub) within 0.2 of each other: such pairs are compared,
   in blocks of sets, by matrix products.  So every pair that shares a bucket
   is connected, compared, or proven apart.
4. Links are confirmed on the full shingle sets, and grouped by union-find.

The work in step 3 is the members a hub does not link times the star; copies
of one text are mostly linked by their hub.

With 40 bands of 6 rows two texts at similarity 0.8 share no bucket with
probability 5e-6, at 0.9 with 1e-13.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import arrow_batches, bitmap, whole_row, with_membership
from fundflow.llm.graph import UnionFind, components
from fundflow.operators.stage import stage

WIDTH = 5
PERCENT = 80
BANDS, ROWS = 40, 6
#: Sets in a block and their elements, and columns of a block's 0/1 matrix: they bound a task's memory.
BLOCK_SETS = 512
BLOCK_ELEMENTS = 1 << 16
COLUMNS = 4096
CACHE_WORDS = 100_000
#: Elements whose permutations a task holds at once, and the rows that it is sent at once: texts, block pairs.
CHUNK = 1 << 15
BATCH_TEXTS, BATCH_BLOCKS = 1000, 32

_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes by word, started anew when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of a whole text's distinct shingles.  ``bytes.lower`` and
    ``bytes.split`` touch A-Z and the six ASCII blanks only."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(width, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix(out * _K1 + h[i:len(words) - n + 1 + i])
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, one row of ``m`` per set (none empty).

    Element e walks its own random permutation of the m slots; in step j it
    offers the slot it meets the value j + r, r random in [0, 1).  A slot keeps
    the least offer, so offers of later steps are larger than all of earlier
    ones, and a set stops once no slot holds an offer of a later step than the
    present one.  Values are integers: the step in the top 8 bits, r below.
    """
    if len(sets) == 1 and len(sets[0]) > CHUNK:
        # A slot's least offer over a union is the least over its parts.
        parts = [sets[0][i:i + CHUNK] for i in range(0, len(sets[0]), CHUNK)]
        return np.minimum.reduce([super_minhash([p], m) for p in parts])
    out = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.tile(np.arange(m, dtype=np.uint8), (len(elements), 1))
    live = np.arange(len(elements))
    for j in range(m):
        seed = mix(elements[live] + np.uint64((j + 1) * int(_K1) % (1 << 64)))
        k = j + (mix(seed ^ _K3) % np.uint64(m - j)).astype(np.int64)
        slot = order[live, k]
        order[live, k] = order[live, j]
        offer = (np.uint64(j) << np.uint64(56)) | (seed >> np.uint64(8))
        np.minimum.at(out, (owner[live], slot), offer)
        going = np.unique(owner[live])
        late = (out[going].max(axis=1) >> np.uint64(56)) > np.uint64(j)
        if not late.any():
            break
        if not late.all():
            keep = np.zeros(len(sets), bool)
            keep[going[late]] = True
            live = live[keep[owner[live]]]
    return out


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    x = signatures.reshape(len(signatures), bands, rows)
    h = np.full(x.shape[:2], 1, np.uint64)
    for i in range(rows):
        h = mix(h * _K1 + x[:, :, i])
    return h


def _sign_sets(sets: Iterator[np.ndarray], bands: int, rows: int) -> Iterator[tuple]:
    """Size, fingerprint and band hashes of every set, a chunk at a time."""
    def done() -> Iterator[tuple]:
        full = [s for s in chunk if len(s)]
        keys = iter(band_hashes(super_minhash(full, bands * rows), bands, rows).view(np.int64) if full else ())
        for s in chunk:
            hi, lo = np.array([xxhash.xxh64_intdigest(s.tobytes(), seed) for seed in (1, 2)], np.uint64).view(np.int64)
            yield len(s), hi, lo, next(keys) if len(s) else None

    chunk: list[np.ndarray] = []
    size = 0
    for s in sets:
        if size + len(s) > CHUNK:
            yield from done()
            chunk, size = [], 0
        chunk.append(s)
        size += len(s)
    yield from done()


def sign(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, n, hi, lo, bands`` of ``docs (doc_id, text)``: size and
    fingerprint of the shingle set, and its band hashes (NULL when empty)."""
    @F.arrow_udf("n long, hi long, lo long, bands array<long>")
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for texts in batches:  # one text at a time leaves the Arrow buffer
            done = list(_sign_sets((shingles(t.as_py(), width, hashes) for t in texts), bands, rows))
            columns = [pa.array([x[i] for x in done], pa.int64()) for i in range(3)]
            yield pa.StructArray.from_arrays([*columns, pa.array([x[3] for x in done], pa.list_(pa.int64()))],
                                             ["n", "hi", "lo", "bands"])

    return docs.select("doc_id", signed("text").alias("__s")).select("doc_id", "__s.*")


def verify(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``u, v, common, both``: sizes of intersection and union of the full
    shingle sets of every pair.  Only texts of documents in ``pairs`` move."""
    ids = pairs.select(F.explode(F.array("u", "v")).alias("id")).select(F.xxhash64("id").alias("__h"))
    some = (with_membership(texts.withColumn("__h", F.xxhash64("id")), bitmap(ids, "__h"), "__h", "__in")
            .filter("__in").select("id", "text"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        last, last_set = None, np.empty(0, np.uint64)
        for pdf in batches:
            common, both = [], []
            for tu, tv in zip(pdf["tu"], pdf["tv"]):
                if tu != last:  # pairs of one hub come together
                    last, last_set = tu, shingles(tu, width, hashes)
                b = shingles(tv, width, hashes)
                shared = len(np.intersect1d(last_set, b, assume_unique=True))
                common.append(shared)
                both.append(len(last_set) + len(b) - shared)
            yield pd.DataFrame({"u": pdf["u"], "v": pdf["v"], "common": common, "both": both})

    return (pairs.join(some.select(F.col("id").alias("v"), F.col("text").alias("tv")), "v")
            .join(some.select(F.col("id").alias("u"), F.col("text").alias("tu")), "u")
            .select("u", "v", "tu", "tv").mapInPandas(compare, "u long, v long, common long, both long"))


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set in ``a`` with every set in
    ``b``, as products of 0/1 matrices over the elements both sides have."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(flat_a, flat_b)
    sides = []
    for flat, sets in ((flat_a, a), (flat_b, b)):
        at = np.searchsorted(both, flat)
        at[at == len(both)] = 0
        here = both[at] == flat if len(both) else np.zeros(len(flat), bool)
        order = np.argsort(at[here], kind="stable")
        sides.append((np.repeat(np.arange(len(sets)), [len(x) for x in sets])[here][order], at[here][order]))
    out = np.zeros((len(a), len(b)), np.float32)  # exact up to 2^24
    for first in range(0, len(both), COLUMNS):
        x = []
        for (row, col), n in zip(sides, (len(a), len(b))):
            lo, hi = np.searchsorted(col, [first, first + COLUMNS])
            m = np.zeros((n, COLUMNS), np.float32)
            m[row[lo:hi], col[lo:hi] - first] = 1.0
            x.append(m)
        out += x[0] @ x[1].T
    return out


def _compare_blocks(percent: int):
    """Links between the sets of two blocks, as the edges of a forest."""
    def sets_of(row, side: str) -> tuple[np.ndarray, list[np.ndarray]]:
        sizes = np.frombuffer(getattr(row, f"sizes_{side}"), np.int64)
        return (np.frombuffer(getattr(row, f"ids_{side}"), np.int64),
                np.split(np.frombuffer(getattr(row, f"sets_{side}"), np.uint64), np.cumsum(sizes)[:-1]))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                (ia, a), (ib, b) = sets_of(row, "a"), sets_of(row, "b")
                common = shared_counts(a, b).astype(np.int64)
                both = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b]) - common
                x, y = np.nonzero(common * 100 >= both * percent)
                uf = UnionFind()
                links = [(u, v) for u, v in zip(ia[x].tolist(), ib[y].tolist()) if u != v and uf.union(u, v)]
                yield pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return compare


def link_classes(classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Links ``u, v`` that connect all classes ``(id, n, bands)`` as the links
    between them do; None without any."""
    spark = classes.sparkSession
    slack = 1.0 - percent / 100.0 + 1e-9
    entries = classes.select("id", F.posexplode("bands").alias("band", "h"))
    buckets = stage(entries.groupBy("band", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-buckets")
    if buckets.isEmpty():
        return None
    few = with_membership(entries, bitmap(buckets, "h"), "h", "__in").filter("__in").drop("__in")
    members = stage(few.join(buckets, ["band", "h"]), "near-members")
    # The hub is the member that agrees with most others over all its bands: of copies, the one nearest to all.
    degree = members.groupBy("id").agg(F.sum("n").alias("degree"))
    hubs = (members.join(degree, "id").groupBy("band", "h")
            .agg(F.max(F.struct("degree", "id"))["id"].alias("hub")))
    stars = stage(members.join(hubs, ["band", "h"]).filter("id <> hub").select("hub", "id").distinct(), "near-stars")
    ids = stars.select(F.explode(F.array("hub", "id")).alias("id")).distinct()
    near = with_membership(docs.select(F.col("doc_id").alias("id"), "text").withColumn("__h", F.xxhash64("id")),
                           bitmap(ids.select(F.xxhash64("id").alias("__h")), "__h"), "__h", "__in")
    texts = stage(near.filter("__in").select("id", "text"), "near-texts")

    with arrow_batches(spark, BATCH_TEXTS):
        tested = stage(verify(stars.select(*_pair("hub", "id")).distinct(), texts, width), "near-tested")
    linked = F.col("common") * 100 >= F.col("both") * percent
    links = tested.filter(linked).select("u", "v")
    distance = tested.groupBy("u", "v").agg(F.min(1.0 - F.col("common") / F.col("both")).alias("d"),
                                            F.max(linked).alias("linked"))
    star = stage(stars.withColumns({"u": F.least("hub", "id"), "v": F.greatest("hub", "id")})
                 .join(distance, ["u", "v"]).select("hub", "id", "d", "linked"), "near-star")
    # Members that a hub did not link, against the others of its star, in blocks.
    # Summaries by hub are written first, so that each join has the members of a large star as a plain side, which
    # adaptive execution splits.
    least = stage(star.filter("NOT linked").groupBy("hub").agg(F.min("d").alias("least")), "near-least")
    there = stage(star.join(least, "hub").filter(~F.col("linked") | (F.col("d") >= F.col("least") - slack)), "near-there")
    several = stage(there.groupBy("hub").agg(F.count(F.lit(1)).alias("all")).filter("all > 1").select("hub"), "near-several")
    there = stage(there.join(several, "hub").join(classes.select("id", "n"), "id")
                  .withColumn("bin", F.floor(F.col("d") * 50).cast("int")), "near-sized")
    key = ["hub", "linked", "bin"]
    cuts = stage(there.groupBy(*key).agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_ELEMENTS)).alias("cuts")), "near-cuts")
    there = stage(there.join(cuts, key).withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts")))
                  .select(*key, "cut", "id", "d"), "near-open")
    if there.isEmpty():
        return links

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = WordHashes()
        sets = [shingles(t, width, hashes) for t in pdf["text"]]
        first = pdf.iloc[0]
        return pd.DataFrame({"hub": [first["hub"]], "linked": [first["linked"]], "bin": [first["bin"]],
                             "cut": [first["cut"]], "low": [pdf["d"].min()], "high": [pdf["d"].max()],
                             "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                             "sizes": [np.array([len(s) for s in sets], np.int64).tobytes()],
                             "sets": [np.concatenate(sets).tobytes()]})

    packing = there.join(texts, "id").groupBy(*key, "cut").applyInPandas(
        packed, "hub long, linked boolean, bin int, cut long, low double, high double, ids binary, sizes binary, "
                "sets binary")
    with arrow_batches(spark, BATCH_TEXTS):
        blocks = stage(packing, "near-blocks")
    side = lambda s, cols: [F.col(c).alias(f"{c}_{s}") for c in cols]
    name, load = ["linked", "bin", "cut"], ["ids", "sizes", "sets"]
    a = blocks.filter("NOT linked").select("hub", *side("a", [*name, "low", "high"]))
    b = blocks.select("hub", *side("b", [*name, "low", "high"]))
    once = F.col("linked_b") | (F.struct("bin_a", "cut_a") <= F.struct("bin_b", "cut_b"))
    near_enough = (F.col("low_a") <= F.col("high_b") + slack) & (F.col("low_b") <= F.col("high_a") + slack)
    pairs = a.join(b, "hub").filter(once & near_enough).select("hub", *[f"{c}_{s}" for s in "ab" for c in name])
    full = lambda s: blocks.select("hub", *side(s, [*name, *load]))
    found = (pairs.join(full("a"), ["hub", *[f"{c}_a" for c in name]]).join(full("b"), ["hub", *[f"{c}_b" for c in name]])
             .select(*[f"{c}_{s}" for s in "ab" for c in load])
             .mapInPandas(_compare_blocks(percent), "u long, v long"))
    with arrow_batches(spark, BATCH_BLOCKS):
        return links.unionByName(stage(found, "near-found"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Words are split at ASCII blanks and lower-cased in A-Z.  A text's set is
    its distinct shingles of ``width`` words, all its words as one where there
    are fewer; a NULL text or one without words has an empty set and links
    with nothing.  Documents are linked when intersection over union of their
    sets is at least ``percent`` / 100; ``component_id`` is the smallest id
    reachable, itself included.

    Rows that repeat an id are one document, linked by any of their texts.  A
    row with a NULL id gets no component, and is kept.  An empty table gives
    no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with arrow_batches(docs.sparkSession, BATCH_TEXTS):
        signed = stage(sign(docs, width, bands, rows), "near-signed")
    some = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stage(some.groupBy("hi", "lo").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("size"),
                                                 F.first("n").alias("n"),
                                                 F.first("bands").alias("bands")), "near-classes")
    # An id that repeats with other texts ties their classes together.
    tied = (some.select("doc_id", "hi", "lo").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"))
            .filter("k > 1").select("doc_id"))
    ties = (some.select("doc_id", "hi", "lo").join(tied, "doc_id").join(classes.select("hi", "lo", "id"), ["hi", "lo"])
            .select(*_pair("doc_id", "id")).filter("u <> v"))
    links = link_classes(classes.select("id", "n", "bands"), docs, width, percent)
    links = ties if links is None else links.unionByName(ties)
    root = components(links, "near-cc")
    # Class to component, for classes that have more than one document; a skewed class is a plain join's row side.
    moved = classes.select("hi", "lo", "id", "size").join(root, F.col("id") == F.col("node"), "left")
    moved = stage(moved.filter("size > 1 OR root IS NOT NULL")
                  .select("hi", "lo", F.coalesce("root", "id").alias("root")), "near-moved")
    return (signed.select("doc_id", "n", "hi", "lo").join(moved, ["hi", "lo"], "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(),
                                               F.coalesce(F.when(F.col("n") > 0, F.col("root")), F.col("doc_id"))))
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs``, all columns, with one document of every group: the one with
    the smallest id.  Only ids of dropped documents meet the rows, and only
    rows that may carry one are shuffled.

    A row goes only if its own text has a partner that stays.  Where an id
    stands for several texts, each is a document of its own and gives way to
    rows whose id stands for one; rows that repeat id and text share the
    verdict.  Rows with a NULL id stay.
    """
    rows = docs.select(whole_row(docs), F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    rows = rows.withColumn("__digest", F.xxhash64(F.coalesce("__text", F.lit(""))))
    several = stage(rows.filter("__id IS NOT NULL").groupBy("__id")
                    .agg(F.min("__digest").alias("a"), F.max("__digest").alias("b")).filter("a <> b").select("__id"),
                    "near-several-texts")
    if not several.isEmpty():
        rows = rows.withColumn("__h", F.xxhash64("__id"))
        rows = with_membership(rows, bitmap(several.select(F.xxhash64("__id").alias("__h")), "__h"), "__h", "__in")
        # Ids of their own behind all others: 62 bits of id and text.
        own = F.xxhash64("__id", "__text").bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
        unsure = rows.filter("__in").join(several.withColumn("__several", F.lit(True)), "__id", "left")
        rows = (rows.filter("NOT __in").select("__row", "__id", "__text")
                .unionByName(unsure.withColumn("__id", F.when(F.col("__several"), own).otherwise(F.col("__id")))
                             .select("__row", "__id", "__text")))
    dropped = stage(near_duplicates(rows, "__id", "__text", **kw).filter("NOT kept")
                    .select(F.col("doc_id").alias("__id")).distinct(), "near-dropped")
    rows = rows.select("__row", "__id").withColumn("__h", F.xxhash64("__id"))
    flagged = with_membership(rows, bitmap(dropped.select(F.xxhash64("__id").alias("__h")), "__h"), "__h", "__in")
    unsure = flagged.filter("__in").join(dropped, "__id", "left_anti")
    return flagged.filter("NOT __in").select("__row.*").union(unsure.select("__row.*"))
