"""Token alignment, whitening and personal data, against plain Python."""

import hashlib
import os
import re
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundflow.llm import alignment, pii, whitening
from fundflow.llm.queries import QUERIES, VOCAB_A, VOCAB_B, VOCAB_B_SIZE

SF = "/root/testdata/sf0.001"
needs_vocab = pytest.mark.skipif(not os.path.exists(VOCAB_A), reason="vocabulary files not present")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


# --- token alignment -----------------------------------------------------------

def plain_groups(a, b):
    """Groups of two lists of token byte strings, by the set of common ends."""
    ea, eb = [0, *accumulate(map(len, a))], [0, *accumulate(map(len, b))]
    ends = sorted(set(ea) & set(eb))
    return [(range(ea.index(s), ea.index(e)), range(eb.index(s), eb.index(e))) for s, e in zip(ends, ends[1:])]


@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.randoms()), max_size=6), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_lockstep_matches_common_ends(docs, lane):
    """Any lane length gives the groups of all common ends."""
    ends, firsts, expected = ([], []), ([0], [0]), []
    for sizes, rnd in docs:
        total = sum(sizes)
        cuts = sorted(rnd.sample(range(1, total), rnd.randint(0, total - 1))) + [total]
        other = [y - x for x, y in zip([0, *cuts], cuts)]
        base = (firsts[0][-1], firsts[1][-1])
        for ga, gb in plain_groups([b"x" * n for n in sizes], [b"x" * n for n in other]):
            expected.append((base[0] + ga[0], len(ga), base[1] + gb[0], len(gb)))
        for e, f, part in zip(ends, firsts, (sizes, other)):
            e.extend(part)
            f.append(f[-1] + len(part))
    got = alignment.lockstep(*(np.cumsum(e, dtype=np.int64) for e in ends), *(np.array(f, np.int64) for f in firsts), lane)
    assert list(zip(*(x.tolist() for x in got))) == expected


def test_wide_groups_count_every_link(monkeypatch):
    groups = tuple(np.array(x, np.int64) for x in ([0, 3], [3, 2], [0, 4], [4, 1]))
    ids_a, ids_b = np.array([1, 1, 2, 5, 6]), np.array([7, 8, 7, 7, 9])
    doc = np.array([0, 1])
    direct = [x.tolist() for x in alignment.links(groups, ids_a, ids_b, doc, 10, 10)]
    assert dict(zip(*direct)) == {17: 6, 18: 2, 27: 3, 28: 1, 159: 1, 169: 1}
    monkeypatch.setattr(alignment, "WIDE_GROUP", 1)
    assert [x.tolist() for x in alignment.links(groups, ids_a, ids_b, doc, 10, 10)] == direct


@pytest.fixture(scope="module")
def tokenizers_():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(VOCAB_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=VOCAB_B)
    symbol = alignment.byte_of_symbol()
    byte_a = {i: bytes(symbol.get(c, 63) for c in t) for t, i in a.get_vocab().items()}
    byte_b = {}
    for i in range(b.get_piece_size()):
        m = re.fullmatch("<0x(..)>", b.id_to_piece(i))
        byte_b[i] = bytes([int(m[1], 16)]) if m else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, byte_a, byte_b


def plain_alignments(texts, tok):
    """Contract columns of every text, by one document at a time."""
    a, b, byte_a, byte_b = tok
    docs, count = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        ia, ib = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        ta, tb = [byte_a[i] for i in ia], [byte_b[i] for i in ib]
        if not text or b"".join(ta) != raw or b"".join(tb) != raw:
            docs.append(None)
            continue
        groups = [([ia[i] for i in x], [ib[i] for i in y]) for x, y in plain_groups(ta, tb)]
        linked = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        count.update(linked.keys())
        docs.append((len(ia), len(ib), groups, linked))
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, linked = d
        s = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), linked.total(), sum(n for p, n in linked.items() if count[p] == top[p[0]]),
                    sum(n * count[p] for p, n in linked.items()), s))
    return out


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@needs_vocab
@pytest.mark.parametrize("window", [200, 1 << 22])
def test_alignment_of_difficult_texts(spark, tokenizers_, window):
    texts = [None, "", " ", "a", "Hello  world\n\n x", "tabs\t\there <|endoftext|> <s> </s> <unk> <0x41>", "x▁y", "日本語 テスト 🙂🙃 é́",
             "  lead and trail  ", "ÄÖÜß ñandú çà", "\x00\x01 control", "12345678901234567890", "the " * 3000, "a" * 5000,
             " " * 3000 + "x", "don't we'll I'VE", "same text", "same text", "x" * 700 + " y"]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "same text", "c", 1), (3, "a", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, at int")
    got = alignment.with_counts(alignment.align(docs, VOCAB_A, VOCAB_B, window_bytes=window, lane=7), VOCAB_B_SIZE).collect()
    expected = plain_alignments([r[1] for r in rows], tokenizers_)
    assert (sorted((str(r["doc_id"]), *(r[f] for f in FIELDS), r["groups"]) for r in got)
            == sorted((str(r[0]), *e) for r, e in zip(rows, expected)))
    assert got[0].asDict().keys() == {"doc_id", *FIELDS, "groups"}
    none = alignment.with_counts(alignment.align(docs.limit(0), VOCAB_A, VOCAB_B), VOCAB_B_SIZE)
    assert none.count() == 0


@needs_vocab
def test_both_libraries_encode_alike(tokenizers_):
    """Every character that the faster library is trusted with splits alike."""
    encode, _ = alignment.byte_level(open(VOCAB_A, "rb").read())
    points = [chr(c) for c in (*range(0x250), *range(0x2010, 0x203B))]
    texts = [f"ab{c}cd {c}1{c} {c}{c}\n{c} x" for c in points] + ["".join(points), "it's 've " * 50]
    assert encode(texts) == [tokenizers_[0].encode(" " + t, add_special_tokens=False).ids for t in texts]


@needs_vocab
@needs_tables
def test_align_query(spark, tokenizers_):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    expected = dict(zip(docs, plain_alignments(list(docs.values()), tokenizers_)))
    got = QUERIES["op11_lockstep_align"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        e = expected[r["doc_id"]]
        assert tuple(r[f] for f in FIELDS) == e[:6]
        assert r["groups_sha256"] == (hashlib.sha256(e[6].encode()).hexdigest() if e[6] else "")


# --- whitening -------------------------------------------------------------------

def check_whitening(rows, vectors, components=32):
    """Against the eigenvectors of the covariance, either sign."""
    x = [[int(np.floor(64 * float(c))) + 1000000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])
    _, sigma, vt = np.linalg.svd(centred, full_matrices=True)
    e, u = np.zeros(len(vt)), vt.T
    e[:len(sigma)] = sigma ** 2 / n
    k = min(components, len(e))
    at = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(at) == len(rows) == n * k
    alive = [c for c in range(k) if e[c] > 1e-20 * max(e[0], 1e-300)]
    w = np.array([[at[i, c + 1]["whitened"] for c in alive] for i in range(n)], float).reshape(n, len(alive))
    assert all(at[i, c + 1]["whitened"] is None for i in range(n) for c in range(k) if c not in alive)
    for j, c in enumerate(alive):
        ref = centred @ u[:, c] / np.sqrt(e[c])
        assert min(np.abs(w[:, j] - ref).max(), np.abs(w[:, j] + ref).max()) < 1e-6
        assert at[0, c + 1]["explained"] == pytest.approx(e[c] / e.sum(), rel=1e-9)
    exact = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    assert [at[i, 1]["deviation"] for i in range(n)] == [v if v < 2 ** 63 else None for v in exact]
    assert {(r["n"], r["identity_error"] < 1e-9) for r in rows} == {(n, True)}
    if alive:
        assert np.abs(w.T @ w / n - np.eye(len(alive))).max() < 1e-9


@pytest.mark.parametrize("kind", ["plain", "ill", "deficient", "few"])
def test_whitening_matches_eigenvectors(spark, kind):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(200, 8)) * 3 + 5
    if kind == "ill":
        v = v * np.logspace(4, -1, 8)
    elif kind == "deficient":  # a repeated and a constant dimension
        v = np.hstack([v[:, :4] * [9, 4, 2, 1], v[:, :1], np.full((200, 1), 3.0)])
    elif kind == "few":
        v = rng.normal(size=(3, 8))
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    check_whitening(whitening.whiten(df.repartition(3)).collect(), v)


def test_triangular_solve_and_shift():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(300, 150))
    r = np.linalg.cholesky(a.T @ a).T
    assert np.allclose(whitening.divide(a, r) @ r, a)
    q = whitening.divide(a, r)
    assert np.allclose(q.T @ q, np.eye(150))
    model = whitening.Whitening(10, [0, 0])
    assert not model.add_factor(np.array([[1.0, 1.0], [1.0, 1.0]]))  # singular: shifted, no failure
    assert model.factors[0][1, 1] > 0 and model.add_factor(np.eye(2))


def test_whitening_edge_cases(spark):
    good = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [3.0, -1.0]]
    bad = [None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [1e300, 0.0]]
    rows = [(i, v, "x", 0) for i, v in enumerate(good + bad)] + [(None, [2.0, 2.0], "x", 0), (20, [1.0, 2.0, 3.0], "x", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string, i int")
    got = whitening.whiten(df).collect()
    assert Counter(r["vec_id"] for r in got) == {0: 2, 1: 2, 2: 2, 3: 2, None: 2, 20: 3}
    check_whitening([{**r.asDict(), "vec_id": 4 if r["vec_id"] is None else r["vec_id"]} for r in got if r["vec_id"] != 20],
                    [*good, [2.0, 2.0]])
    alone = [r for r in got if r["vec_id"] == 20]  # a length of its own, without variance
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone} == {(1, 0, None, 0.0, 0.0)}
    assert whitening.whiten(df.limit(0)).collect() == []


def test_deviations_are_exact_beyond_doubles():
    v = np.array([[2.0 ** 37, 0.0], [-2.0 ** 37, 1.0], [0.1, 0.2]])
    m = whitening.Whitening(3, [int(c) for c in whitening.quantised(v).sum(axis=0)])
    x = whitening.quantised(v).tolist()
    exact = [sum((3 * c - s) ** 2 for c, s in zip(r, m.sums)) for r in x]
    assert m.deviations(v) == [e if e < 2 ** 63 else None for e in exact] and None in m.deviations(v)


@needs_tables
def test_whitening_query(spark):
    rows = sorted((r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    renumber = {i: k for k, (i, _) in enumerate(good)}
    got = [{**r.asDict(), "vec_id": renumber[r["vec_id"]]} for r in QUERIES["op12_cholesky_whitening"](spark, SF).collect()]
    check_whitening(got, [v for _, v in good])


# --- personal data ---------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and max(map(int, m[0].split("."))) <= 255
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


HARD = ["a@b.c%d@e.f x@y", "1.2.3.4.5.6.7.8 300.1.1.1 007.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111", "4111111111111111",
        "41111111111111111111", "+1 (017) 555-7713 +49 30 1234567- +1", "🙂 a@b.c 🙂🙂 +49 30 1234567", "a@" * 5 + "b.c", "", None,
        "+1 2+3 44 555 6666 ", "4111111111111112", "a..b@-.-", "x@y.z@w.v", "9" * 3000, "1 " * 3000, "a" * 20000,
        "me (at) mail [dot] com", "ñoño@exämple.org", "+" + "1" * 300, "1.2.3.4" * 2, "a@b" + ".c" * 5000]


@given(st.lists(st.text(alphabet="a1 .@-+()%4", max_size=40), min_size=1, max_size=8))
@settings(max_examples=8, deadline=None)
def test_base_spans_of_random_texts(spark, texts):
    check_base(spark, texts)


def check_base(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, kind string, row int")
    got = {r["doc_id"]: r for r in pii.find_pii(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert [tuple(s) for s in got[i]["base"]] == plain_base(t), t
        assert set(map(tuple, got[i]["base"])) <= set(map(tuple, got[i]["spans"]))
    return got


def test_base_spans_of_difficult_texts(spark):
    check_base(spark, HARD)


def test_trees_add_look_alikes_and_leave_numbers_alone(spark):
    """Learned from international numbers, the trees also find those written
    without the plus sign, and cards that stand twice in a row."""
    rng = np.random.default_rng(3)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))

    def card():
        body = digits(15)
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))

    rows = []
    for i in range(900):
        rows.append(f"some words +1 ({digits(3)}) 555-{digits(4)} and more" if i % 3 == 0 else
                    f"pay {card()} now" if i % 3 == 1 else f"on page {digits(2)} of {digits(4)} items")
    twice = card()
    rows += ["some words (017) 555-7713 and more", f"pay {twice} {twice} now", "on page 12 of 2034 items", "no number at all"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find_pii(docs).collect()}
    for i, text in enumerate(rows[:900]):
        assert got[i] == plain_base(text)
    assert [s[0] for s in got[900]] == ["phone"] and [s[0] for s in got[901]] == ["card"]
    assert plain_base(rows[900]) == plain_base(rows[901]) == got[902] == got[903] == []


def test_tree_columns_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, len(pii.FEATURES)))
    trees = pii.fit(x, (x[:, 0] * x[:, 3] > 0).astype(float), 5, 3)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                               "i long, " + ", ".join(f"f_{n} double" for n in pii.FEATURES))
    got = [r["s"] for r in df.withColumn("s", pii.tree_score(trees)).orderBy("i").collect()]
    assert np.allclose(got, trees.score(x))


def test_pii_edge_cases(spark):
    docs = spark.createDataFrame([(None, "q@w.e"), (None, "q@w.e"), (7, "q@w.e +1 555 123 4567"), (7, "q@w.e +1 555 123 4567"), (8, None)],
                                 "doc_id long, text string")
    got = pii.find_pii(docs).select("doc_id", pii.written(F.col("base")).alias("b")).collect()
    assert Counter(map(tuple, got)) == {(None, "email:0:5"): 2, (7, "email:0:5,phone:6:21"): 2, (8, ""): 1}
    assert pii.find_pii(docs.limit(0)).collect() == []
    spans = [("email", 4, 9), ("card", 2, 9), ("ip", 12, 14), ("ip", 0, 2)]
    df = spark.createDataFrame([("🙂bcdefghijklmnop", spans), (None, []), ("xy", [])],
                               "text string, spans array<struct<kind:string,start:long,end:long>>")
    assert [r[0] for r in df.select(pii.redact(F.col("text"), F.col("spans"))).collect()] == ["[IP][CARD]jkl[IP]op", None, "xy"]


def test_pii_is_native(spark):
    docs = spark.createDataFrame([(1, "q@w.e")], "doc_id long, text string")
    plan = pii.find_pii(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan.split("== Physical Plan ==")[1])


@needs_tables
def test_pii_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_boosted_pii"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        base = plain_base(docs[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in base) for k in PLAIN]
        text = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert set(text) <= set(r["spans"].split(",")) | {""}


def test_find_without_letters_and_digits(spark):
    """Its last run of letters and digits was looked for and ended the job."""
    got = check_base(spark, ["write to %@-.- or a@b.c"])
    assert [s["kind"] for s in got[0]["base"]] == ["email", "email"]
