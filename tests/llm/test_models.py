"""Language ID, quality and URL reputation."""

import numpy as np
import pytest
from helpers_llm import DOCS, ngrams

from fundflow.llm import langid, quality, url_reputation
from fundflow.llm.common import table
from fundflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def unpack(codes):
    out = []
    for x in codes.tolist():
        points = []
        while x:
            points.append(x & ((1 << 21) - 1))
            x >>= 21
        out.append(tuple(reversed(points)))
    return out


def test_ngrams_match_brute_force():
    counter = langid.NgramCounter()
    for text in ("", None, "a", "Ab, cd!  É_ß9x", " -- ", "日本 𐐀x", "İstanbul", "a" * 3000 + " b"):
        codes, counts = counter.count(text)
        assert dict(zip(unpack(codes), counts.tolist())) == dict(ngrams(text))


def test_out_of_place_distance():
    p = langid.Profiles({"x": [10, 20, 30], "y": [30, 20, 10], "z": [40, 50, 60]}, top=3)
    assert p.nearest(np.array([10, 20, 30])) == ("x", 1.0)
    lang, score = p.nearest(np.array([30, 99, 10]))   # y: 0 + 3 + 0; x: 2 + 3 + 2
    assert lang == "y" and score == pytest.approx(1 - 3 / 9)
    assert p.nearest(np.array([], np.int64)) == ("und", 0.0)
    assert langid.Profiles({}).nearest(np.array([1])) == ("und", 0.0)


EN, DE = "the cat and the dog went to the town", "der hund und die katze gehen in die stadt"


def test_identify_languages_edge_cases(spark):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de", None, 1) for i in range(40)]
    rows += [(50, None, "en", None, 1), (51, "", None, None, 1), (52, "123 !?", "de", None, 1), (53, (EN + " ") * 4000, None, None, 1),
             (54, DE, None, None, 1), (54, DE, None, None, 1), (None, EN, "en", None, 1)]
    docs = spark.createDataFrame([(*r, "q") for r in rows], DOCS + ", lang_pred string")
    out = langid.identify_languages(docs).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: r["lang_pred"] for r in out}
    assert [got[i] for i in (50, 51, 52, 53, 54, None)] == ["und", "und", "und", "en", "de", "en"]
    assert all(0 <= r["score"] <= 1 for r in out) and {r["held_out"] for r in out if r["doc_id"] is None} == {False}
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"]: r["lang"] for r in kept.collect()}[53] == "en"
    assert kept.count() == len(rows) - 3
    empty = spark.createDataFrame([], DOCS)
    assert langid.identify_languages(empty).count() == 0 and langid.keep_identified(empty).count() == 0


def test_only_texts_without_a_letter_are_dropped(spark):
    """Not those for which no language could be learned, nor those nearest to a label that reads und."""
    texts = [(1, EN), (2, DE), (3, "123 !?"), (4, None), (5, "")]
    unlabelled = spark.createDataFrame([(i, t, None, "s", 1) for i, t in texts], DOCS)
    assert sorted((r["doc_id"], r["lang"]) for r in langid.keep_identified(unlabelled).collect()) == [(1, None), (2, None)]
    # A label only where the text is NULL teaches nothing either.
    apart = spark.createDataFrame([(i, t, "en" if t is None else None, "s", 1) for i, t in texts], DOCS)
    assert sorted((r["doc_id"], r["lang"]) for r in langid.keep_identified(apart).collect()) == [(1, None), (2, None)]
    und = spark.createDataFrame([(1, EN, "en", "s", 1), (2, DE, "und", "s", 1), (3, DE, None, "s", 1), (4, "4", "und", "s", 1),
                                 (5, DE, "en", "s", 1)], DOCS)
    assert sorted((r["doc_id"], r["lang"]) for r in langid.keep_identified(und, max_docs=2).collect()) == [
        (1, "en"), (2, "und"), (3, "und"), (5, "en")]


def test_training_sample_is_bounded_and_fold_free(spark):
    rows = [(i, EN if langid_fold(i) else "zzz qqq", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    inside = langid.learn_profiles(docs.filter(~langid.held_out(docs["doc_id"], 3, 1)), max_docs=20)
    codes, _ = langid.NgramCounter().count("zzz qqq")
    assert not set(codes.tolist()) & set(inside.vocab.tolist())


def langid_fold(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 3 != 1


def test_language_accuracy_on_held_out(spark):
    out = QUERIES["op1_rank_order_langid"](spark, SF).filter("held_out").join(
        table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").filter("lang IS NOT NULL").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97


def walk(trees, x):
    """One row through every tree, node by node."""
    total = trees.base
    inner = trees.feature.shape[1]
    for t in range(len(trees.feature)):
        i = 0
        while i < inner:
            i = 2 * i + 1 + int(x[trees.feature[t, i]] > trees.cut[t, i])
        total += trees.value[t, i - inner]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_match_a_walk_and_learn():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    trees = quality.fit(x[:2000], y[:2000])
    s = trees.score(x)
    assert np.allclose(s[:50], [walk(trees, r) for r in x[:50]])
    assert ((s[2000:] > 0.5) == y[2000:]).mean() > 0.95
    assert quality.fit(np.zeros((0, 5)), np.zeros(0)).score(x[:2]).tolist() == [0.5, 0.5]
    assert (quality.fit(x[:9], np.ones(9)).score(x[:2]) > 0.9).all()
    same = quality.fit(np.ones((50, 3)), np.r_[np.ones(25), np.zeros(25)])
    assert np.allclose(same.score(np.ones((2, 3))), 0.5)


def test_statistics():
    got = dict(zip(quality.FEATURES, quality.statistics("Ab ab 12!\nx\nx\n")))
    assert got["digits"] == 2 / 14 and got["upper"] == 1 / 6 and got["distinct_lines"] == 2 / 3
    assert got["distinct_words"] == 3 / 5 and got["one_letter_words"] == 2 / 5 and got["symbol_words"] == 1 / 5
    assert quality.statistics(None) == quality.statistics("") == [0.0] * len(quality.FEATURES)


def test_quality_accuracy_and_edge_cases(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = quality.score_quality(docs, labels)
    held = out.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    odd = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (None, "x", 5.0), (3, "a" * 200_000, 5.0), (3, "b", 5.0)],
                                "doc_id long, text string, score double")
    bad_labels = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0), (77, 1)], "doc_id long, quality int")
    got = quality.score_quality(odd, bad_labels).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score_quality(odd.limit(0), bad_labels.limit(0)).count() == 0


URLS = [("http://A.Example.COM/fr/x?q#f", "a.example.com", "/fr/x"), ("ftp://h", "h", ""), ("http://h?x/y", "h", ""),
        ("http://h#/y", "h", ""), ("x://y://z/p", "y:", "//z/p"), ("no scheme/fr/", "", ""), (None, "", ""), ("", "", ""),
        ("http:///p", "", "/p"), ("http://É.com/É", "É.com", "/É"), ("a\nb://h/p\nq?r", "h", "/p\nq")]


def test_host_path_and_rules(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(u,) for u, _, _ in URLS], "url string")
    got = df.select(url_reputation.url_host(F.col("url")), url_reputation.url_path(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [(h, p) for _, h, p in URLS]
    cases = [("x.org", "/a", "org/", "allow"), ("x.org", "", None, None), ("example.org", "/es/1", "example.org/es/", "block"),
             ("www.example.org", "/en/17", "example.org/en/1", "block"), ("myexample.org", "/es/", "org/", "allow"),
             ("a.com", "/fr/", "com/fr/", "allow"), ("com", "/de/x", "com/de/", "block"), ("a.com", "/en/", None, None),
             ("acom", "/fr/", None, None)]
    df = spark.createDataFrame([(h, p) for h, p, _, _ in cases], "host string, path string")
    rule, verdict = url_reputation.matching_rule(F.col("host"), F.col("path"))
    assert [tuple(r) for r in df.select(rule, verdict).collect()] == [(r, v) for _, _, r, v in cases]
    hosts = [("a.b.example.com", "example.com", "com"), ("x.co.uk", "x.co.uk", "co.uk"), ("w.x.co.uk", "x.co.uk", "co.uk"),
             ("10.0.0.1", "10.0.0.1", ""), ("u@h.net:80", "h.net", "net"), ("localhost", "localhost", ""), ("", "", "")]
    df = spark.createDataFrame(hosts, "host string, d string, s string")
    dom = url_reputation.domain_of(F.col("host"))
    assert all(r[0] == r["d"] and r[1] == r["s"] for r in
               df.select(dom.alias("x"), url_reputation.suffix_of(dom).alias("y"), "d", "s").collect())


def reputation(hosts):
    """host -> (n, k) to host -> (mean, bound), level by level in plain Python."""
    domain = {h: ".".join(h.split(".")[-2:]) for h in hosts}
    suffix = {d: d.split(".", 1)[1] for d in domain.values()}

    def total(keys, of):
        out = {}
        for k in keys:
            n, g = out.get(of[k], (0, 0))
            out[of[k]] = (n + keys[k][0], g + keys[k][1])
        return out

    def strength(groups):
        N, K, G = sum(n for n, _ in groups), sum(k for _, k in groups), len(groups)
        p = K / N
        spread = sum(k * k / n for n, k in groups) - N * p * p
        denominator = N - sum(n * n for n, _ in groups) / N
        between = (spread - (G - 1) * p * (1 - p)) / denominator if denominator else None
        s = p * (1 - p) / between - 1 if between and between > 0 else 1000.0
        return min(max(s, 1.0), 1000.0), p

    seen = {h: nk for h, nk in hosts.items() if nk[0]}
    domains = total(seen, domain)
    suffixes = total(domains, suffix)
    (sh, mean), (sd, _), (ss, _) = strength(list(seen.values())), strength(list(domains.values())), strength(list(suffixes.values()))
    out = {}
    for h, (n, k) in hosts.items():
        ns, ks = suffixes.get(suffix[domain[h]], (0, 0))
        nd, kd = domains.get(domain[h], (0, 0))
        m = (ks + ss * mean) / (ns + ss)
        m = (kd + sd * m) / (nd + sd)
        a, b = k + sh * m, n - k + sh * (1 - m)
        mu = a / (a + b)
        out[h] = (mu, min(mu + url_reputation.Z * (mu * (1 - mu) / (a + b + 1)) ** 0.5, 1.0))
    return out


def test_reputation_matches_plain_python(spark):
    import random
    rnd = random.Random(3)
    hosts = {f"{s}{i}.d{i % 7}.{t}": (n, sum(rnd.random() < q for _ in range(n)))
             for i in range(40) for s, t, q in (("a", "com", .9), ("b", "net", .4)) for n in [rnd.randrange(0, 30)]}
    df = spark.createDataFrame([(h, n, k) for h, (n, k) in hosts.items()], "host string, n long, k long")
    want = reputation(hosts)
    got = url_reputation.host_reputation(df).collect()
    assert len(got) == len(hosts)
    for r in got:
        assert (r["reputation"], r["bound"]) == pytest.approx(want[r["host"]], abs=1e-9)
        assert r["verdict"] == ("block" if want[r["host"]][1] < url_reputation.CUT else "allow")
    assert {r["verdict"] for r in got} == {"block", "allow"}


def test_judge_urls_edge_cases(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, (u, _, _) in enumerate(URLS)] + [(1, "ftp://h", "x"), (None, "http://h/", "x")],
                                  "page_id long, url string, verdict string")
    none = spark.createDataFrame([], "page_id long, good int")
    out = url_reputation.judge_urls(pages, none).collect()
    assert len(out) == len(URLS) + 2 and {r["reputation"] for r in out} == {0.5}
    some = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1)], "page_id long, good int")
    assert url_reputation.judge_urls(pages, some).count() == len(URLS) + 2
    assert url_reputation.judge_urls(pages.limit(0), some).count() == 0


def test_query_blocks_a_planted_bad_host(spark, scratch):
    """Outcomes are those of the documents that the pages show, not of equal ids."""
    pages = [(1000 + i, f"http://bad.spam.example.net/en/{i}.html?x=1") for i in range(40)]
    pages += [(i, f"http://good{i % 4}.example.com/en/{100 + i}/") for i in range(80)]
    pages += [(2000, "http://bad.spam.example.net/about"), (2001, "http://new.example.edu/7777"), (2002, None)]
    labels = [(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(80)] + [(2000, 1), (1, None), (500, 0)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{scratch}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{scratch}/labels.parquet")
    out = QUERIES["op2_url_reputation"](spark, scratch).collect()
    assert len(out) == len(pages)
    assert {r["host"] for r in out if r["verdict"] == "block"} == {"bad.spam.example.net"}
    assert sum(r["verdict"] == "block" for r in out) == 41  # the unlabelled page of that host too


def test_document_number_of_a_url(spark):
    from pyspark.sql import functions as F
    urls = {"http://h/en/17": 17, "http://h/en/17.html": 17, "http://h/en/17/?q=3#9": 17, "http://h/17x": None, "http://h/": None,
            "h/en/5": None, "http://h/en/17.html/x": None, "http://h/" + "9" * 30: None, "http://h/5\n": None, None: None}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r["u"]: r["n"] for r in df.select("u", url_reputation.shown_document(F.col("u")).alias("n")).collect()} == urls


def test_training_sample_of_a_label_with_one_repeated_id(spark):
    """Such a label is learned, from every different text of it."""
    rows = [(7, EN, "en")] * 300 + [(7, f"{DE} {'abc'[i % 3]}", "de") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert learned(docs, 20) == {"en", "de"} and learned(docs, 2) == {"en", "de"}


def learned(docs, most):
    return set(langid.learn_profiles(docs, max_docs=most).langs)
