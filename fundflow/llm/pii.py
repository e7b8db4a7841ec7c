"""Personal data by candidate gradient boosting (native).

1. *Rules.*  One scan finds, per kind, the leftmost non-overlapping matches of
   a base pattern; those that pass the kind's check (octets, Luhn, number of
   digits) are always redacted.
2. *Candidates.*  The same scan runs wider generators, whose spans overlap:
   addresses in any script or spelled out, chains of digits, defanged
   addresses.  A chain is a candidate phone and a candidate card at once.
3. *Trees.*  Boosted trees, fitted for each kind, score every candidate by its format (lengths, runs,
   separators, check digit) and its context (neighbouring characters, words
   before it).  They learn from the rules: a candidate that meets a base span
   of its kind is a positive, any other is unlabelled.  What a rule merely
   insists on, such as the plus sign of a phone number, is not a feature, so
   that look-alikes score alike.
4. *Thresholds.*  Calibrated per kind on documents the trees have not seen:
   the score that nearly all their positives reach, and at which nearly all
   unlabelled candidates are left out.  Candidates above it are redacted too.

Matches are found by splitting a text at a pattern, so that one pass gives the
matches and the gaps between them; places are running sums over the gaps,
taken by a window over the matches.  Only matches with a little context leave
the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundflow.llm.quality import Trees, fit
from fundflow.operators.stage import stage

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"

#: Patterns of the rules.  Possessive runs, entered only at their first character, match the same as the plain form
#: ``run+ ...`` does, without trying each later start of a run that has failed; ``\G`` lets a run go on where the
#: previous match ended.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_DOT = r"\x20?(?:\[\.\]|\(\.\)|[\[({]\x20?dot\x20?[\])}]|\.)\x20?"
#: Wider generators, and the kinds that their matches are candidates of.
WIDE = {
    "address": (rf"(?:\G|(?<![^\s@<>\"'(),;|]))[^\s@<>\"'(),;|]++@[^\s@<>\"'(),;|]++", ("email",)),
    "spelled": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\x20?[\[({{]\x20?(?:at|@)\x20?[\])}}]\x20?{_LABEL}++(?:{_DOT}{_LABEL}++)++",
                ("email",)),
    "quad": (rf"(?<![0-9])[0-9]++(?:{_DOT}[0-9]++){{3,5}}", ("ip",)),
    "chain": (r"\(?[0-9](?:[\x20().-]{0,2}+[0-9])++", ("card", "phone")),
}
#: What a text must contain for a pattern to be tried.
_NEEDS = {"email": "@", "address": "@", "phone": "+"}
GENERATORS = (*BASE, *WIDE)
#: Code points of context kept on the left.
CONTEXT = 24
_WORDS = {"email": "mail|write|contact|correo|schreib", "ip": r"\bip\b|host|server|address|login",
          "card": "card|visa|credit|amex|karte|tarjeta|carte", "phone": r"phone|call|tel\b|tel\.|fax|mobil|handy|whatsapp"}
FEATURES = ("length", "digits", "letters", "signs", "runs", "longest_run", "dots", "groups", "last_run", "luhn",
            "octets", "before", "after", "keyword", "digits_before", "parens", "other_script")

#: Bound of the training sample: candidates that are positive, and that are unlabelled, of each kind.
MAX_TRAIN = 2500
TREES, DEPTH = 16, 3
#: Folds of the documents; the trees see all but the last, which calibrates.
FOLDS = 4
#: Share of held-out positives that a threshold keeps, and of unlabelled candidates that it may let in.
KEEP, LET_IN = 0.95, 0.005


def find_all(text: Column, pattern: str) -> Column:
    """``array<struct<gap, found, size, before, after>>`` of a pattern's
    leftmost non-overlapping matches: code points since the previous match,
    the match, its length, and the text around it."""
    parts = F.struct(F.split(text, pattern, -1).alias("gaps"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def around(x: Column) -> Column:
        return F.transform(x["found"], lambda m, i: F.struct(
            F.char_length(F.get(x["gaps"], i)).cast("long").alias("gap"), m.alias("found"),
            F.char_length(m).cast("long").alias("size"), F.right(F.get(x["gaps"], i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(x["gaps"], i + 1), F.lit(1)).alias("after")))

    # Bound as a lambda's variable: both arrays are made once.
    return F.get(F.transform(F.array(parts), around), 0)


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, finds``: one row per document, ``finds`` an array of
    ``(generator, at, gap, found, size, before, after)``.  Written, so that
    row numbers stand."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<gap:bigint,found:string,size:bigint,before:string,after:string>>")
    tagged = []

    def tag(found: Column, g: int) -> Column:
        return F.transform(found, lambda m, i: F.struct(F.lit(g).alias("generator"), i.alias("at"), *[
            m[c].alias(c) for c in ("gap", "found", "size", "before", "after")]))

    for g, name in enumerate(GENERATORS):
        pattern = BASE.get(name) or WIDE[name][0]
        likely = text.contains(_NEEDS[name]) if name in _NEEDS else text.rlike("[0-9]") if name != "spelled" else \
            text.rlike(r"[\[({]\x20?(?:at|@)\x20?[\])}]")
        found = F.when(likely & text.rlike(pattern), find_all(text, pattern)).otherwise(none)
        tagged.append(tag(found, g))
    return stage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                             F.concat(*tagged).alias("finds")), "pii-finds")


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right: every second digit from the right is
    doubled, 9 taken off above 9, and the sum is a multiple of 10."""
    def add(total: Column, x: Column) -> Column:
        d = x["d"].cast("int") * F.when(x["i"] % 2 == 1, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
                       lambda c, i: F.struct(c.alias("d"), i.alias("i")))
    return F.aggregate(each, F.lit(0), add) % 10 == 0


def octets(found: Column) -> Column:
    """Whether every run of digits is at most 255."""
    runs = F.regexp_extract_all(found, F.lit("[0-9]+"), F.lit(0))
    return F.forall(runs, lambda r: F.regexp_replace(r, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def passes(kind: Column, found: Column) -> Column:
    """The check of a base match."""
    n = F.char_length(digits_of(found))
    return (F.when(kind == "ip", octets(found))
            .when(kind == "card", F.when(n.between(16, 19), luhn(digits_of(found))).otherwise(False))
            .when(kind == "phone", n.between(8, 15)).otherwise(True))


def _side(c: Column) -> Column:
    """Kind of a neighbouring character: 0 none or blank, 1 letter, 2 digit, 3 other."""
    return (F.when((c == "") | c.rlike(r"^\s"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).otherwise(3))


def with_features(spans: DataFrame) -> DataFrame:
    """``spans`` (kind, found, size, before, after) with a double column for each of :data:`FEATURES`."""
    f, before = F.col("found"), F.lower("before")
    digits = digits_of(f)
    runs = F.regexp_extract_all(f, F.lit(r"[\p{L}0-9]+"), F.lit(0))
    keyword = F.lit(False)
    for k, words in _WORDS.items():
        keyword = F.when(F.col("kind") == k, before.rlike(words)).otherwise(keyword)
    count = lambda p: F.regexp_count(f, F.lit(p))
    value = {
        "length": F.col("size"), "digits": F.char_length(digits), "letters": count(r"\p{L}"),
        "signs": count(r"[^\p{L}0-9]"), "runs": F.size(runs),
        "longest_run": F.array_max(F.transform(runs, F.char_length)), "dots": count(r"\."),
        "groups": count("[0-9]+"), "last_run": F.char_length(F.try_element_at(runs, F.lit(-1))),
        "luhn": F.when(F.char_length(digits) <= 32, luhn(digits)).otherwise(False), "octets": octets(f),
        "before": _side(F.right(F.regexp_replace("before", r"\+$", ""), F.lit(1))), "after": _side(F.col("after")),
        "keyword": keyword, "digits_before": F.regexp_count("before", F.lit("[0-9]")), "parens": count(r"[()\[\]{}]"),
        "other_script": F.regexp_count(f, F.lit(r"[^\x00-\x7F]")),
    }
    return spans.select("*", *[F.coalesce(value[n].cast("double"), F.lit(0.0)).alias(f"f_{n}") for n in FEATURES])


def candidates(finds: DataFrame) -> DataFrame:
    """Rows ``row, fold, kind, start, end, base, hit, f_*``: base spans that
    pass their check, and candidates, ``hit`` where one meets a base span of
    its kind."""
    m = finds.select("row", F.pmod(F.xxhash64(F.lit("pii"), "doc_id", "row"), F.lit(FOLDS)).cast("int").alias("fold"),
                     F.explode("finds").alias("x")).select("row", "fold", "x.*")
    before = Window.partitionBy("row", "generator").orderBy("at")
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = (m.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
         .withColumn("start", F.col("end") - F.col("size")))
    names = F.array(*[F.array(*map(F.lit, (g,) if g in BASE else WIDE[g][1])) for g in GENERATORS])
    m = (m.withColumn("base", F.col("generator") < len(BASE))
         .withColumn("kind", F.explode(F.get(names, F.col("generator"))))
         .filter(~F.col("base") | passes(F.col("kind"), F.col("found"))))
    m = with_features(m).drop("generator", "at", "gap", "found", "size", "before", "after")
    # Base spans of a kind do not overlap: a candidate meets one if the last that starts before its end ends behind its start.
    key = F.when(F.col("base"), F.col("start")).otherwise(F.col("end") - 1)
    met = Window.partitionBy("row", "kind").orderBy("__key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    m = m.withColumn("__key", key)
    return (m.withColumn("hit", F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(met) > F.col("start"), F.lit(False)))
            .drop("__key"))


@dataclass(frozen=True)
class Model:
    trees: dict[str, Trees]
    thresholds: dict[str, float]


def score(trees: dict[str, Trees]) -> Column:
    """Score of a candidate by the trees of its kind."""
    out = F.lit(0.0)
    for kind, t in trees.items():
        out = F.when(F.col("kind") == kind, tree_score(t)).otherwise(out)
    return out


def tree_score(trees: Trees) -> Column:
    """The trees as SQL over the ``f_*`` columns: every tree is a CASE."""
    inner = trees.feature.shape[1] if trees.feature.size else 0

    def node(t: int, i: int) -> Column:
        if i >= inner:
            return F.lit(float(trees.value[t, i - inner]))
        if not np.isfinite(trees.cut[t, i]):  # not split: all go left
            return node(t, 2 * i + 1)
        low = F.col(f"f_{FEATURES[int(trees.feature[t, i])]}") <= float(trees.cut[t, i])
        return F.when(low, node(t, 2 * i + 1)).otherwise(node(t, 2 * i + 2))

    total = F.lit(float(trees.base))
    for t in range(len(trees.feature)):
        total = total + node(t, 0)
    return 1.0 / (1.0 + F.exp(-total))


def learn(spans: DataFrame, max_rows: int = MAX_TRAIN, keep: float = KEEP, let_in: float = LET_IN) -> Model:
    """Trees from at most ``max_rows`` positive and as many unlabelled
    candidates of each kind outside the last fold, those with the smallest
    hash; thresholds from counts over all of the last fold (a kind without
    positives there adds nothing)."""
    cols = [f"f_{n}" for n in FEATURES]
    train = (spans.filter(~F.col("base") & (F.col("fold") != FOLDS - 1)).select("kind", "hit", "row", "start", "end", *cols)
             .withColumn("__h", F.xxhash64("row", "start", "end")))
    # A first cut by hash leaves about twice the bound of each group, so that no task sorts more.
    sizes = train.groupBy("kind", "hit").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2 x kinds
    share = F.lit(1.0)
    for r in sizes:
        share = F.when((F.col("kind") == r["kind"]) & (F.col("hit") == r["hit"]),
                       F.lit(min(1.0, (2.0 * max_rows + 100.0) / r["n"]))).otherwise(share)
    train = train.filter(F.col("__h") / 2.0 ** 64 + 0.5 <= share)
    first = Window.partitionBy("kind", "hit").orderBy("__h", "row", "start", "end")
    sample = (train.withColumn("__i", F.row_number().over(first)).filter(F.col("__i") <= max_rows)
              .orderBy("kind", "hit", "__i").select("kind", "hit", *cols).collect())  # at most 2 x kinds x max_rows
    trees = {}
    for kind in KINDS:
        rows = [r for r in sample if r["kind"] == kind]
        x = np.array([[r[c] for c in cols] for r in rows], float).reshape(len(rows), len(cols))
        trees[kind] = fit(x, np.array([r["hit"] for r in rows], float), TREES, DEPTH)
    # Scores take few values; counted in thousandths, they are one row a kind and thousandth.
    seen = (spans.filter(~F.col("base") & (F.col("fold") == FOLDS - 1))
            .withColumn("s", F.floor(score(trees) * 1000).cast("int"))
            .groupBy("kind", "s").agg(F.count_if("hit").alias("yes"), F.count_if(~F.col("hit")).alias("no")).collect())
    thresholds = {}
    for kind in KINDS:
        rows = sorted(((r["s"], r["yes"], r["no"]) for r in seen if r["kind"] == kind), reverse=True)
        yes, no = sum(r[1] for r in rows), sum(r[2] for r in rows)
        cut, got, wrong = None, 0, 0
        for s, y, n in rows:
            got, wrong = got + y, wrong + n
            if s < 500 or wrong > let_in * max(no, 1000):
                break
            cut = s / 1000
            if got >= keep * yes:
                break
        if cut is not None and yes:
            thresholds[kind] = cut
    return Model(trees, thresholds)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds: float) -> DataFrame:
    """One row per document: ``doc_id, base, spans``, arrays of ``(kind,
    start, end)`` in code points, end exclusive, ordered by kind (as in
    :data:`KINDS`), start and end.  ``base`` are the rules' spans, ``spans``
    those and what the trees add; additions may overlap each other, never a
    base span of their kind.

    NULL texts are empty, repeated rows and NULL ids are documents of their
    own and found alike, other columns are ignored, an empty table gives no
    rows.  Without candidates nothing is learned and nothing added.  The
    matches of one document come together in one row, as the output asks.
    """
    finds = findings(docs, id_col, text_col)
    spans = stage(candidates(finds), "pii-spans")
    model = learn(spans, **bounds)
    chosen = F.col("base")
    for kind, cut in model.thresholds.items():
        chosen = chosen | ((F.col("kind") == kind) & ~F.col("hit") & (F.floor(F.col("score") * 1000) >= round(cut * 1000)))
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct(kind.alias("k"), "start", "end", "kind")
    rows = (spans.withColumn("score", score(model.trees)).filter(chosen)
            .groupBy("row").agg(F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"),
                                F.sort_array(F.collect_set(span)).alias("spans")))
    plain = lambda c: F.transform(F.coalesce(c, F.array()), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                                           s["end"].alias("end")))
    return (finds.select("row", "doc_id").join(rows, "row", "left")
            .select("doc_id", plain(F.col("base")).alias("base"), plain(F.col("spans")).alias("spans")))


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: Sequence[str] = ("[", "]")) -> Column:
    """``text`` with every span replaced by its kind in upper case between
    ``mark``; of overlapping spans, the one that starts first and is longest
    stands.  NULL stays NULL."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"),
                                                                 s["kind"].alias("kind"))))
    init = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        new = F.struct(F.concat(acc["out"], gap, F.lit(mark[0]), F.upper(s["kind"]), F.lit(mark[1])).alias("out"),
                       (-s["back"]).alias("at"))
        return F.when(s["start"] >= acc["at"], new).otherwise(acc)

    return F.aggregate(ordered, init, step, lambda acc: F.concat(acc["out"], F.substring(
        text, (acc["at"] + 1).cast("int"), F.char_length(text))))
