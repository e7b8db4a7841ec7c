"""Cross-tokenizer alignment by lockstep vectorised merging.

Two tokenizers cut the same bytes; where a token of each ends at one byte,
both sequences can be cut.  The tokens between two such cuts are a group, and
every A token of a group is linked with every B token of it.

The byte ends of all documents of a window are laid end to end.  One NumPy
state vector holds the A and B pointers of all lanes, a lane being a document
or, in a long one, a stretch of ``LANE`` A tokens.  At each step every lane
compares its two ends: equal ends are a cut, close a group and emit its links;
else the pointer that is behind goes on.  Finished lanes are compacted away,
so a window takes about as many steps as its longest lane has tokens.  Whether
a byte is a cut does not depend on what came before, so a lane that starts
inside a document just waits for its first cut.

Id pairs are counted over the whole corpus: a window keeps each of its pairs
once with its number of documents, the counts come back to the window by one
join, and the documents' figures are read off there.  Texts and token
sequences are never shuffled.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import arrow_batches
from fundflow.operators.stage import stage

#: Text of a window: it bounds a task's memory, and the rows that pairs take.
WINDOW_BYTES = 4 << 20
#: Rows that a task is sent at once.
ARROW_ROWS = 128
#: A tokens of a lane.
LANE = 512
#: Groups of more links than this are expanded over their distinct ids, one by one.
WIDE_GROUP = 256

# Fixed value: how a byte-level tokenizer splits text before its merges.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Encode = Callable[[list[str]], list[list[int]]]


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for:
    printable Latin-1 characters for themselves, the others by their order
    from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)})
    return out


def byte_level(blob: bytes) -> tuple[Encode, list[bytes]]:
    """Encoder of ``space + text`` and token bytes of a byte-level BPE file.

    Where the merges are in the order of their ids, which makes the file a
    rank table, the faster library for such tables encodes texts of early
    Latin letters without very long blanks, for which both libraries split
    alike; the file's own library encodes everything else."""
    from tokenizers import Tokenizer

    spec = json.loads(blob)
    symbol = byte_of_symbol()
    vocab, added = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
    table = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
    for token, i in vocab.items():
        table[i] = token.encode() if token in added else bytes(symbol[c] for c in token)
    loaded: list = []

    def encode_slow(texts: list[str]) -> list[list[int]]:
        if not loaded:
            loaded.append(Tokenizer.from_str(blob.decode()))
            loaded[0].encode_special_tokens = True
        # One text at a time: the library's own threads stay off.
        return [loaded[0].encode(" " + t, add_special_tokens=False).ids for t in texts]

    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
    pre = spec["pre_tokenizer"] or {}
    if not ([vocab.get(m) for m in merged] == list(range(256, 256 + len(merged))) and spec["normalizer"] is None
            and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")):
        return encode_slow, table
    import tiktoken

    fast = tiktoken.Encoding("ranks", pat_str=PRETOKENS, special_tokens={},
                             mergeable_ranks={table[i]: i for t, i in vocab.items() if t not in added})
    other = re.compile(r"[^\x00-\u024f\u2010-\u203a]|\s{1000}")

    def encode(texts: list[str]) -> list[list[int]]:
        return [encode_slow([t])[0] if other.search(t) else fast.encode_ordinary(" " + t) for t in texts]

    return encode, table


def pieces(blob: bytes) -> tuple[Encode, list[bytes]]:
    """Encoder and token bytes of a sentence-piece model, which puts the space
    before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=blob)
    table = []
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", p)
        table.append(bytes([int(byte[1], 16)]) if byte else p.replace("\u2581", " ").encode())
    return lambda texts: model.encode(texts, num_threads=1), table


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
             lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups ``(first A, number of A, first B, number of B)`` in order.

    ``end_a`` and ``end_b`` are the tokens' byte ends, documents laid end to
    end; ``first_a`` and ``first_b`` hold every document's first token and, at
    the end, the number of tokens.  Every document has tokens, of a byte at
    least each, and ends at one byte in both."""
    if len(first_a) < 2:
        return (np.empty(0, np.int64),) * 4
    if end_a[-1] < 2 ** 31 - 1:  # narrow state vectors
        end_a, end_b, first_a, first_b = (x.astype(np.int32) for x in (end_a, end_b, first_a, first_b))
    # Lanes: the start of each document, and inside it the byte behind every lane-th A token.
    size = np.diff(first_a)
    extra = (size - 1) // lane
    doc = np.repeat(np.arange(len(size)), extra)
    inner = first_a[:-1][doc] + lane * (np.arange(extra.sum()) - np.repeat(extra.cumsum() - extra, extra) + 1)
    start = end_a[inner - 1]
    a = np.concatenate([first_a[:-1], inner - 1])
    b = np.concatenate([first_b[:-1], np.searchsorted(end_b, start)])
    opened = np.concatenate([np.ones(len(size), bool), np.zeros(len(inner), bool)])
    at = np.concatenate([end_a[first_a[:-1]] - 1, start])  # before every end inside the document
    order = np.argsort(at, kind="stable")
    at = at[order]
    a, b, opened = a[order], b[order], opened[order]
    # A lane owns the groups that start before the next lane does.
    stop = np.append(at[1:], end_a[-1])
    last = np.append(opened[1:], True)
    stop[last] = end_a[first_a[1:] - 1]
    group_a, group_b = a.copy(), b.copy()
    out = []
    while len(a):
        ea, eb = end_a[a], end_b[b]
        cut = ea == eb
        shut = np.nonzero(cut & opened)[0]
        if len(shut):
            out.append((group_a[shut], a[shut] + 1 - group_a[shut], group_b[shut], b[shut] + 1 - group_b[shut]))
        a = a + (ea <= eb)
        b = b + (eb <= ea)
        np.copyto(group_a, a, where=cut)
        np.copyto(group_b, b, where=cut)
        opened |= cut
        going = ~(cut & (ea >= stop))
        if not going.all():
            a, b, group_a, group_b, opened, stop = (x[going] for x in (a, b, group_a, group_b, opened, stop))
    ga, na, gb, nb = (np.concatenate(x).astype(np.int64) for x in zip(*out))
    order = np.argsort(ga, kind="stable")
    return ga[order], na[order], gb[order], nb[order]


def links(groups: tuple, ids_a: np.ndarray, ids_b: np.ndarray, doc: np.ndarray, width: int,
          height: int) -> tuple[np.ndarray, np.ndarray]:
    """``(document * height * width + A id * width + B id, links)`` of every
    document's linked id pairs, ascending; ``doc`` is each group's document."""
    ga, na, gb, nb = groups
    key = lambda d, a, b: (d * height + a) * width + b
    n = na * nb
    few = np.nonzero(n <= WIDE_GROUP)[0]
    rep = np.repeat(few, n[few])
    k = np.arange(len(rep)) - np.repeat(n[few].cumsum() - n[few], n[few])
    keys = [key(doc[rep], ids_a[ga[rep] + k // nb[rep]], ids_b[gb[rep] + k % nb[rep]])]
    counts = [np.ones(len(rep), np.int64)]
    for g in np.nonzero(n > WIDE_GROUP)[0].tolist():
        a, ca = np.unique(ids_a[ga[g]:ga[g] + na[g]], return_counts=True)
        b, cb = np.unique(ids_b[gb[g]:gb[g] + nb[g]], return_counts=True)
        keys.append(key(doc[g], a[:, None], b[None, :]).ravel())
        counts.append((ca[:, None] * cb[None, :]).ravel())
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    new = np.nonzero(np.diff(keys, prepend=-1))[0]
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts


def written(groups: tuple, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All groups as ``a1,a2|b1;a3|b2,b3;`` and the place behind each one."""
    ga, na, gb, nb = groups
    total = len(ids_a) + len(ids_b)
    ids, sign = np.empty(total, np.int32), np.full(total, ord(","), np.uint8)
    # An A token stands behind the B tokens of the groups before, a B token behind the A tokens up to its group's.
    ids[np.arange(len(ids_a)) + np.repeat(gb, na)] = ids_a
    ids[np.arange(len(ids_b)) + np.repeat(ga + na, nb)] = ids_b
    sign[ga + na - 1 + gb] = ord("|")
    ends = ga + na + gb + nb
    sign[ends - 1] = ord(";")
    # Every id's digits, right-aligned behind zero bytes, and a place for the sign.
    most = int(ids.max(initial=0))
    digits = len(str(most))
    table, left = np.zeros((most + 1, digits + 1), np.uint8), np.arange(most + 1)
    for i in range(digits - 1, -1, -1):
        table[:, i] = np.where((left > 0) | (i == digits - 1), left % 10 + ord("0"), 0)
        left = left // 10
    size = (table > 0).sum(axis=1)
    chars = table[ids]
    chars[:, digits] = sign
    chars = chars.ravel()
    return chars[chars > 0].tobytes(), np.concatenate([[0], (size[ids] + 1).cumsum()])[ends]


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane: small ones compress well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


_DOC = "block long, at int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
_SCHEMA = _DOC + ", pairs array<long>, docs array<int>, sizes binary, places binary, linked binary"


def align(docs: DataFrame, vocab_a: str, vocab_b: str, id_col: str = "doc_id", text_col: str = "text",
          window_bytes: int = WINDOW_BYTES, lane: int = LANE) -> DataFrame:
    """Alignments of ``space + text`` by a byte-level BPE file ``vocab_a`` and
    a sentence-piece model ``vocab_b`` (paths on the driver; their content
    travels with the job, a few MB).

    One row per document: ``block, at, doc_id, n_a, n_b, n_groups, n_links,
    groups``, the last as ``a1,a2|b1;a3|b2,b3`` in decimal ids, and one row
    per window (``at`` -1) with its linked id pairs, for :func:`with_counts`.
    A document whose text is NULL or empty, or whose A or B tokens do not
    spell the bytes of ``space + text``, has no tokens: zeros and an empty
    string.  Strings of special tokens are plain text.  Repeated rows and NULL
    ids are documents of their own, other columns are ignored, an empty table
    gives no rows.  A window holds ``window_bytes`` of text or one longer text.
    """
    blobs = docs.sparkSession.sparkContext.broadcast((open(vocab_a, "rb").read(), open(vocab_b, "rb").read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, bytes_a = byte_level(blobs.value[0])
        encode_b, bytes_b = pieces(blobs.value[1])
        len_a, len_b = (np.fromiter(map(len, t), np.int64, len(t)) for t in (bytes_a, bytes_b))
        block = TaskContext.get().partitionId() << 32

        def flush(block: int, ids: list, texts: list) -> list[pa.RecordBatch]:
            spelled = lambda table, tokens, raw: b"".join(map(table.__getitem__, tokens)) == raw
            full = [i for i, t in enumerate(texts) if t]
            raws = [(" " + texts[i]).encode() for i in full]
            tok_a, tok_b = (enc([texts[i] for i in full]) for enc in (encode_a, encode_b))
            good = [k for k, raw in enumerate(raws) if spelled(bytes_a, tok_a[k], raw) and spelled(bytes_b, tok_b[k], raw)]
            del raws
            where = np.array([full[k] for k in good], np.int64)
            first = lambda tok: np.concatenate([[0], np.cumsum([len(tok[k]) for k in good])]).astype(np.int64)
            flat = lambda tok, f: np.fromiter((x for k in good for x in tok[k]), np.int64, int(f[-1]))
            first_a, first_b = first(tok_a), first(tok_b)
            ids_a, ids_b = flat(tok_a, first_a), flat(tok_b, first_b)
            del tok_a, tok_b
            groups = lockstep(len_a[ids_a].cumsum(), len_b[ids_b].cumsum(), first_a, first_b, lane)
            doc = np.searchsorted(first_a, groups[0], "right") - 1
            n = len(texts)
            n_a, n_b, n_groups, n_links = (np.zeros(n, np.int64) for _ in range(4))
            n_a[where], n_b[where] = np.diff(first_a), np.diff(first_b)
            n_groups[where] = np.bincount(doc, minlength=len(where))
            n_links[where] = np.bincount(doc, groups[1] * groups[3], len(where)).astype(np.int64)
            strings = [""] * n
            if len(where):
                text, behind = written(groups, ids_a, ids_b)
                ends = behind[n_groups[where].cumsum() - 1]
                for i, s, e in zip(where.tolist(), np.append(0, ends[:-1]).tolist(), ends.tolist()):
                    strings[i] = text[s:e - 1].decode()
                del text
            keys, linked = links(groups, ids_a, ids_b, doc, len(bytes_b), len(bytes_a))
            space = len(bytes_a) * len(bytes_b)
            pairs, place, in_docs = np.unique(keys % space, return_inverse=True, return_counts=True)
            sizes = np.zeros(n, np.int64)
            sizes[where] = np.bincount(keys // space, minlength=len(where))
            place = place.ravel()
            row = lambda *c: pa.RecordBatch.from_arrays(list(c), schema=schema)
            empty = [pa.nulls(n, f.type) for f in schema][8:]
            out = [row(pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), pa.array(ids, pa.int64()),
                       *map(pa.array, (n_a, n_b, n_groups, n_links)), pa.array(strings, pa.string()), *empty)]
            if len(pairs):
                one = lambda v, t: pa.array([v], t)
                out.append(row(one(block, pa.int64()), one(-1, pa.int32()), *[pa.nulls(1, f.type) for f in schema][2:8],
                               one(pairs, pa.list_(pa.int64())), one(in_docs.astype(np.int32), pa.list_(pa.int32())),
                               *[one(_planes(x), pa.binary()) for x in (sizes, np.diff(place, prepend=0), linked)]))
            return out

        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                i, t = i.as_py(), t.as_py()
                ids.append(i)
                texts.append(t)
                size += 64 + len(t or "")
                if size >= window_bytes:
                    yield from flush(block, ids, texts)
                    block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield from flush(block, ids, texts)

    schema = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                        ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
                        ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())), ("sizes", pa.binary()),
                        ("places", pa.binary()), ("linked", pa.binary())])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, count, best`` of every linked id pair (A id x size of B's
    vocabulary + B id): in how many documents it is linked, and whether no
    pair of its A id is in more.  A window's documents are counted already."""
    each = aligned.filter("at = -1").select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    return each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("count"))


def with_counts(aligned: DataFrame, vocab_b_size: int) -> DataFrame:
    """The documents of :func:`align` (which may have lost ``groups`` and
    gained columns), with ``n_best`` (links whose pair is in as many documents
    as any pair of its A id) and ``count_sum`` (sum of its pair's count over
    all links).

    Pairs travel once a window to their counts and back; a window's documents
    meet them in a task of their own, bounded by the window."""
    with arrow_batches(aligned.sparkSession, ARROW_ROWS):
        aligned = stage(aligned, "aligned")
    counts = stage(pair_counts(aligned), "pair-counts")
    a = F.expr(f"pair div {vocab_b_size}L")  # at most A's vocabulary of them
    top = counts.groupBy(a.alias("a")).agg(F.max("count").alias("top"))
    counts = counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    each = aligned.filter("at = -1").select(F.col("block").alias("window"), F.explode("pairs").alias("pair"))
    found = each.join(counts.hint("merge"), "pair").select("window", "pair", "count", "best")
    passed = [c for c in aligned.columns if c not in ("pairs", "docs", "sizes", "places", "linked")]
    fields = [aligned.schema[c] for c in passed]

    def read_off(rows: pa.Table, known: pa.Table) -> pa.Table:
        at = rows.column("at").to_numpy()
        n = int((at >= 0).sum())
        best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if known.num_rows:
            window = rows.slice(int(np.nonzero(at < 0)[0][0]), 1)
            blob = lambda c: _unplanes(window.column(c)[0].as_py())
            sizes = blob("sizes").astype(np.int64)
            place = np.cumsum(blob("places"), dtype=np.uint32).astype(np.int64)
            linked = blob("linked").astype(np.int64)
            order = np.argsort(known.column("pair").to_numpy())
            count = known.column("count").to_numpy()[order][place]
            is_best = known.column("best").to_numpy(zero_copy_only=False)[order][place]
            has = np.nonzero(sizes)[0]
            first = (sizes.cumsum() - sizes)[has]
            best[has] = np.add.reduceat(linked * is_best, first)
            total[has] = np.add.reduceat(linked * count, first)
        docs = rows.filter(pa.array(at >= 0)).select(passed)
        at = docs.column("at").to_numpy()
        return docs.append_column("n_best", pa.array(best[at])).append_column("count_sum", pa.array(total[at]))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_best long, count_sum long"
    return (aligned.drop("pairs", "docs").groupBy("block").cogroup(found.groupBy("window"))
            .applyInArrow(read_off, schema).drop("block", "at"))
