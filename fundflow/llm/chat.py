"""Chat formatting with typed content parts (native).

A message's content is a list of parts.  The visitor of a part's type turns
it into a piece of the output: text is written with control strings escaped;
an image, audio clip or document becomes one placeholder, and its reference
and the number of tokens it expands to are recorded in order.  The pieces of
a conversation are joined between turn marks, and the spans of assistant text
make up the loss mask.

    <|start|>role<|text|>piece piece ...<|end|>

Escaping puts one zero-width joiner behind the first character of a control
string inside a role or text, and one more where such joiners already stand
there; taking one away restores the text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Marks of the template, and other strings that models read as control strings.
START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
CONTROL = (START, TEXT, END, *PLACEHOLDERS.values(), "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>")
#: Tokens a part expands to where it does not say so itself.
EXPANSION = {"image": 576, "audio": 1500, "document": 2048}
JOINER = "\u200d"

PART_TYPE = "struct<type:string,text:string,ref:string,tokens:bigint>"


def _behind(first: str) -> str:
    """What follows ``first`` in the control strings, as a regex alternation."""
    quote = lambda s: "".join("\\" + ch if not ch.isalnum() else ch for ch in s)
    return "|".join(quote(c[1:]) for c in CONTROL if c[0] == first)


_ESCAPE = rf"(?:(?<=<)(?=\x{{200D}}*(?:{_behind('<')})))|(?:(?<=\[)(?=\x{{200D}}*(?:{_behind('[')})))"
_UNESCAPE = rf"(?:(?<=<)\x{{200D}}(?=\x{{200D}}*(?:{_behind('<')})))|(?:(?<=\[)\x{{200D}}(?=\x{{200D}}*(?:{_behind('[')})))"


def escape(c: Column) -> Column:
    """Make control strings in ``c`` inert; undone by :func:`unescape`."""
    return F.regexp_replace(c, _ESCAPE, JOINER)


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _UNESCAPE, "")


def text_parts(text: Column) -> Column:
    """Content of a text-only message; NULL counts as empty."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("tokens")))


def visit(part: Column) -> Column:
    """The piece a part leaves in the output.  A type without a visitor is
    written as text, so nothing is dropped."""
    piece = escape(F.coalesce(part["text"], F.lit("")))
    for kind, mark in PLACEHOLDERS.items():
        piece = F.when(part["type"] == kind, F.lit(mark)).otherwise(piece)
    return piece


def expanded_tokens(part: Column) -> Column:
    """Tokens a placeholder stands for; NULL for text."""
    n = F.lit(None).cast("bigint")
    for kind, default in EXPANSION.items():
        n = F.when(part["type"] == kind, F.coalesce(part["tokens"], F.lit(default).cast("bigint"))).otherwise(n)
    return n


def format_chats(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans,
    attachments, expanded``.

    ``messages`` has ``conv_id, turn, role, parts`` (``parts`` an array of
    ``type, text, ref, tokens``).  ``loss_spans`` lists ``(turn_start, start,
    length, turn)`` in code points of ``formatted`` (``turn`` counts turns
    from 0), one per text part of a turn whose role is in ``loss_roles``; ``attachments`` lists ``(at, type, ref,
    tokens)`` in order; ``expanded`` is their tokens.

    Messages are ordered by turn, ties by role and content; repeated rows are
    all written.  A NULL role or text is empty, a message without parts has
    one empty text, NULL turns come first, a NULL conversation id is a
    conversation of its own.  An empty table gives no rows.

    Offsets are running sums over a conversation's pieces, so the work is in
    proportion to its length.  A conversation becomes one string, as the
    output asks, so one that is huge takes one task; conversations share
    nothing.
    """
    empty = text_parts(F.lit(""))
    m = messages.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.when(F.coalesce(F.size("parts"), F.lit(0)) > 0, F.col("parts")).otherwise(empty).alias("parts"))
    # Rows of one turn in content order; each message keeps its parts together.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    m = m.withColumn("__m", F.row_number().over(order))
    p = (m.withColumn("__n", F.size("parts")).select("conv_id", "__m", "role", "__n", F.posexplode("parts").alias("__i", "part"))
         .withColumn("__head", F.when(F.col("__i") == 0, F.concat(F.lit(START), escape(F.col("role")), F.lit(TEXT)))
                     .otherwise(F.lit("")))
         .withColumn("__body", visit(F.col("part")))
         .withColumn("__tail", F.when(F.col("__i") == F.col("__n") - 1, F.lit(END)).otherwise(F.lit("")))
         .withColumn("__piece", F.concat("__head", "__body", "__tail")))
    at = Window.partitionBy("conv_id").orderBy("__m", "__i").rowsBetween(Window.unboundedPreceding, -1)
    turn = Window.partitionBy("conv_id", "__m")
    is_text = ~F.coalesce(F.col("part.type").isin(*PLACEHOLDERS), F.lit(False))
    p = (p.withColumn("__at", F.coalesce(F.sum(F.char_length("__piece")).over(at), F.lit(0)))
         .withColumn("__turn_at", F.min("__at").over(turn))
         .withColumn("__start", F.col("__at") + F.char_length("__head")))
    row = F.struct("__m", "__i", F.col("__piece").alias("piece"),
                   F.when(is_text & F.col("role").isin(*loss_roles),
                          F.struct(F.col("__turn_at").alias("turn_start"), F.col("__start").alias("start"),
                                   F.char_length("__body").cast("bigint").alias("length"),
                                 (F.col("__m") - 1).cast("int").alias("turn"))).alias("loss"),
                   F.when(~is_text, F.struct(F.col("__start").alias("at"), F.col("part.type").alias("type"),
                                             F.col("part.ref").alias("ref"), expanded_tokens(F.col("part")).alias("tokens")))
                   .alias("att"))
    chats = p.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("__rows"))
    there = lambda field: F.filter(F.transform("__rows", lambda r: r[field]), lambda x: x.isNotNull())
    return (chats.select("conv_id", F.array_join(F.transform("__rows", lambda r: r["piece"]), "").alias("formatted"),
                         there("loss").alias("loss_spans"), there("att").alias("attachments"))
            .withColumn("expanded", F.aggregate("attachments", F.lit(0).cast("bigint"),
                                                lambda acc, a: acc + F.coalesce(a["tokens"], F.lit(0)))))


def read_turns(formatted: Column) -> Column:
    """Parse ``formatted`` back into ``array<struct<raw, role, content>>``:
    role unescaped, content still escaped (it may hold placeholders)."""
    raw = F.filter(F.split(formatted, rf"(?<=<\|end\|>)(?=<\|start\|>|\z)", -1), lambda t: t != "")
    parts = lambda t: F.split(F.substring(t, F.lit(len(START) + 1), F.char_length(t) - len(START) - len(END)),
                              r"<\|text\|>", 2)
    return F.transform(raw, lambda t: F.struct(t.alias("raw"), unescape(F.get(parts(t), 0)).alias("role"),
                                               F.get(parts(t), 1).alias("content")))


def read_loss(turns: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order.  A span is read from
    the turn it names, so the work stays in proportion to the conversation."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        F.get(turns, s["turn"])["raw"], (s["start"] - s["turn_start"] + 1).cast("int"), s["length"].cast("int")))), "")
