"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role merge into
one block, and the blocks are joined into one text:

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n<|im_start|>...

Control strings cannot occur inside a text: ``&`` is written ``&amp;`` and ``<|`` is written
``&lt;|``; in a role a line feed is also written ``&#10;``. All three are undone when a text is read
back, so any text comes back as it was, and the turns of a merged block come back one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkindex.llm.arrays import let, pieces, running_sums
from linkindex.llm.common import quoted

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def _split(text: Column, mark: str) -> Column:
    pattern = mark.replace("|", "\\|")
    return F.split(text, pattern, -1)


def format_chats(turns: DataFrame, *, loss_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans``, one row per conversation.

    ``turns`` has ``conv_id, turn, role, text``. Rows go by turn, rows of an equal turn by role and
    text, null turns first; null roles and texts count as empty; repeated rows are turns of their own;
    a null conv_id is a conversation too; an empty table gives none; other columns are not read.
    ``loss_spans`` are the ``start`` (from 0) and ``length``, in code points, of the texts of
    ``loss_role`` in ``formatted``.
    """
    empty = F.lit("")
    rows = turns.select(
        quoted("conv_id").cast("long").alias("conv_id"), quoted("turn").alias("turn"),
        escaped_role(F.coalesce(quoted("role"), empty)).alias("role"),
        escaped(F.coalesce(quoted("text"), empty)).alias("text"),
    )
    ordered = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # a block begins where the role changes
    last = F.size("turns") - 1
    begins = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == 0) | (F.col("turns")[i].role != F.col("turns")[F.greatest(i - 1, F.lit(0))].role))
    bounded = ordered.withColumn("begins", begins)
    ends = F.concat(F.slice("begins", F.lit(2), F.size("begins")), F.array(F.size("turns")))
    merged = F.transform(
        F.arrays_zip(F.col("begins").alias("at"), ends.alias("to")),
        lambda b: F.struct(
            F.col("turns")[b["at"]].role.alias("role"),
            F.transform(F.slice("turns", b["at"] + 1, b["to"] - b["at"]), lambda t: t.text).alias("texts"),
        ))
    blocks = bounded.select("conv_id", merged.alias("blocks"))
    heads = F.transform("blocks", lambda b: F.concat(F.lit(START), b.role, F.lit("\n")))
    parts = F.transform(
        F.arrays_zip(F.col("blocks").alias("b"), heads.alias("head")),
        lambda x: F.concat(x["head"], F.array_join(x["b"].texts, SEPARATOR), F.lit(END)))
    placed = blocks.select(
        "conv_id", "blocks", F.array_join(parts, "").alias("formatted"),
        F.transform(parts, lambda p: F.length(p).cast("long")).alias("lengths"))
    # where each block begins: a running sum over the blocks, and over the texts within a block
    ends = running_sums(F.col("lengths"))
    located = placed.withColumn("starts", let(ends, lambda e: F.transform(
        "lengths", lambda n, k: F.get(e, k) - n)))

    def spans(x: Column) -> Column:
        block, start = x["b"], x["start"]
        first = start + len(START) + F.length(block.role) + 1
        ends = running_sums(F.transform(block.texts, lambda t: F.length(t) + len(SEPARATOR)))
        return let(ends, lambda ends: F.transform(block.texts, lambda t, k: F.struct(
            (first + F.get(ends, k) - len(SEPARATOR) - F.length(t)).cast("long").alias("start"),
            F.length(t).cast("long").alias("length"))))

    masked = F.filter(F.arrays_zip(F.col("blocks").alias("b"), F.col("starts").alias("start")),
                      lambda x: x["b"].role == escaped_role(F.lit(loss_role)))
    return located.select("conv_id", "formatted", F.flatten(F.transform(masked, spans)).alias("loss_spans"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text, formatted_chars`` read back from the formatted text alone.

    ``turns`` are structs of role and text, as they were; ``loss_text`` is all text under the spans.
    """
    blocks = F.slice(_split(F.col("formatted"), END), F.lit(1),
                     F.greatest(F.size(_split(F.col("formatted"), END)) - 1, F.lit(0)))

    def turns(block: Column) -> Column:
        body = F.substring(block, F.lit(len(START) + 1), F.length(block))
        role = F.substring_index(body, "\n", 1)
        texts = F.substring(body, F.length(role) + 2, F.length(body))
        return F.transform(
            _split(texts, SEPARATOR),
            lambda t: F.struct(unescaped_role(role).alias("role"), unescaped(t).alias("text")))

    # a block of no turns does not exist, so a text of no blocks is an empty conversation
    points = F.concat(F.array(F.lit(0).cast("long")), F.transform("loss_spans", lambda s: s.start))
    loss = let(pieces(F.col("formatted"), points), lambda cut: F.transform("loss_spans", lambda s, k: unescaped(
        F.substring(F.get(cut, k + 1), F.lit(1), s.length.cast("int")))))
    return formatted.select(
        "conv_id", F.flatten(F.transform(blocks, turns)).alias("turns"),
        F.array_join(loss, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def digests(chats: DataFrame) -> DataFrame:
    """Numbers and digests of what is read back from the formatted conversations."""
    line = F.lit("\n")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, line, t.text, line)), "")
    return read_chats(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
