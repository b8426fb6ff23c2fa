"""Best-fit packing of documents into sequences under several capacities.

A sequence has three capacities: tokens, documents, and attention cost (the sum of its pieces' squared
lengths). Pieces go by length, longest first, each into the open sequence that vector best-fit selects
among those that can take it under every constraint: the least weighted norm of what is left, or the
largest weighted dot-product of the piece's demand and what is left.

All demands of a piece follow from its length, so the packing is planned on the histogram of lengths,
which has at most one row per length up to the capacity, however many pieces there are. Sequences with
the same residual are one range of numbers with one residual, and are filled together: by ``norm`` a sequence
that has taken a piece is the best one for the next of its length, until that does not fit, and by ``dot``
the others of its range come first. So the plan puts every piece where it would go if pieces went one by one. A plan row says
where the pieces of one length from one rank on go; there are as many as lengths, residuals and pieces of one
sequence make, which the capacities bound and not the data, and the plan is therefore broadcast.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkindex.llm.common import quoted, staged
from linkindex.llm.tokens import id_encoder

#: Pieces of one length that are ranked in one group: a length has as many groups as its pieces need.
GROUP_PIECES = 65_536


@dataclass(frozen=True)
class Capacities:
    """Of a sequence. Documents and cost default to what can never bind before the tokens."""

    tokens: int = 4096
    documents: int = 4096
    cost: int = 4096 * 4096

    @property
    def piece(self) -> int:
        """Tokens of the longest piece that an empty sequence can take."""
        return min(self.tokens, math.isqrt(self.cost))


@dataclass(frozen=True)
class Choice:
    """How a sequence is selected: ``norm`` or ``dot``, and the weights of tokens, documents, cost."""

    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, *,
               id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of at most ``capacity`` tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = id_encoder(vocabulary).encode, id_encoder(vocabulary).packed([end_id])
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = memoryview(encode(text) + end)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    narrow = docs.select(quoted(id_column).cast("long").alias("doc_id"),
                         quoted(text_column).alias("text"))
    return narrow.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def plan_bins(histogram: dict[int, int], capacities: Capacities, choice: Choice) -> dict[int, list]:
    """length -> rows (first rank, first sequence, pieces per sequence, offset), by rank."""
    if choice.rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {choice.rule}")
    size = np.array([capacities.tokens, capacities.documents, capacities.cost], dtype=np.float64)
    weights = np.asarray(choice.weights, dtype=np.float64)
    shortest = min(histogram, default=0)
    residual = np.zeros((1024, 3))  # of each open range; 0 tokens: closed
    ranges: list[tuple[int, int, int]] = []  # first sequence, number of them, used tokens
    free: list[int] = []
    sequences = 0
    plan: dict[int, list] = {}

    def open_range(first: int, count: int, used: int, left: np.ndarray) -> None:
        nonlocal residual
        if count <= 0 or left[0] < shortest or left[1] < 1 or left[2] < shortest**2:
            return
        if free:
            at = free.pop()
            ranges[at] = (first, count, used)
        else:
            at = len(ranges)
            ranges.append((first, count, used))
            if at == len(residual):
                residual = np.concatenate([residual, np.zeros_like(residual)])
        residual[at] = left

    for length in sorted(histogram, reverse=True):
        rows = plan.setdefault(length, [])
        rank, left = 0, histogram[length]
        demand = np.array([length, 1, length * length], dtype=np.float64)
        if (demand > size).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacities")
        while left:
            live = residual[:len(ranges)]
            fits = np.flatnonzero((live >= demand).all(axis=1))
            if len(fits):
                rest = live[fits] / size
                score = (
                    -(weights * (rest - demand / size) ** 2).sum(axis=1) if choice.rule == "norm"
                    else (weights * rest * (demand / size)).sum(axis=1)
                )
                at = int(fits[np.argmax(score)])
                (first, count, used), was = ranges[at], residual[at].copy()
                residual[at] = 0
                free.append(at)
            else:
                at, was, used, first = -1, size.copy(), 0, sequences
            each = 1 if at >= 0 and choice.rule == "dot" else int((was // demand).min())
            if at < 0:
                count = -(-left // each)
                sequences += count
            full = min(count, left // each)
            rows.append((rank, first, each, used))
            rank, left = rank + full * each, left - full * each
            open_range(first, full, used + each * length, was - each * demand)
            if full < count and left:  # the last pieces of this length go into one more sequence
                rank, some, left = rank + left, left, 0
                open_range(first + full, 1, used + some * length, was - some * demand)
                full += 1
            open_range(first + full, count - full, used, was)
    return plan


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacities: Capacities = Capacities(),
         choice: Choice = Choice(), *, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """Pieces with their sequence and place in it, for every row of ``docs``.

    A document is its ids and ``end_id``; null and empty texts are ``end_id`` alone. Only a document
    of more than ``capacities.piece`` tokens is cut, into pieces of that length. A null id stays null; repeated rows are packed each; an
    empty table gives no rows; other columns are not read. Pieces of one length are interchangeable
    and are ranked by id, piece and checksum.
    """
    pieces = staged(cut_pieces(docs, vocabulary, capacities.piece, end_id, id_column=id_column,
                               text_column=text_column))
    spark = pieces.sparkSession
    histogram = {
        r["length"]: r["n"]  # at most as many rows as a sequence has tokens
        for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    plan = spark.createDataFrame(
        [(length, -(-histogram[length] // GROUP_PIECES), *map(list, zip(*rows, strict=True)))
         for length, rows in plan_bins(histogram, capacities, choice).items()],
        "length long, _groups long, _ranks array<long>, _firsts array<long>, _each array<long>, _used array<long>",
    )
    grouped = pieces.join(F.broadcast(plan.select("length", "_groups")), "length").withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_groups"))).drop("_groups")
    counts = grouped.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_group")
    bases = counts.select(
        "length", "_group", (F.sum("_n").over(before) - F.col("_n")).alias("_base")
    )
    within = Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        grouped.withColumn("_row", F.row_number().over(within) - 1)
        # a row for each length and for each GROUP_PIECES pieces: Spark broadcasts what is small
        .join(bases, ["length", "_group"])
        .withColumn("_rank", F.col("_base") + F.col("_row"))
        .join(F.broadcast(plan.drop("_groups")), "length")
        .withColumn("_at", F.expr("size(filter(_ranks, r -> r <= _rank))"))
        .withColumn("_rank", F.expr("_rank - element_at(_ranks, _at)"))
    )
    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr("element_at(_firsts, _at) + _rank div element_at(_each, _at)").alias("sequence_id"),
        F.expr("element_at(_used, _at) + _rank % element_at(_each, _at) * length").alias("offset"),
    )
