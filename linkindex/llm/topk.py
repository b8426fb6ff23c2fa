"""Exact top-k search by exhaustive term-at-a-time accumulation.

Candidates are dealt into blocks, queries too, and each block of queries meets each block of
candidates in one task. There the candidates become postings: for every term, a component of the
vector, the rows that have it and its weights. A query goes through its own terms one at a time and
scatters the weighted postings into a dense array of scores, one per candidate of the block; then the
best are selected by partition. The few best of every block are merged per query.

A task holds one block of each side; only the queries' best rows leave it. Both sides are replicated
once per block of the other, which is the work itself: every query against all rows. How many blocks
there are is planned from rows, queries, width and cores: blocks are as large as a task can hold, so that rows
are copied seldom, and while there are fewer tasks than the cores need, the candidates are split on,
which copies only the queries.

Scores are 64-bit. Vectors whose products could leave them are an error, not another score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkindex.llm.common import quoted

#: Components of a block, and rows that it has at least where candidates are split for the cores.
BLOCK_VALUES, LEAST_ROWS = 1 << 20, 512
#: Tasks for each core.
TASKS_PER_CORE = 2


def planned_blocks(rows: int, queries: int, width: int, cores: int) -> tuple[int, int]:
    """Numbers of blocks of candidates and of queries."""
    held = max(1, BLOCK_VALUES // max(1, width))
    n_candidates, n_queries = max(1, -(-rows // held)), max(1, -(-queries // held))
    wanted = -(-TASKS_PER_CORE * cores // n_queries)
    return max(n_candidates, min(wanted, rows // LEAST_ROWS)), n_queries


def integer_vectors(rows: DataFrame, scale: int, *, id_column: str = "vec_id",
                    vector_column: str = "embedding") -> DataFrame:
    """``id, terms``: floor(scale * x) of each component x, as double. Rows without an id or a vector
    and vectors that hold a null or a number that is not finite are left out."""
    x = quoted(vector_column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (
        rows.filter(quoted(id_column).isNotNull() & x.isNotNull())
        .filter(F.coalesce(finite, F.lit(False)))
        .select(quoted(id_column).cast("long").alias("id"),
                F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("terms"))
    )


class Postings:
    """The rows of a block by term."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]):
        self.ids = ids
        self.rows = len(ids)
        width = max(map(len, vectors), default=0)
        dense = np.zeros((width, self.rows), dtype=np.int64)
        for row, v in enumerate(vectors):
            dense[:len(v), row] = v
        self.terms = []
        for weights in dense:
            held = np.flatnonzero(weights)
            # a term that all rows have needs no list of rows
            self.terms.append((None if len(held) == self.rows else held,
                               weights if len(held) == self.rows else weights[held]))

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but the query's own, smaller ids first among equals."""
        scores = np.zeros(self.rows, dtype=np.int64)
        for term in np.flatnonzero(query[:len(self.terms)]):
            held, weights = self.terms[term]
            if held is None:
                scores += weights * query[term]
            else:
                scores[held] += weights * query[term]
        other = np.flatnonzero(self.ids != own)
        scores, ids = scores[other], self.ids[other]
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            above = np.flatnonzero(scores > least)
            equal = np.flatnonzero(scores == least)  # ids ascend within a block
            keep = np.concatenate([above, equal[:k - len(above)]])
            scores, ids = scores[keep], ids[keep]
        return ids, scores


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each query the k highest inner products among the other
    rows, ties to the smaller id; all, if there are fewer.

    ``vectors`` has ``id, terms``; ``is_query`` is a condition on ``id``. Missing components count as
    0. Rows of the query's own id are no candidates; a row that repeats an id is a candidate of its
    own. An empty table gives no rows. Where the largest component could make a product that 64 bits do not
    hold, a ``ValueError`` is raised before anything is searched.
    """
    size = F.transform("terms", lambda t: F.abs(t.cast("double")))
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q"),
                        F.max(F.size("terms")).alias("width"), F.max(F.array_max(size)).alias("most")).first()
    width, most = sizes["width"] or 0, sizes["most"] or 0
    if width * most * most >= 2**63:
        raise ValueError(f"components up to {most:g} in {width} dimensions: inner products may exceed 64 bits")
    spark = vectors.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = max(partitions, spark.sparkContext.defaultParallelism)
    n_candidates, n_queries = planned_blocks(sizes["n"], sizes["q"], width, cores)

    def dealt(rows: DataFrame, own: int, other: int, side: int) -> DataFrame:
        blocks = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        block = F.pmod(F.xxhash64("id"), F.lit(own)).cast("int")
        rows = rows.select("id", "terms", F.lit(side).alias("side"), block.alias("_own"),
                           blocks.alias("_other"))
        first, second = ("_own", "_other") if side == 0 else ("_other", "_own")
        return rows.select((F.col(first) * F.lit(n_queries).cast("long") + F.col(second)).alias("task"),
                           "side", "id", "terms")

    both = dealt(vectors, n_candidates, n_queries, 0).union(
        dealt(vectors.filter(is_query), n_queries, n_candidates, 1))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(ids: list, rows: list, queries: list) -> pa.RecordBatch:
            block = Postings(np.array(ids, np.int64), rows)
            got = [(own, *block.best(own, query, k)) for own, query in queries]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([g[0] for g in got], [len(g[1]) for g in got]), pa.int64()),
                 pa.array(np.concatenate([g[1] for g in got]), pa.int64()),
                 pa.array(np.concatenate([g[2] for g in got]), pa.int64())],
                names=["query_id", "vec_id", "score"])

        now, ids, rows, queries = None, [], [], []
        for batch in batches:
            offsets = batch["terms"].offsets.to_numpy()
            flat = batch["terms"].values.to_numpy()
            columns = (batch[c].to_pylist() for c in ("task", "side", "id"))
            for at, (task, side, number) in enumerate(zip(*columns, strict=True)):
                if task != now:
                    if queries and ids:
                        yield found(ids, rows, queries)
                    now, ids, rows, queries = task, [], [], []
                vector = flat[offsets[at]:offsets[at + 1]].astype(np.int64)
                if side:
                    queries.append((number, vector))
                else:
                    ids.append(number)
                    rows.append(vector)
        if queries and ids:
            yield found(ids, rows, queries)

    tasks = n_candidates * n_queries
    best = (
        both.repartition(max(tasks, partitions), "task").sortWithinPartitions("task", "side", "id")
        .mapInArrow(search, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def top_k_search(rows: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """The k best of every row whose id is divisible by ``every``, against all rows."""
    return top_k(integer_vectors(rows, scale), F.col("id") % every == 0, k)
