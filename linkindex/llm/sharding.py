"""Placement in shards by a permutation-filled lookup table.

Every shard has a permutation of the slots of a table of prime size, made of an offset and a step.
The shards take turns, as often as their weights say, and each claims the first slot of its order that
is free. A key's hash names a slot, the slot its shard. Shards differ by a few slots at most, and when
one goes, almost only its own slots change hands. The table's size is a parameter, whatever the data,
so it is broadcast and placement costs one look-up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkindex.llm.common import quoted

#: A prime, about a thousand times the usual number of shards.
TABLE_SIZE = 65_537


def _number(name: str, salt: str, most: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big") % most


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE,
               weights: Sequence[int] | None = None) -> np.ndarray:
    """Of each slot the position of its shard. ``weights``: slots that a shard claims per turn."""
    if not is_prime(size) or size < len(shards):
        raise ValueError("the table's size must be a prime, and no less than the number of shards")
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need names of their own")
    turns = list(weights or [1] * len(shards))
    if len(turns) != len(shards) or min(turns) < 1:
        raise ValueError("each shard needs a weight of 1 or more")
    at = [_number(s, "offset", size) for s in shards]
    step = [_number(s, "step", size - 1) + 1 if size > 2 else 1 for s in shards]
    table, left = [-1] * size, size
    while left:
        for shard, claims in enumerate(turns):
            for _ in range(min(claims, left)):
                while table[at[shard]] >= 0:
                    at[shard] = (at[shard] + step[shard]) % size
                table[at[shard]] = shard
                left -= 1
    return np.array(table, dtype=np.int64)


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: its MD5's first 60 bits, modulo the table's size. A null counts as ''."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size


def place(docs: DataFrame, shards: Sequence[str], *, id_column: str = "doc_id",
          size: int = TABLE_SIZE, weights: Sequence[int] | None = None) -> DataFrame:
    """``doc_id, slot, shard`` of every row; no shuffle.

    A null id is placed as the empty text; equal ids, in repeated rows too, go to one shard; texts
    and other columns are not read; an empty table gives no rows.
    """
    names = np.asarray(list(shards), dtype=object)[fill_table(shards, size, weights)]
    table = docs.sparkSession.createDataFrame(
        list(enumerate(names.tolist())), "slot long, shard string")
    keyed = docs.select(quoted(id_column).alias("doc_id")).withColumn(
        "slot", slot_of(F.col("doc_id"), size))
    return keyed.join(F.broadcast(table), "slot").select("doc_id", "slot", "shard")
