"""The prefix trie of conversations, by adaptive radix trees.

A turn's id has a fixed width: four bytes for the number of words of its text, then the 16 bytes of an
MD5 of its role and text, big-endian. A conversation's key is its turns' ids, one after the other, so
byte order is turn order and a trie node is a byte depth that is a multiple of the width.

Conversations of equal keys are one key before the trie is built, whatever their number. The keys are
dealt by ranges of their order, so that a beginning which many of them share is spread over many tasks. Each
task builds a radix tree of its range and emits a row for every turn-aligned depth of it, also for those
within a compressed path. Only nodes that hold keys of neighbouring ranges come out in parts, and every
number of a node is a sum or minimum over its parts: what counts a node once, as its parent's child or
as the turn that is kept, counts it in the first range that has it.

Of a conversation only the ids are gathered in a row, 20 bytes a turn; texts stay where they were read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkindex.llm.common import quoted, staged
from linkindex.llm.radix import Node4, Tree, common

#: Bytes of a turn's id, of which the first COUNT are the number of words.
WIDTH, COUNT = 20, 4
#: Distinct keys of a range at most, about: what a task holds as a tree.
RANGE_KEYS = 50_000
#: Characters of the chunks in which the members of a key are digested.
CHUNK = 1 << 20
#: Turns of a conversation that its base may lend.
SHARED, GROUP = 4, 20

_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """The hexadecimal id of a turn."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.concat(F.lpad(F.hex(words), 2 * COUNT, "0"), F.upper(digest))


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, key`` of every conversation after its beginning is exchanged for its base's."""
    empty = F.lit("")
    rows = turns.select(
        quoted("conv_id").cast("long").alias("conv_id"), quoted("turn").alias("turn"),
        F.coalesce(quoted("role").cast("string"), empty).alias("role"),
        F.coalesce(quoted("text").cast("string"), empty).alias("text"),
    ).filter("conv_id is not null")
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", turn_id(F.col("role"), F.col("text")).alias("id")))).alias("turns"))
    own = staged(ordered.select("conv_id", F.col("turns.id").alias("ids")))
    heads = own.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, SHARED - 1).alias("head"))
    lent = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    none = F.array().cast("array<string>")
    joined = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % GROUP, "h": lent.cast("int")}
                             ).join(heads, "base", "left")
    ids = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                   F.slice("ids", F.col("h") + 1, F.size("ids")))
    return joined.select("conv_id", F.unhex(F.array_join(ids, "")).alias("key"))


def members(convs: DataFrame, tasks: int) -> DataFrame:
    """``kid, n, first, ends`` of the distinct keys: number and least of their conversations, and the
    digest of all their ids.

    Ids are sorted by key and number over all tasks and joined into chunks there, so what reaches the task
    that digests a key, in order, is a text for each chunk and not a row for each conversation.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple]) -> pa.RecordBatch:
            kid, n, first, text = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(kid, pa.binary()), pa.array(n, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(text, pa.string())], names=["kid", "n", "first", "chunk"])

        now, ids, length, done = None, [], 0, []
        for batch in batches:
            for kid, conv_id in zip(batch["kid"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if ids and (kid != now or length >= CHUNK):
                    done.append((now, len(ids), int(ids[0]), ",".join(ids)))
                    ids, length = [], 0
                now = kid
                ids.append(str(conv_id))
                length += len(ids[-1]) + 1
            if sum(len(c[3]) for c in done) >= CHUNK:
                yield out(done)
                done = []
        if ids:
            done.append((now, len(ids), int(ids[0]), ",".join(ids)))
        if done:
            yield out(done)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, first, sha = None, 0, 0, None

        def out(found: list[tuple]) -> pa.RecordBatch:
            kid, n, first, ends = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(kid, pa.binary()), pa.array(n, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(ends, pa.string())], names=["kid", "n", "first", "ends"])

        for batch in batches:
            done = []
            for kid, count, least, chunk in zip(*(batch[c].to_pylist() for c in batch.schema.names),
                                                strict=True):
                if kid != now:
                    if sha is not None:
                        done.append((now, n, first, sha.hexdigest()))
                    now, n, first, sha = kid, 0, least, hashlib.sha256()
                elif n:
                    sha.update(b",")
                sha.update(chunk.encode())
                n += count
            if done:
                yield out(done)
        if sha is not None:
            yield out([(now, n, first, sha.hexdigest())])

    joined = (convs.select(F.md5("key").alias("kid"), "conv_id")
              .withColumn("kid", F.unhex("kid"))
              .repartitionByRange(tasks, "kid", "conv_id").sortWithinPartitions("kid", "conv_id")
              .mapInArrow(chunks, "kid binary, n long, first long, chunk string"))
    return (joined.repartition("kid").sortWithinPartitions("kid", "first")
            .mapInArrow(digests, "kid binary, n long, first long, ends string"))


def ranged(convs: DataFrame) -> DataFrame:
    """``range, key, n, first, ends`` of the distinct keys, and ``before, after``: the turns that the
    range shares with its neighbours, -1 at the ends."""
    spark = convs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = convs.select(F.unhex(F.md5("key")).alias("kid"), "key").groupBy("kid").agg(F.first("key").alias("key"))
    each = staged(keys.join(members(convs, tasks), "kid").drop("kid"))
    ranges = max(tasks, -(-each.count() // RANGE_KEYS))
    each = staged(each.repartitionByRange(ranges, "key").select(F.spark_partition_id().alias("range"), "*"))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = [-1 if b is None else common(a, b) // WIDTH
                     for a, b in zip(batch["last"].to_pylist(), batch["next"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["range"], pa.array(turns, pa.int32())],
                                             names=["range", "after"])

    order = Window.orderBy("range")  # a row a range: few, whatever the number of keys
    bounds = (each.groupBy("range").agg(F.min("key").alias("least"), F.max("key").alias("last"))
              .withColumn("next", F.lead("least").over(order)).select("range", "last", "next")
              .mapInArrow(shared, "range int, after int")
              .withColumn("before", F.coalesce(F.lag("after").over(order), F.lit(-1))))
    return each.join(staged(bounds), "range")


_NODES = ("node binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long,"
          " n_children long, n_leaves long, saved_tokens long, ends string")
_NODES_ARROW = pa.schema([
    ("node", pa.binary()), ("above", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()),
])


class _Place:
    """A radix node and where it stands; after ``counted`` also what lies below it."""

    __slots__ = ("node", "low", "high", "key", "first_path", "last_path", "above", "n", "first",
                 "kids", "leaves", "saved", "levels", "branches")

    def __init__(self, node: Node4, low: int, first_path: bool, last_path: bool, above):
        self.node, self.low, self.above = node, low, above  # its edge holds the depths from low
        self.first_path, self.last_path = first_path, last_path  # holds the range's first, last key
        self.high, self.branches = 0, 0
        self.key = None
        self.n, self.first, self.kids, self.leaves, self.saved, self.levels = 0, None, 0, 0, 0, []


def nodes_of(tree: Tree, before: int, after: int) -> Iterator[tuple]:
    """Rows of ``_NODES`` for the turn-aligned depths of a tree whose values are ``key, n, first, ends``.

    Depths up to ``before`` of the first key's path, and up to ``after`` of the last one's, are parts of
    nodes that other ranges hold too.
    """
    places = [_Place(tree.root, 0, True, True, None)]
    for place in places:  # grows while it is read: from the root down
        node = place.node
        place.high = place.low + len(node.prefix)
        below = list(node.items())
        place.branches = len(below)
        for k, child in enumerate(below):
            places.append(_Place(child, place.high + 1, place.first_path and node.value is None and k == 0,
                                 place.last_path and k == len(below) - 1, place))
    for place in reversed(places):
        value = place.node.value
        if value is not None:
            key, n, first, _ = value
            place.n += n
            place.first = first if place.first is None else min(first, place.first)
            place.key = key
        kids, leaves, saved = place.kids, place.leaves, place.saved
        # the turn-aligned depths of the edge, from below
        for depth in range(place.high // WIDTH, -(-place.low // WIDTH) - 1, -1):
            ends = depth * WIDTH == place.high and not place.branches
            if ends and not (place.last_path and depth <= after):  # else the next range has what follows
                leaves = 1
            at = (depth - 1) * WIDTH
            words = int.from_bytes(place.key[at:at + COUNT]) if depth else 0
            own = not (place.first_path and depth <= before)  # the first range that has this node
            saved += (place.n - own) * words
            place.levels.append((depth, kids, leaves, saved))
            kids = int(own)
        up = place.above
        if up is not None:
            up.n += place.n
            up.first = place.first if up.first is None else min(up.first, place.first)
            up.key = place.key
            up.kids, up.leaves, up.saved = up.kids + kids, up.leaves + leaves, up.saved + saved

    # parts of shared nodes are known by a digest of the path
    def digests(key: bytes, depth: int) -> list[bytes]:
        path, out = hashlib.sha256(), []
        for d in range(depth + 1):
            out.append(path.digest())
            path.update(key[d * WIDTH:(d + 1) * WIDTH])
        return out

    least, most = _least(tree), _most(tree)
    left, right = digests(least, before), digests(most, after)
    above: dict[int, tuple[bytes | None, int | None]] = {}  # of a place: its lowest turn-aligned node
    for place in places:
        digest, parent = (None, None) if place.above is None else above[id(place.above)]
        for depth, kids, leaves, saved in reversed(place.levels):
            node = None
            if place.first_path and depth <= before:
                node = left[depth]
            elif place.last_path and depth <= after:
                node = right[depth]
            ends = None
            if place.node.value is not None and depth * WIDTH == place.high:
                ends = place.node.value[3]
            yield (node, digest, place.first, depth, None if digest is not None else parent, place.n, kids,
                   leaves, saved, ends)
            digest, parent = node, place.first
        above[id(place)] = (digest, parent)


def _least(tree: Tree) -> bytes:
    node = tree.root
    while node.value is None:
        node = next(iter(node.items()))
    return node.value[0]


def _most(tree: Tree) -> bytes:
    node = tree.root
    while below := list(node.items()):
        node = below[-1]
    return node.value[0]


def parts(keys: DataFrame) -> DataFrame:
    """Rows of ``_NODES``: whole nodes, and parts (with ``node``) of those of several ranges."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitted(tree: Tree, before: int, after: int) -> Iterator[pa.RecordBatch]:
            rows = []
            for row in nodes_of(tree, before, after):
                rows.append(row)
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_pylist([dict(zip(_NODES_ARROW.names, r, strict=True))
                                                      for r in rows], _NODES_ARROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(_NODES_ARROW.names, r, strict=True))
                                                  for r in rows], _NODES_ARROW)

        now, tree, bounds = None, Tree(), (-1, -1)
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("range", "key", "n", "first", "ends", "before", "after"))
            for number, key, n, first, ends, before, after in zip(*columns, strict=True):
                if number != now:
                    if now is not None:
                        yield from emitted(tree, *bounds)
                    now, tree, bounds = number, Tree(), (before, after)
                tree[key] = (key, n, first, ends)
        if now is not None:
            yield from emitted(tree, *bounds)

    return (keys.select("range", "key", "n", "first", "ends", "before", "after")
            .repartition("range").sortWithinPartitions("range").mapInArrow(build, _NODES))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``turns`` has ``conv_id, turn, role, text``. Turns go by ``turn``, null first; of an equal turn by
    role, number of words and digest of the text; null roles and texts are empty; repeated rows are turns of their own. Rows
    without a conv_id belong to no conversation and are left out. An empty table has no node, not even
    a root; other columns are not read.
    """
    found = staged(parts(ranged(staged(rebuilt(turns)))))
    numbers = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               "ends"]
    merged = staged(found.filter("node is not null").groupBy("node").agg(
        F.max("above").alias("above"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("parent_conv_id").alias("parent_conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends").alias("ends")))
    whole = found.filter("node is null").drop("node").unionByName(merged.drop("node"))
    parents = merged.select(F.col("node").alias("above"), F.col("conv_id").alias("found_parent"))
    below = (whole.filter("above is not null").join(parents, "above")
             .withColumn("parent_conv_id", F.col("found_parent")).select(numbers))
    nodes = whole.filter("above is null").select(numbers).unionByName(below)
    return nodes.select(*numbers[:-1], F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"))
