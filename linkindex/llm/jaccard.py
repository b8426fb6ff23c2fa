"""Exact Jaccard join of word shingles by universe partition.

A set's tokens are 64-bit hashes of its shingles. Sizes fall into bands, and each band has a scheme:
the universe of hashes is cut into ``m`` equal segments. If two similar sets differ in at most ``e``
tokens and the weights of one set's segments sum to more than ``e``, then by the pigeonhole principle
they agree in one of these segments: in all its tokens (weight 1) or in all but one (weight 2). A
segment is indexed by a hash of its tokens and, in bands where weight 2 is cheaper, by the hashes of
its one-deletion neighbourhood too. A set joins the scheme of its own band and, if it can have a
smaller partner there, that of the band below.

Costs come from the data: of each set only the segments that it shares with the fewest sets are
probed, and only as many as the pigeonhole needs after those that it shares with none. Empty segments
carry no weight and have no signature. A set whose other segments weigh too little is *short*: it probes
them all, and goes on to another cut of the universe, by other hashes. What it has missed so far differs
from it in all its segments, so little of it lies elsewhere: only sets of few weighty segments (``rank``) are indexed
in the next cut too. Sets that are short in all ``CUTS`` are, at these odds, none; they probe empty segments.

Only what a set probes is compared with it, exactly, and no pairs of a group are written out. In
rounds, of the sets that probe a signature one is its pivot: all others are compared with it, and what is linked
with it is one component, whose sets never meet again. When rounds link little, the sets that probe, or those outside the
largest component if they are fewer, are compared with the signature's other sets, block against block; a block
is of sets that share a signature, and two blocks meet once, however many signatures bring them together.
Equal sets are one class from the start, and the class's members are never compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkindex.llm.common import fresh, quoted, staged
from linkindex.llm.components import components
from linkindex.llm.tokens import Cache

WIDTH = 5
#: Similarity at least PART / WHOLE, compared in whole numbers.
PART, WHOLE = 80, 100
#: Segment signatures per bucket of the index; a bucket is handled by one task in arrays.
BUCKET_ROWS = 1_000_000
#: Index entries collected by a task before they are dealt to the buckets.
FLUSH_ROWS = 500_000
#: Tokens, and sets, of a block: what is compared in one task at most, twice.
BLOCK_TOKENS, BLOCK_SETS = 500_000, 256
#: Cuts of the universe that a set may need.
CUTS = 8
#: Rounds of pivots at most; they also end when one links less than one in so many sets that it compared.
ROUNDS, GAIN = 8, 5
#: Candidates (an id and a few numbers each) up to which their table is broadcast to the texts.
BROADCAST_ROWS = 300_000

_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _MIX
    x = (x ^ (x >> _HALF)) * _MIX
    return x ^ (x >> _HALF)


class Shingler:
    """Distinct shingle hashes of whole texts, sorted."""

    def __init__(self) -> None:
        self.words = Cache(xxhash.xxh3_64_intdigest, 200_000)

    def shingles(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # of bytes: A-Z, and blank, 9 to 13 only
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        n = len(words)
        if n < WIDTH:
            joined = (hashes * _SALTS[:n]).sum(keepdims=True) + np.uint64(n)
        else:
            joined = sum(hashes[j:n - WIDTH + 1 + j] * _SALTS[j] for j in range(WIDTH))
        return np.unique(mixed(joined))


_shingler = cache(Shingler)


def shingler() -> Shingler:
    """One per Python worker."""
    _shingler().words.alone()
    return _shingler()


def most_errors(sizes: int) -> int:
    """Tokens in which two similar sets differ at most, if their sizes sum to ``sizes``."""
    return sizes * (WHOLE - PART) // (WHOLE + PART)


@dataclass(frozen=True)
class Scheme:
    """How the sets of one band are indexed."""

    number: int
    low: int  # sizes from low
    high: int  # to high
    segments: int
    deletions: bool

    def cut(self, tokens: np.ndarray, number: int) -> Cut:
        """What a set has in a cut of the universe; the first cut is by the tokens' own order."""
        if number:
            tokens = np.sort(mixed(tokens + np.uint64(int(_SALTS[1]) * number % (1 << 64))))
        salt = np.uint64(int(_SALTS[0]) * (self.number + 1 + 1000 * number) % (1 << 64))
        places = ((tokens >> _HALF) * np.uint64(self.segments)) >> _HALF
        firsts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        held = places[firsts]
        content = mixed(tokens)
        sums = np.add.reduceat(content, firsts)
        segments = np.arange(self.segments, dtype=np.uint64)
        key = mixed(segments + salt)
        if self.deletions:
            counts = np.diff(np.r_[firsts, len(tokens)])
            several = np.repeat(counts, counts) > 1  # without its only token a segment is empty
            where = np.r_[held, places[several]].astype(np.int64)
            inner = np.r_[sums, (np.repeat(sums, counts) - content)[several]]
            bare = np.r_[np.setdiff1d(segments, held), held[counts == 1]].astype(np.int64)
            weight, rank = int(np.minimum(counts, 2).sum()), len(held) + int((counts > 2).sum())
        else:
            where, inner = held.astype(np.int64), sums
            bare = np.setdiff1d(segments, held).astype(np.int64)
            weight = rank = len(held)
        return Cut(mixed(inner + key[where]), where, mixed(key[bare]), bare, weight, rank)

    def most_missed(self, size: int) -> int:
        """Tokens in which a short set that finds a set of this size here differs from it at most."""
        largest = size * WHOLE // PART
        most = most_errors(2 * min(largest, self.high))
        return max(most, most_errors(largest + self.high)) if largest > self.high else most


@dataclass(frozen=True)
class Cut:
    """Signatures and their segments; the same of empty content; weight, and rank: the least number of
    tokens in which any set differs from this one that shares none of the other's signatures here and has no
    more tokens."""

    sigs: np.ndarray
    where: np.ndarray
    bare_sigs: np.ndarray
    bare_where: np.ndarray
    weight: int
    rank: int


@cache
def schemes() -> tuple[Scheme, ...]:
    """Bands of sizes, each half as large again as the one before, and their cheaper allocation."""
    out, low = [], 1
    while low < 1 << 40:
        high = low if low < 4 else low * 3 // 2
        errors = most_errors(high + high * WHOLE // PART)
        # Signatures per set against the tokens that a signature holds: with few tokens to a segment,
        # chance agreements cost more than the signatures of larger segments and their deletions.
        exact = 1 if errors == 0 else int(np.ceil((errors + 1) * 1.1)) + 1
        deletions = errors > 0 and high / exact < 3
        segments = (errors + 2) // 2 + 1 if deletions else exact
        out.append(Scheme(len(out), low, high, segments, deletions))
        low = high + 1
    return tuple(out)


_LOWS = np.array([s.low for s in schemes()], dtype=np.int64)


def joined_schemes(size: int) -> list[tuple[Scheme, int]]:
    """The schemes that a set of this size joins, and the weight by which it finds every partner of
    at most its size there."""
    own = int(np.searchsorted(_LOWS, size, side="right")) - 1
    found = [(schemes()[own], most_errors(2 * size) + 1)]
    below = schemes()[own - 1]
    if own and size * PART <= below.high * WHOLE:
        found.append((below, most_errors(size + below.high) + 1))
    return found


_ENTRY = np.dtype([("sig", "<u4"), ("class", "<u8"), ("segment", "u1"), ("mark", "u1")])
_EMPTY, _TWO, _SHORT, _PART = 1, 2, 4, 3  # above these bits the part: 2 * cut, 1 more for the band below


def entries(tokens: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Index entries of a set with their full signatures, and per part its weight and its need, which
    is 0 where it is only found."""
    sigs, rows, needs = [], [], []
    for k, (scheme, need) in enumerate(joined_schemes(len(tokens))):
        missed, probing = scheme.most_missed(len(tokens)), True
        for c in range(CUTS):
            cut = scheme.cut(tokens, c)
            short = probing and cut.weight < need
            again = short if k else cut.rank <= missed  # in the band below sets only probe
            last = c == CUTS - 1 and again
            sig = np.r_[cut.sigs, cut.bare_sigs] if last else cut.sigs
            where = np.r_[cut.where, cut.bare_where] if last else cut.where
            row = np.empty(len(sig), _ENTRY)
            row["class"], row["segment"] = number, where & 255
            empty = np.arange(len(sig)) >= len(cut.sigs)
            row["mark"] = (empty * _EMPTY | (scheme.deletions and _TWO) | (last and short and _SHORT)
                           | (2 * c + k) << _PART)
            sigs.append(sig)
            rows.append(row)
            # with the empty segments a set has all the weight there is
            most = scheme.segments * (2 if scheme.deletions else 1)
            needs.append((2 * c + k, most if last and short else cut.weight, need if probing else 0))
            probing = short
            if not again:
                break
    return np.concatenate(sigs), np.concatenate(rows), needs


def class_of(tokens: np.ndarray) -> int:
    """The number of all sets equal to this one; 0 stands for the empty set."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) or 1


_INDEXED = ("doc_id long, text_key long, class long, size long, part int, weight long, need long,"
            " bucket int, entries binary")
_INDEXED_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("class", pa.int64()), ("size", pa.int64()),
    ("part", pa.int32()), ("weight", pa.int64()), ("need", pa.int64()), ("bucket", pa.int32()),
    ("entries", pa.binary()),
])
_REDUCED = ("kind int, doc_id long, text_key long, class long, size long, part int, weight long,"
            " need long, segment long, sig long, n long, counts boolean")
_REDUCED_ARROW = pa.schema([
    ("kind", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("class", pa.int64()),
    ("size", pa.int64()), ("part", pa.int32()), ("weight", pa.int64()), ("need", pa.int64()),
    ("segment", pa.int64()), ("sig", pa.int64()), ("n", pa.int64()), ("counts", pa.bool_()),
])
_DOCUMENT, _WEIGHT, _SHARED = 0, 1, 2


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of the given columns; the others are null."""
    n = len(next(iter(columns.values())))
    arrays = []
    for field in schema:
        value = columns.get(field.name)
        if value is None:
            arrays.append(pa.nulls(n, field.type))
        else:
            arrays.append(value if isinstance(value, pa.Array) else pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def indexed(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of three kinds, each with a bucket: documents (``doc_id, class, size``), weights of
    classes (``class, size, part, weight, need``) and index entries of many classes (``entries``)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler().shingles
        sigs, rows, needs, seen, held = [], [], [], set(), 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if rows:
                sig, row = np.concatenate(sigs), np.concatenate(rows)
                bucket = ((sig >> _HALF) * np.uint64(buckets) >> _HALF).astype(np.int32)
                row["sig"] = sig.astype(np.uint32)
                order = np.argsort(bucket, kind="stable")
                bucket, row = bucket[order], row[order]
                firsts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                parts = np.split(row, firsts[1:])
                yield _batch(_INDEXED_ARROW, bucket=bucket[firsts],
                             entries=[p.tobytes() for p in parts])
                number, size, part, weight, need = (
                    np.array(c, np.int64) for c in zip(*needs, strict=True))
                yield _batch(_INDEXED_ARROW, **{"class": number}, size=size,
                             part=part.astype(np.int32), weight=weight, need=need,
                             bucket=(number % buckets).astype(np.int32))
            sigs.clear(), rows.clear(), needs.clear(), seen.clear()
            held = 0

        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            classes, sizes = [], []
            for doc_id, text in zip(ids, batch["text"].to_pylist(), strict=True):
                tokens = shingles(text)
                number = class_of(tokens) if len(tokens) and doc_id is not None else 0
                plain = number - (1 << 64) if number >> 63 else number
                classes.append(plain)
                sizes.append(len(tokens))
                if number and number not in seen:  # copies between two flushes are indexed once
                    seen.add(number)
                    sig, row, need = entries(tokens, number)
                    sigs.append(sig)
                    rows.append(row)
                    needs += [(plain, len(tokens), *n) for n in need]
                    held += len(sig)
                    if held >= FLUSH_ROWS:
                        yield from flush()
            spread = np.array([(i or 0) % buckets for i in ids], np.int32)
            yield _batch(_INDEXED_ARROW, doc_id=ids, text_key=batch["text_key"],
                         **{"class": classes}, size=sizes, bucket=spread)
        yield from flush()

    return docs.mapInArrow(index, _INDEXED)


def reduced(index: DataFrame, buckets: int) -> DataFrame:
    """Documents and weights as they are, and of the index what more than one class shares: ``class,
    part, weight, segment, sig, n, counts``. One shuffle, of arrays instead of rows."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            entry, weight = batch["entries"].is_valid(), batch["part"].is_valid()
            for kind, mask in ((_DOCUMENT, pc.and_not(pc.invert(entry), weight)), (_WEIGHT, weight)):
                some = batch.filter(mask)
                if some.num_rows:
                    columns = {n: some[n] for n in _INDEXED_ARROW.names[:-2]}
                    yield _batch(_REDUCED_ARROW, kind=[kind] * some.num_rows, **columns)
            some = batch.filter(entry)
            for bucket, content in zip(some["bucket"].to_pylist(), some["entries"], strict=True):
                parts.setdefault(bucket, []).append(np.frombuffer(content.as_buffer(), _ENTRY).copy())
        while parts:
            bucket, some = parts.popitem()
            rows = np.concatenate(some)
            rows = rows[np.argsort(rows["sig"], kind="stable")]
            sig = rows["sig"]  # most have one row; only the others are looked at closely
            again = np.r_[False, sig[1:] == sig[:-1]]
            rows = rows[again | np.r_[again[1:], False]]
            rows = rows[np.lexsort((rows["segment"], rows["class"], rows["sig"]))]
            if not len(rows):
                continue
            sig, number = rows["sig"], rows["class"]
            # one row per signature and class: copies, and equal deletions within a set
            rows = rows[np.r_[True, (sig[1:] != sig[:-1]) | (number[1:] != number[:-1])]]
            firsts = np.flatnonzero(np.r_[True, rows["sig"][1:] != rows["sig"][:-1]])
            counts = np.diff(np.r_[firsts, len(rows)])
            # signatures of empty segments count only where a set cannot do without them
            counted = (rows["mark"] & (_EMPTY | _SHORT)) != _EMPTY
            useful = np.logical_or.reduceat(counted, firsts)
            keep = np.repeat((counts > 1) & useful, counts)
            n, rows, counted = np.repeat(counts, counts)[keep], rows[keep], counted[keep]
            if len(rows):
                yield _batch(
                    _REDUCED_ARROW, kind=np.full(len(rows), _SHARED, np.int32),
                    **{"class": rows["class"].copy().view(np.int64)},
                    part=(rows["mark"] >> _PART).astype(np.int32),
                    weight=np.where(rows["mark"] & _TWO, 2, 1).astype(np.int64),
                    segment=rows["segment"].astype(np.int64),
                    sig=(np.int64(bucket) << np.int64(32)) | rows["sig"].astype(np.int64),
                    n=n.astype(np.int64), counts=counted)

    return index.repartition(buckets, "bucket").mapInArrow(reduce, _REDUCED)


def probes(shared: DataFrame, weights: DataFrame) -> DataFrame:
    """``class, size, sig``: the cheapest shared segments of each class that the pigeonhole needs."""
    # a segment of weight 1 has one signature, which stands for it
    place = F.when(F.col("weight") == 2, F.col("segment")).otherwise(F.col("sig"))
    rows = shared.filter("counts").withColumn("_place", place)
    per_segment = rows.groupBy("class", "part", "weight", "_place").agg(F.sum("n").alias("_cost"))
    per_class = Window.partitionBy("class", "part")
    cheaper = per_class.orderBy("_cost", "_place").rowsBetween(Window.unboundedPreceding, -1)
    chosen = (
        per_segment.withColumn("_shared", F.sum("weight").over(per_class))
        .withColumn("_before", F.coalesce(F.sum("weight").over(cheaper), F.lit(0)))
        .withColumnRenamed("weight", "_weight")
        .join(weights.withColumnRenamed("weight", "_all"), ["class", "part"])
        .filter("_before < need - (_all - _shared)")
        .select("class", "part", "size", "_place")
    )
    return rows.join(chosen, ["class", "part", "_place"]).select("class", "size", "sig")


def members(chosen: DataFrame, shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """``sig, class, size, probes``: the classes of each probed signature that some probe can be linked with."""
    probed = chosen.groupBy("sig").agg(F.min("size").alias("_low"), F.max("size").alias("_high"))
    rows = (shared.select("sig", "class", F.lit(False).alias("probes"))
            .unionAll(chosen.select("sig", "class", F.lit(True)))
            .groupBy("sig", "class").agg(F.max("probes").alias("probes")))
    return (
        rows.join(probed, "sig").join(sizes, "class")
        .filter((F.col("size") * WHOLE >= F.col("_low") * PART) & (F.col("size") <= F.col("_high")))
        .select("sig", "class", "size", "probes")
    )


def labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the component of their class so far."""
    if labels is None:
        return rows.withColumn("component", F.col("class"))
    return rows.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))


def unsettled(rows: DataFrame) -> DataFrame:
    """``sig, n, largest, others, probing`` of the signatures with sets of several components, of which
    some probe: their number, the largest component, and the sets outside it."""
    each = rows.groupBy("sig", "component").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("probes"), 1)).alias("probing"))
    return each.groupBy("sig").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("_most"),
        F.sum("probing").alias("probing"), F.count(F.lit(1)).alias("_components"),
    ).filter("_components > 1 and probing > 0").select(
        "sig", "n", F.col("_most.component").alias("largest"), (F.col("n") - F.col("_most.n")).alias("others"),
        "probing")


def can_link(size: str, other: str):
    return (F.greatest(size, other) * PART <= F.least(size, other) * WHOLE)


def starred(pairs: DataFrame) -> DataFrame:
    """``task, side, class``: every ``pivot`` with its ``class``es, in blocks."""
    # staged, so that both sides of the join are dealt anew and a pivot of very many pairs can be split
    blocks = staged(pairs.groupBy("pivot").agg(_blocks().alias("blocks")))
    dealt = pairs.join(blocks, "pivot").withColumn(
        "task", F.xxhash64(F.lit("star"), "pivot", F.pmod(F.xxhash64("class"), F.col("blocks"))))
    centres = dealt.select("task", F.lit(0).alias("side"), F.col("pivot").alias("class")).distinct()
    return centres.unionAll(dealt.select("task", F.lit(1).alias("side"), "class"))


def _blocks():
    return F.greatest(F.ceil(F.sum("size") / BLOCK_TOKENS), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).cast("long")


def crossed(rows: DataFrame) -> DataFrame:
    """``task, side, class``: the ``left`` rows of each signature meet all its rows, block against block.

    A class's block is that of a signature with very many of the sets around it: the largest one
    that any set has which shares the largest one of its own.
    """
    own = staged(rows.groupBy("class").agg(F.max(F.struct("n", "sig")).alias("_own"), F.max("size").alias("size"),
                                           F.max("left").alias("left")))
    around = rows.select("sig", "class").join(own.select("class", "_own"), "class").groupBy("sig").agg(
        F.max("_own").alias("_home"))
    homes = own.withColumn("sig", F.col("_own.sig")).join(around, "sig").select(
        "class", "size", "left", F.col("_home.sig").alias("home"))
    counts = homes.groupBy("home").agg(_blocks().alias("blocks"))
    placed = staged(homes.join(counts, "home").select("class", "left", F.xxhash64(
        "home", F.pmod(F.xxhash64("class"), F.col("blocks"))).alias("block")))
    held = rows.select("sig", "class", F.col("left").alias("_left")).join(placed, "class")
    per_sig = held.groupBy("sig", "block").agg(F.max("_left").alias("left"))
    lefts = per_sig.filter("left").select("sig", F.col("block").alias("own"))
    rights = per_sig.select("sig", F.col("block").alias("other"))
    meet = staged(lefts.join(rights, "sig").select("own", "other").distinct()
                  .withColumn("task", F.xxhash64(F.lit("cross"), "own", "other")))
    left = meet.join(placed.filter("left").select("class", F.col("block").alias("own")), "own")
    right = meet.join(placed.select("class", F.col("block").alias("other")), "other")
    return (left.select("task", F.lit(0).alias("side"), "class")
            .unionAll(right.select("task", F.lit(1).alias("side"), "class")))


def linked_components(rows: DataFrame, tokens: DataFrame) -> DataFrame | None:
    """``class, component`` of the linked classes, by rounds of pivots; ``rows`` are ``members``."""
    found, labels, done = None, None, False
    rows = staged(rows.join(rows.groupBy("class").agg(F.count(F.lit(1)).alias("degree")), "class"))
    for round_ in range(ROUNDS + 1):
        now = labelled(rows, labels) if labels is None else staged(labelled(rows, labels))
        open_ = staged(unsettled(now))
        if open_.isEmpty():
            break
        now = staged(now.join(open_, "sig"))
        done = done or round_ == ROUNDS
        if done:
            left = F.when(F.col("probing") <= F.col("others"), F.col("probes")).otherwise(
                F.col("component") != F.col("largest"))
            tasks = crossed(staged(now.select("sig", "class", "size", "n", left.alias("left"))))
        else:
            # outside the largest component, if any probes there; then the set of most signatures, which is
            # in the middle of its group, so that the group's signatures have few pivots
            rank = F.struct((F.col("component") != F.col("largest")).alias("a"), F.col("degree").alias("e"),
                            F.col("size").alias("b"), (-F.col("class")).alias("c"), F.col("component").alias("d"))
            pivots = staged(now.filter("probes").groupBy("sig").agg(F.max(rank).alias("p")).select(
                "sig", (-F.col("p.c")).alias("pivot"), F.col("p.b").alias("_size"), F.col("p.d").alias("_component")))
            pairs = staged(now.join(pivots, "sig").filter(
                (F.col("class") != F.col("pivot")) & (F.col("component") != F.col("_component"))
                & can_link("size", "_size")).select("pivot", "class", "size").distinct())
            tasks, compared = starred(pairs), pairs.count()
            used = pivots.select("sig", F.col("pivot").alias("class"), F.lit(True).alias("used"))
            rows = staged(now.join(used, ["sig", "class"], "left").select(
                "sig", "class", "size", "degree", (F.col("probes") & F.col("used").isNull()).alias("probes")))
        more = staged(links(tasks, tokens))
        n = more.count()
        if n:
            found = more if found is None else found.unionAll(more)
            labels = components(found).select(F.col("node").alias("class"), "component")
        if done:
            break
        done = n * GAIN < compared
    return labels


def linked(tokens: list[np.ndarray], right: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of positions, enough to join all components: every link between ``tokens`` and ``right``
    connects two that the returned pairs connect."""
    sizes = np.array([len(t) for t in right], dtype=np.int64)
    universe, codes = np.unique(np.concatenate(right), return_inverse=True)
    owners = np.repeat(np.arange(len(right)), sizes)[np.argsort(codes, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(universe)))])
    parent = list(range(len(tokens) + len(right)))
    shift = len(tokens)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for i, own in enumerate(tokens):
        at = np.searchsorted(universe, own)
        at = at[(at < len(universe)) & (universe[np.minimum(at, len(universe) - 1)] == own)]
        if not len(at):
            continue
        begin, end = starts[at], starts[at + 1]
        lengths = end - begin
        flat = np.repeat(begin - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        common = np.bincount(owners[flat + np.arange(lengths.sum())], minlength=len(right))
        union = sizes + len(own) - common
        hits = np.flatnonzero(common * WHOLE >= union * PART)
        for j in hits.tolist():
            if common[j]:
                a, b = root(i), root(j + shift)
                if a != b:
                    parent[a] = b
                    found.append((i, j))
    return found


def token_sets(texts: DataFrame) -> DataFrame:
    """``class, tokens`` of ``class, text``. A row whose text is not of its class, because its id is not
    its own, is passed over."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler().shingles
        for batch in batches:
            tokens = [shingles(text) for text in batch["text"].to_pylist()]
            numbers = np.array([class_of(t) if len(t) else 0 for t in tokens], np.uint64)
            own = numbers.view(np.int64) == batch["class"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch["class"], pa.array([t.tobytes() for t in tokens], pa.binary())],
                names=["class", "tokens"]).filter(pa.array(own))

    return texts.select("class", "text").mapInArrow(sets, "class long, tokens binary").dropDuplicates(["class"])


def links(tasks: DataFrame, tokens: DataFrame) -> DataFrame:
    """``a, b``: links that join all components, of the classes of side 0 with those of side 1 in a task."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(group: list[tuple]) -> pa.RecordBatch:
            left = [(n, t) for side, n, t in group if side == 0]
            right = [(n, t) for side, n, t in group if side == 1]
            pairs = linked([np.frombuffer(t, np.uint64) for _, t in left],
                           [np.frombuffer(t, np.uint64) for _, t in right]) if left and right else []
            return pa.RecordBatch.from_arrays(
                [pa.array([left[i][0] for i, _ in pairs], pa.int64()),
                 pa.array([right[j][0] for _, j in pairs], pa.int64())], names=["a", "b"])

        now, group = None, []
        for batch in batches:
            columns = (batch[n].to_pylist() for n in ("task", "side", "class", "tokens"))
            for task, *row in zip(*columns, strict=True):
                if task != now and group:
                    yield found(group)
                    group = []
                now = task
                group.append(tuple(row))
        if group:
            yield found(group)

    return (tasks.join(tokens, "class").select("task", "side", "class", "tokens")
            .repartition("task").sortWithinPartitions("task").mapInArrow(compare, "a long, b long"))


def _components(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, size, component, component_id`` of every row of ``doc_id, text``;
    ``component`` is one of the component's classes."""
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # about one entry to 12 bytes of text; twice as many buckets as tasks where there are few
    buckets = max(-(-n_bytes // (12 * BUCKET_ROWS)), 2 * partitions)
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    table = staged(reduced(indexed(keyed, buckets), buckets))

    documents = table.filter(F.col("kind") == _DOCUMENT).select("doc_id", "text_key", "class", "size")
    weights = (table.filter(F.col("kind") == _WEIGHT)
               .groupBy("class", "part").agg(*(F.max(c).alias(c) for c in ("size", "weight", "need"))))
    shared = table.filter(F.col("kind") == _SHARED).select(
        "class", "part", "weight", "segment", "sig", "n", "counts")
    classes = documents.filter(F.col("class") != 0).groupBy("class").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.max("size").alias("size"))

    chosen = staged(probes(shared, weights))
    rows = staged(members(chosen, shared, classes.select("class", "size")))
    wanted = staged(rows.select("class").distinct().join(classes, "class").select("class", "first.*"))
    if wanted.count() <= BROADCAST_ROWS:  # spares the shuffle of the texts
        wanted = F.broadcast(wanted)
    tokens = staged(token_sets(keyed.join(wanted, ["doc_id", "text_key"])))
    joined = linked_components(rows, tokens)
    if joined is None:
        joined = classes.select("class", F.col("class").alias("component")).limit(0)

    roots = classes.join(joined, "class", "left").select(
        "class", "first", F.coalesce("component", "class").alias("component"))
    firsts = roots.groupBy("component").agg(F.min("first.doc_id").alias("component_id"))
    return documents.join(
        roots.join(firsts, "component").select("class", "component", "component_id"), "class", "left"
    ).select("doc_id", "text_key", "size", "component",
             F.coalesce("component_id", "doc_id").alias("component_id"))


#: From here on ids stand in for those that rows lack.
STAND_INS = 2**63 - 2**60


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Words are runs of anything but blank and the control characters 9 to 13, with A to Z lower-cased;
    a set holds the distinct shingles of five words, or the whole sequence where there are fewer. Null
    and empty texts and texts without words have the empty set, which is linked with nothing: their
    component is their own id. A null id takes no part and has no component. Repeated rows each give a
    row; an empty table gives none; other columns are not read. Rows of one id with different texts
    are sets of their own, and their components meet only by links.
    """
    narrow = docs.select(quoted(id_column).cast("long").alias("doc_id"),
                         quoted(text_column).alias("text"))
    return _components(narrow).select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def one_per_component(docs: DataFrame, *, null_ids: bool = False) -> DataFrame:
    """The row of the smallest ``doc_id`` of each component, with all columns.

    Of rows that repeat it, one stays. Rows without words all stay, and so do rows without an id;
    with ``null_ids`` the latter are in components too, after all rows with an id.
    """
    key = [fresh(docs, "key_id"), fresh(docs, "key_text")]
    number, text_key = F.col("doc_id").cast("long"), F.xxhash64("text")
    own = docs.select(number.alias("doc_id"), "text").filter("doc_id is not null")
    null_ids = null_ids and not docs.filter(number.isNull()).isEmpty()
    if null_ids:  # equal texts are one row, of an id of its own that is larger than others
        stand_in = F.lit(STAND_INS) + F.pmod(text_key, F.lit(2**63 - STAND_INS))
        own = own.unionAll(docs.filter(number.isNull()).select("text").distinct()
                           .select(stand_in.alias("doc_id"), "text"))
        number = F.coalesce(number, stand_in)
    rows = staged(_components(own).filter("size > 0"))
    keepers = rows.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("k"))
    keys = rows.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    keepers = keepers.select("k.*").join(keys, ["doc_id", "text_key"])
    losers = staged(keys.join(keepers, ["doc_id", "text_key"], "left_anti")
                    .select(F.col("doc_id").alias(key[0]), F.col("text_key").alias(key[1])))
    repeated = staged(keepers.filter((F.col("n") > 1) | (F.lit(null_ids) & (F.col("doc_id") >= STAND_INS)))
                      .select(F.col("doc_id").alias(key[0]), F.col("text_key").alias(key[1])))
    keyed = docs.withColumns({key[0]: number, key[1]: text_key})
    small = losers.count() <= BROADCAST_ROWS  # spares the shuffle of the texts
    kept = keyed.join(F.broadcast(losers) if small else losers, key, "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, key, "left_semi").dropDuplicates(key)
        kept = kept.join(repeated, key, "left_anti").unionByName(once)
    return kept.drop(*key)
