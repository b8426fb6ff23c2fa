"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time.

One pass over the texts writes an inverted index in blocks of documents: per block the documents in the
order of their ids with their lengths, and the postings of every term that some item has. Numbers of
documents and terms, and the documents that hold a term, are summed over all blocks before anything is
scored. A block is then searched on its own, and each task keeps of every item the best it has met:

* an item's short lists are summed term at a time into accumulators, which from then on are one list:
  documents in order, each with its sum, bounded by the greatest sum of a window of documents;
* its long lists have a greatest weight per window too. Windows are visited in the order of documents; one
  whose bounds add up to less than the least score still needed is skipped in all lists at once. In
  the others the lists are added from the weightiest on, and the rest is skipped as soon as no
  document of the window can reach that score.

Scores are whole numbers; of equal ones the smaller id counts, so only what is strictly less is skipped.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkindex.llm.common import quoted, staged

#: Words of the items that are searched in one pass, about: their index of terms is broadcast.
SEGMENT_WORDS = 2_000_000
#: Documents of a block at most, and postings after which one ends.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 1_000_000
#: Documents of a window.
WINDOW = 64
#: A list is short if it has at most one document in so many; so many short postings stay accumulators.
SHORT = 16

# The separators, as single bytes: every byte of a longer character is at least 0x80.
_LETTERS = bytes(b for b in range(256) if b >= 0x80 or chr(b).isalnum())
_TABLE = bytes(b if b in _LETTERS else 0x20 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


class Items:
    """The items of a segment, with numbers for their terms."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        self.ids, self.queries, self.numbers = [], [], {}
        for item_id, text in rows:
            counted = Counter(terms_of(text))
            if counted:
                self.ids.append(item_id)
                own = [self.numbers.setdefault(t, len(self.numbers)) for t in counted]
                self.queries.append((np.array(own, np.int64), np.array(list(counted.values()), np.int64)))

    def held(self, text: str | None) -> tuple[int, np.ndarray]:
        """The number of a text's terms, and the items' terms among them."""
        words = terms_of(text)
        found = np.fromiter((self.numbers.get(w, -1) for w in words), np.int64, len(words))
        return len(words), found[found >= 0]


def segments(items: DataFrame) -> Iterator[Items]:
    """The items in segments of about ``SEGMENT_WORDS`` words, which alone reach the driver."""
    rows = staged(items.select(quoted("item_id").cast("long").alias("item_id"), quoted("text").alias("text"))
                  .filter("text is not null").distinct())
    words = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-words // (6 * SEGMENT_WORDS)))
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        found = Items([tuple(r) for r in rows.filter(own == k).sort("item_id", "text").collect()])
        if found.ids:
            yield found


_BLOCK = ("docs long, words long, missing long, ids binary, lengths binary, terms binary, counts binary,"
          " places binary, times binary")
_BLOCK_ARROW = pa.schema([("docs", pa.int64()), ("words", pa.int64()), ("missing", pa.int64()),
                          *((c, pa.binary()) for c in
                            ("ids", "lengths", "terms", "counts", "places", "times"))])


def _block(ids: list, lengths: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
    """One row: documents by id, those without one last, and postings by term, then document."""
    known = [k for k, i in enumerate(ids) if i is not None]
    known.sort(key=ids.__getitem__)
    order = known + [k for k, i in enumerate(ids) if i is None]
    place = np.repeat(np.arange(len(ids)), [len(held[k]) for k in order])
    term = np.concatenate([held[k] for k in order])
    pairs, times = np.unique((term << np.int64(16)) | place, return_counts=True)
    terms, counts = np.unique(pairs >> np.int64(16), return_counts=True)
    number = np.array([0 if ids[k] is None else ids[k] for k in order], np.int64)
    length = np.array([lengths[k] for k in order], np.int64)
    row = {"docs": len(ids), "words": int(length.sum()), "missing": len(ids) - len(known),
           "ids": number.tobytes(), "lengths": length.tobytes(),
           "terms": terms.astype(np.uint32).tobytes(), "counts": counts.astype(np.uint32).tobytes(),
           "places": (pairs & np.int64(0xFFFF)).astype(np.uint16).tobytes(),
           "times": times.astype(np.uint32).tobytes()}
    return pa.RecordBatch.from_pylist([row], _BLOCK_ARROW)


def index(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """Blocks of the documents that have a term, ``doc_id, text`` given."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, held, postings = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                n, found = sent.value.held(text.as_py())
                if not n:
                    continue
                ids.append(doc_id)
                lengths.append(n)
                held.append(found)
                postings += len(found)
                if len(ids) == BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield _block(ids, lengths, held)
                    ids, lengths, held, postings = [], [], [], 0
        if ids:
            yield _block(ids, lengths, held)

    return docs.mapInArrow(build, _BLOCK)


def weights(blocks: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Number of documents, number of their terms, and the weight of each of the items' terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for term, number in zip(batch["terms"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                total[np.frombuffer(term, np.uint32)] += np.frombuffer(number, np.uint32)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["term", "n"])

    sums = blocks.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    n, df = sums["docs"] or 0, np.zeros(terms, np.int64)
    counts = blocks.select("terms", "counts").mapInArrow(count, "term long, n long")
    for row in counts.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        df[row["term"]] = row["n"]
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()]
    return n, sums["words"] or 0, np.array(weight, np.int64)


class Block:
    """The postings of a block, weighed when a term is first asked for."""

    def __init__(self, row: dict, n: int, words: int, weight: np.ndarray):
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.ids, self.known = np.frombuffer(row["ids"], np.int64), row["docs"] - row["missing"]
        self.m = 25 + 75 * lengths * n // words
        self.size, self.weight = row["docs"], weight
        terms, counts = np.frombuffer(row["terms"], np.uint32), np.frombuffer(row["counts"], np.uint32)
        ends = np.cumsum(counts, dtype=np.int64)
        self.spans = dict(zip(terms.tolist(), zip((ends - counts).tolist(), ends.tolist(), strict=True),
                              strict=True))
        self.places, self.times = np.frombuffer(row["places"], np.uint16), np.frombuffer(row["times"], np.uint32)
        self.edges = np.arange(0, self.size + WINDOW, WINDOW)
        self._postings: dict[int, tuple] = {}
        self._windows: dict[int, tuple] = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, by place, and what one occurrence in an item adds to their scores."""
        if term not in self._postings:
            begin, end = self.spans[term]
            place, tf = self.places[begin:end].astype(np.int64), self.times[begin:end].astype(np.int64)
            score = self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * self.m[place]))
            self._postings[term] = place, score
        return self._postings[term]

    def bounds(self, place: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each window's postings begin, and its greatest score."""
        begins = np.searchsorted(place, self.edges)
        most = np.zeros(len(begins) - 1, np.int64)
        some = np.flatnonzero(begins[1:] > begins[:-1])
        if len(some):
            most[some] = np.maximum.reduceat(score, begins[some])
        return begins, most

    def windows(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        if term not in self._windows:
            self._windows[term] = self.bounds(*self.postings(term))
        return self._windows[term]

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents that may be among the k best, given that a score below
        ``least``, or of 0, is not."""
        held = [(self.spans[t][1] - self.spans[t][0], t, q) for t, q in zip(terms.tolist(), times.tolist(), strict=True)
                if t in self.spans and self.weight[t] > 0]
        held.sort()
        # short lists, term at a time: their sums become one list
        short, room = [], self.size // SHORT + WINDOW
        while held and held[0][0] <= room:
            n, term, q = held.pop(0)
            place, score = self.postings(term)
            short.append((place, score * q))
        sums = np.zeros(self.size, np.int64)
        for place, score in short:
            sums[place] += score
        place = np.flatnonzero(sums)
        sums = sums[place]
        least = max(least, 1)
        if len(sums) >= k:  # what the short lists give alone is a lower bound of a score
            least = max(least, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
        begins, bound = self.bounds(place, sums)
        # long lists, the weightiest first
        lists = []
        for _, term, q in held:
            begin, most = self.windows(term)
            lists.append((int(most.max()) * q, begin, most, *self.postings(term), q))
            bound = bound + most * q
        lists.sort(key=lambda x: -x[0])
        found_places, found_scores, n_found = [], [], 0
        for window in np.flatnonzero(bound >= least).tolist():
            rest = bound[window]
            if rest < least:
                continue
            at = window * WINDOW
            scores = np.zeros(WINDOW, np.int64)
            a, b = begins[window], begins[window + 1]
            highest = 0
            if b > a:
                scores[place[a:b] - at] = sums[a:b]
                highest = int(scores.max())
                rest -= highest
            for _, begin, most, own, score, q in lists:
                if highest + rest < least:
                    break
                a, b = begin[window], begin[window + 1]
                if b > a:
                    scores[own[a:b] - at] += score[a:b] * q
                    highest = int(scores.max())
                    rest -= most[window] * q
            else:
                hits = np.flatnonzero(scores >= least)
                if len(hits):
                    found_places.append(hits + at)
                    found_scores.append(scores[hits])
                    n_found += len(hits)
                    if n_found >= k:
                        every = np.concatenate(found_scores)
                        least = max(least, int(np.partition(every, n_found - k)[n_found - k]))
                        if n_found > 64 * k:
                            keep = every >= least
                            found_places, found_scores = [np.concatenate(found_places)[keep]], [every[keep]]
                            n_found = len(found_scores[0])
        if not n_found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        places, scores = np.concatenate(found_places), np.concatenate(found_scores)
        keep = scores >= least
        return places[keep], scores[keep]


class Best:
    """The k best of an item so far: by score, then id, those without an id last."""

    def __init__(self, k: int):
        self.k = k
        self.missing, self.ids, self.scores = (np.empty(0, t) for t in (bool, np.int64, np.int64))

    @property
    def least(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, missing: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        missing, ids = np.concatenate([self.missing, missing]), np.concatenate([self.ids, ids])
        scores = np.concatenate([self.scores, scores])
        order = np.lexsort((ids, missing, -scores))[:self.k]
        self.missing, self.ids, self.scores = missing[order], ids[order], scores[order]


def searched(blocks: DataFrame, sent: Broadcast, facts: Broadcast, k: int) -> DataFrame:
    """``number, item_id, doc_id, score``: the k best of each item among the blocks of each task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, best = sent.value, [Best(k) for _ in sent.value.ids]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({c: batch[c][i].as_py() for c in batch.schema.names}, *facts.value)
                for (terms, times), own in zip(items.queries, best, strict=True):
                    places, scores = block.search(terms, times, k, own.least)
                    if len(places):
                        own.add(places >= block.known, block.ids[places], scores)
        rows = [(n, items.ids[n], None if m else i, s) for n, own in enumerate(best)
                for m, i, s in zip(own.missing.tolist(), own.ids.tolist(), own.scores.tolist(), strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                names=["number", "item_id", "doc_id", "score"])

    return blocks.mapInArrow(search, "number long, item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, *, k: int = 10, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item with a score above 0.

    Terms are runs of ASCII letters and digits and of all characters from U+0080 on, A to Z lower-cased. Null
    and empty texts have none; such documents are in no count, such items have no rows. Equal scores go
    by ascending id, rows without an id last; a row that repeats an id is a document of its own. Items of
    equal id and text are one, an id with several texts is ranked once for each of them, a null id is an
    id. Without items or documents there are no rows; other columns are not read.
    """
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).alias("text"))
    context, found = rows.sparkSession.sparkContext, []
    for segment in segments(items):
        sent = context.broadcast(segment)
        blocks = staged(index(rows, sent))
        facts = context.broadcast(weights(blocks, len(segment.numbers)))
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found.append(staged(
            searched(blocks, sent, facts, k).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")))
        sent.destroy()
        facts.destroy()
    if not found:
        return rows.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, found)
