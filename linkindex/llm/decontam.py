"""Benchmark decontamination: a BM25 index of test items, searched by block-max WAND.

Items are cut into parts of at most ``PART_WORDS`` words, and the parts indexed by term, with impacts
divided by what the part scores for its own text: a passage that holds all of a part scores 1. A
posting list is in blocks of ``POSTING_BLOCK`` parts, each with its largest impact.

Every document is cut into overlapping passages so wide that any part lies within one of them. Every
passage is a query, and all parts that score above ``THRESHOLD`` are retrieved. A part's lesser terms
together weigh little of the threshold, so a passage reaches it only with enough of its weightier
ones; passages that reach no part so are passed over, in arrays, and the others go through block-max
WAND with all their terms. What is retrieved is verified: of the item's question and of its answer, the last sentence, the share
of five-word shingles that the document holds.

An altered item whose sentences stand far apart may reach the threshold in no passage. So of every text
a few shingles are looked up too, one more than verification lets a document lack: a document that
holds none of them cannot pass. Texts shorter than a shingle lie in one passage, or half of them does.

The index is a fixed multiple of the benchmark's text. It is built in segments of at most
``SEGMENT_WORDS`` words of items, each in a Spark task, and written to the shared folder. A segment is
broadcast, searched by a pass over the documents and its result staged before the next one, so the
driver and the workers never hold more than one segment, however many items there are.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkindex.llm.common import fresh, quoted, staged

K1, B = 1.2, 0.75
PART_WORDS = 128
POSTING_BLOCK = 16
#: Least score of a passage, as a share of the part's score for its own text.
THRESHOLD = 0.5
#: A part's least terms that weigh less than this share of the threshold together are its lesser ones.
LESSER = 0.1
#: Words of a shingle, and the least share of them that a contaminated document holds.
WIDTH, OVERLAP = 5, 0.8
SEGMENT_WORDS = 2_000_000

#: Multipliers of a shingle's hash.
_MIX, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles_of(words: list[str]) -> set[tuple[str, ...]]:
    if len(words) <= WIDTH:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(WIDTH)), strict=False))


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """The words of all sentences but the last, and of the last; both are the whole if it has one."""
    sentences = [s for s in _SENTENCE.split((text or "").strip()) if words_of(s)]
    if len(sentences) < 2:
        return words_of(text), words_of(text)
    return words_of(" ".join(sentences[:-1])), words_of(sentences[-1])


def hashes_of(ids: np.ndarray) -> np.ndarray:
    """A hash of every run of ``WIDTH`` word numbers."""
    ids = ids.astype(np.uint64)
    n = max(len(ids) - WIDTH + 1, 0)
    out = ids[:n]
    for k in range(1, WIDTH):
        out = out * _MIX + ids[k:k + n]
    return (out ^ (out >> np.uint64(32))) * _LAST


@dataclass
class Postings:
    """Parts of one term: their numbers, impacts, and the last part and largest impact per block."""

    parts: np.ndarray
    impacts: np.ndarray
    most: float = 0.0
    lasts: list[int] = field(default_factory=list)
    tops: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.most = float(self.impacts.max())
        for at in range(0, len(self.parts), POSTING_BLOCK):
            self.lasts.append(int(self.parts[at:at + POSTING_BLOCK][-1]))
            self.tops.append(float(self.impacts[at:at + POSTING_BLOCK].max()))


class Index:
    """A segment of items."""

    def __init__(self, items: list[tuple[int, str]], documents: Counter, n_items: int, mean: float):
        #: Of each text its item and the shingles of the whole, the question and the answer.
        self.texts: list[tuple] = []
        self.owner: list[int] = []  # the text of each part; an id may have several texts
        counts: list[Counter] = []
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            question, answer = question_and_answer(text)
            for at in range(0, len(words), PART_WORDS):
                self.owner.append(len(self.texts))
                counts.append(Counter(words[at:at + PART_WORDS]))
            self.texts.append((item_id, shingles_of(words), shingles_of(question), shingles_of(answer)))
        postings: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
        for part, terms in enumerate(counts):
            length = sum(terms.values())
            raw = {}
            for term, n in terms.items():
                idf = math.log(1 + (n_items - documents[term] + 0.5) / (documents[term] + 0.5))
                raw[term] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * length / mean))
            own = sum(raw.values())
            for term, impact in raw.items():
                postings[term][0].append(part)
                postings[term][1].append(impact / own)
        self.terms = {t: k for k, t in enumerate(postings)}
        self.postings = [Postings(np.array(p), np.array(x)) for p, x in postings.values()]
        self.stride = max((sum(c.values()) for c in counts), default=1)
        self._weightier(len(counts))
        self._probed(documents)

    def _weightier(self, n_parts: int) -> None:
        """Per term, the parts of which it is one of the weightier terms; per part, what the passage
        must have of those to score the threshold."""
        terms = np.repeat(np.arange(len(self.postings)), [len(p.parts) for p in self.postings])
        parts = np.concatenate([p.parts for p in self.postings])
        impacts = np.concatenate([p.impacts for p in self.postings])
        order = np.lexsort((terms, impacts, parts))  # per part, the least impact first
        terms, parts, impacts = terms[order], parts[order], impacts[order]
        sums = np.cumsum(impacts)
        firsts = np.searchsorted(parts, np.arange(n_parts))
        sums -= (sums[firsts] - impacts[firsts])[parts]
        lesser = sums < LESSER * THRESHOLD
        rest = np.bincount(parts[lesser], impacts[lesser], minlength=n_parts)
        self.needed = THRESHOLD - rest - 1e-9
        order = np.argsort(terms[~lesser], kind="stable")
        self.parts, self.impacts = parts[~lesser][order], impacts[~lesser][order]
        counts = np.bincount(terms[~lesser], minlength=len(self.postings) + 1)
        self.begins = np.concatenate([[0], np.cumsum(counts)])  # the last term: no postings

    def _probed(self, documents: Counter) -> None:
        """The shingles that are looked up, by hash, with the texts they are of: so many of a set that
        a document without any of them holds less than ``OVERLAP`` of it, the rarest first."""
        seen = Counter(s for _, whole, *_ in self.texts for s in whole)
        rows = []
        for number, (_, whole, *halves) in enumerate(self.texts):
            # the whole, or both halves, are held; a set of a text shorter than a shingle has no probe
            halves = [h for h in halves if len(next(iter(h))) == WIDTH]
            for wanted in [whole, *sorted(halves, key=len)[:1]]:
                if len(next(iter(wanted))) == WIDTH:
                    n = len(wanted) - math.ceil(OVERLAP * len(wanted) - 1e-9) + 1
                    rarest = sorted(wanted, key=lambda s: (seen[s], min(documents[w] for w in s), s))
                    rows += [([self.terms[w] for w in s], number) for s in rarest[:n]]
        ids = np.array([r[0] for r in rows], dtype=np.int64).reshape(-1)
        probes = np.unique(np.stack([hashes_of(ids)[::WIDTH], np.array([r[1] for r in rows], np.uint64)]),
                           axis=1)
        self.probes, firsts = np.unique(probes[0], return_index=True)
        self.probe_texts = np.split(probes[1].astype(np.int64), firsts[1:])
        bits = max(16, (8 * len(self.probes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, dtype=bool)
        self.slots[self.probes >> self.shift] = True

    def above(self, terms: list[int], threshold: float) -> list[int]:
        """All parts that score above the threshold for these distinct terms, by block-max WAND."""
        cursors = [[self.postings[t], 0] for t in terms]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0].parts[c[1]])
            bound, pivot = 0.0, -1
            for k, (p, _) in enumerate(cursors):
                bound += p.most
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                break
            part = int(cursors[pivot][0].parts[cursors[pivot][1]])
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0].parts[cursors[pivot + 1][1]] == part:
                pivot += 1
            block_bound, block_end = 0.0, None
            for p, at in cursors[:pivot + 1]:
                block = at // POSTING_BLOCK
                while p.lasts[block] < part and block + 1 < len(p.lasts):
                    block += 1
                if p.lasts[block] >= part:
                    block_bound += p.tops[block]
                    end = p.lasts[block]
                    block_end = end if block_end is None else min(block_end, end)
            if block_bound < threshold:
                # no part up to the blocks' end can reach it; nor can any before the next cursor
                target = (part if block_end is None else block_end) + 1
                if pivot + 1 < len(cursors):
                    target = min(target, int(cursors[pivot + 1][0].parts[cursors[pivot + 1][1]]))
                target = max(target, part + 1)
            elif int(cursors[0][0].parts[cursors[0][1]]) == part:
                score = sum(float(p.impacts[at]) for p, at in cursors[:pivot + 1])
                if score >= threshold:
                    found.append(part)
                target = part + 1
            else:
                target = part
            for cursor in cursors[:pivot + 1]:
                if cursor[0].parts[cursor[1]] < target:
                    cursor[1] += int(np.searchsorted(cursor[0].parts[cursor[1]:], target))
            cursors = [c for c in cursors if c[1] < len(c[0].parts)]
        return found

    def passages(self, ids: np.ndarray) -> np.ndarray:
        """The passages of a document that may retrieve a part."""
        # a passage is two strides wide, so a word is in that of its stride and in the one before
        held = np.flatnonzero(self.begins[ids + 1] > self.begins[ids])
        place, width = held // self.stride, len(self.begins)
        own = np.unique(np.concatenate([place, place[place > 0] - 1]) * width
                        + np.concatenate([ids[held], ids[held[place > 0]]]))
        place, ids = own // width, own % width
        begin, count = self.begins[ids], self.begins[ids + 1] - self.begins[ids]
        ends = np.cumsum(count)
        if not len(ends):
            return ends
        entry = np.repeat(begin - ends + count, count) + np.arange(ends[-1])
        n = len(self.needed)
        key = np.repeat(place, count) * n + self.parts[entry]
        size = (int(place[-1]) + 1) * n
        if size <= 1 << 18:
            sums = np.bincount(key, self.impacts[entry], minlength=size)
            hits = np.flatnonzero(sums >= np.tile(self.needed, size // n))
        else:
            keys, at = np.unique(key, return_inverse=True)
            hits = keys[np.bincount(at, self.impacts[entry]) >= self.needed[keys % n]]
        return np.unique(hits // n)

    def retrieved(self, words: list[str]) -> set[int]:
        """The texts of which a part scores above the threshold for some passage or a probe is held."""
        none = len(self.postings)
        ids = np.array(list(map(self.terms.get, words, repeat(none))), dtype=np.int64)
        texts: set[int] = set()
        hashes = hashes_of(ids)
        hashes = hashes[self.slots[hashes >> self.shift]]
        if len(hashes):
            at = np.minimum(np.searchsorted(self.probes, hashes), len(self.probes) - 1)
            at = at[self.probes[at] == hashes]
            texts.update(*(self.probe_texts[k].tolist() for k in np.unique(at).tolist()))
        for k in self.passages(ids).tolist():
            terms = np.unique(ids[k * self.stride:(k + 2) * self.stride])
            texts |= {self.owner[p] for p in self.above(terms[terms < none].tolist(), THRESHOLD - 1e-9)}
        return texts

    def leaks(self, text: str | None) -> list[dict]:
        """The items that the text holds, with the shares of question and answer; of an item with
        several texts that are held, the shares of the one that is held most."""
        words = words_of(text)
        if not words:
            return []
        texts = self.retrieved(words)
        if not texts:
            return []
        held = shingles_of(words)
        line = None
        most: dict[int, tuple] = {}
        for number in texts:
            item_id, *sets = self.texts[number]
            shares = []
            for wanted in sets:
                if len(next(iter(wanted))) < WIDTH:  # shorter than a shingle: as a run of words
                    line = line or f" {' '.join(words)} "
                    shares.append(float(f" {' '.join(next(iter(wanted)))} " in line))
                else:
                    shares.append(len(wanted & held) / len(wanted))
            whole, question, answer = shares
            if whole >= OVERLAP or (question >= OVERLAP and answer >= OVERLAP):
                most[item_id] = max(most.get(item_id, ()), tuple(shares))
        return [{"item_id": item_id, "overlap": whole, "question_overlap": question, "answer_overlap": answer}
                for item_id, (whole, question, answer) in sorted(most.items())]


_SHARES = ("overlap", "question_overlap", "answer_overlap")
_LEAKS = f"array<struct<item_id:bigint,{','.join(f'{c}:double' for c in _SHARES)}>>"


class Packed:
    """An index as bytes, opened where it is first used."""

    def __init__(self, data: bytes):
        self._data, self._index = data, None

    def index(self) -> Index:
        if self._index is None:
            self._index, self._data = pickle.loads(self._data), None
        return self._index


def built(benchmark: DataFrame, segment_words: int) -> DataFrame | None:
    """``segment, index``: the pickled indexes of the items, of at most about ``segment_words`` words each.

    Statistics are those of the whole benchmark; a task gets its segment's texts and its own terms'
    frequencies. Items without an id or a word are left out; of an id that repeats all texts are items.
    """
    items = staged(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
                   .dropna().distinct()
                   .withColumn("n", F.size(F.split(F.trim("text"), r"\s+")).cast("long")))
    total = items.agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("words")).first()
    n_items, n_words = total["items"], total["words"]
    if not n_items:
        return None
    mean = min(PART_WORDS, max(1.0, n_words / n_items))
    segment = F.pmod(F.xxhash64("item_id", "text"), F.lit(-(-n_words // segment_words)))
    dealt = items.select(segment.alias("segment"), "item_id", "text")
    terms = dealt.select("segment", F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), F.lit(0)))).alias("term"))
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counted = terms.distinct().join(counts, "term")

    def build(key: tuple, texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rows = [r for r in zip(texts["item_id"].tolist(), texts["text"], strict=True) if words_of(r[1])]
        frequencies = Counter(dict(zip(found["term"], found["n"].tolist(), strict=True)))
        data = [pickle.dumps(Index(rows, frequencies, n_items, mean), 5)] if rows else []
        return pd.DataFrame({"segment": [key[0]] * len(data), "index": data})

    return staged(dealt.withColumnRenamed("segment", "own").groupBy("own").cogroup(counted.groupBy("segment"))
                  .applyInPandas(build, "segment long, index binary"))


def segments(benchmark: DataFrame, segment_words: int | None = None) -> Iterator[tuple[Broadcast, bool]]:
    """The broadcast index of each segment, and whether it is the only one.

    One of several is destroyed when the next one is asked for, so what was found must be staged by then.
    """
    indexes = built(benchmark, segment_words or SEGMENT_WORDS)
    if indexes is None:
        return
    numbers = sorted(r["segment"] for r in indexes.select("segment").collect())
    for k in numbers:
        packed = Packed(bytes(indexes.filter(F.col("segment") == k).select("index").first()[0]))
        sent = benchmark.sparkSession.sparkContext.broadcast(packed)
        del packed
        yield sent, len(numbers) == 1
        if len(numbers) > 1:
            sent.destroy(blocking=True)


def with_leaks(docs: DataFrame, sent: Broadcast, out: str, *, text_column: str = "text") -> DataFrame:
    """``docs`` with the leaked items of one segment in the column ``out``; no shuffle."""

    @F.pandas_udf(_LEAKS)
    def leaks(texts: pd.Series) -> pd.Series:
        return texts.map(sent.value.index().leaks, na_action=None)

    return docs.withColumn(out, leaks(F.coalesce(quoted(text_column), F.lit(""))))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """``doc_id, item_id, overlap, question_overlap, answer_overlap``: the items that documents hold.

    Null and empty texts hold nothing; a null id stays null; repeated rows each give their rows; an
    empty benchmark or table gives none; other columns are not read. An item of several texts gives one
    row, that of the text held most, also if its texts are in different segments.
    """
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).alias("text"))
    columns = ["doc_id", "item_id", *_SHARES]
    found = []
    for sent, only in segments(benchmark):
        leaks = (with_leaks(rows, sent, "leaks")
                 .select("doc_id", F.xxhash64("text").alias("text_key"), F.explode("leaks").alias("leak"))
                 .select("doc_id", "text_key", "leak.*", F.lit(len(found)).alias("segment")))
        if only:
            return leaks.select(columns)
        found.append(staged(leaks))
    if not found:
        return rows.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, overlap double, question_overlap double, answer_overlap double")
    leaks = reduce(DataFrame.unionAll, found)
    key = ["doc_id", "text_key", "item_id"]
    best = leaks.groupBy(key).agg(F.max(F.struct(*_SHARES, "segment")).alias("best"))
    best = best.select(*(F.col(c).alias(f"_{c}") for c in key), F.col("best.segment").alias("_segment"))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*key, "segment"]))
    return leaks.join(best, same, "left_semi").select(columns)


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; items need no id. Of several
    segments each stages the digests of the texts that hold one of its items, not the documents."""
    benchmark = benchmark.select(F.lit(0).alias("item_id"), "text")
    leaks, key = fresh(docs, "leaks"), fresh(docs, "text_key")
    digest = F.sha2(quoted(text_column).cast("binary"), 256)
    found = []
    for sent, only in segments(benchmark):
        if only:
            return (with_leaks(docs, sent, leaks, text_column=text_column)
                    .filter(F.size(leaks) == 0).drop(leaks))
        texts = docs.select(digest.alias(key), quoted(text_column).alias("text"))
        found.append(staged(with_leaks(texts, sent, "leaks").filter(F.size("leaks") > 0)
                            .select(key).distinct()))
    if not found:
        return docs
    return docs.withColumn(key, digest).join(reduce(DataFrame.unionAll, found), key, "left_anti").drop(key)
