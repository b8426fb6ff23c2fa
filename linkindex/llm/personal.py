"""Personal data by bootstrapped contextual extraction.

Four kinds are recognised by their form alone: ``email``, ``ip``, ``card`` and ``phone``. They seed the
search for identifiers of unknown form. Where an identifier stands, the tokens around it are patterns: the
two and the three tokens before it, and the token on either side. Patterns and instances (identifiers
by their text, whatever rows hold it) are a graph, which is scored in rounds:

* a pattern's confidence is a lower bound (Wilson's) of the share of identifiers known so far among all
  the different things found in its place anywhere in the corpus, plain words included;
* an instance's score is the chance that not all of its trusted patterns err. From ``ACCEPT`` on it is
  taken for an identifier, and counts for its patterns in the next round.

What is accepted when no round finds more is reported wherever it stands, as kind ``context``. An instance is a
run of letters, digits and ``@ . + # / _ -`` that has three digits or more, or an ``@`` between others;
groups of digits separated by one blank are one instance.

Texts are read for identifiers and their patterns, and then to count the plain words in the place of the
patterns that several instances share. A bit set of those patterns, of a bounded size, tells a pass
which places to report; what it reports by chance finds no pattern to join. Most patterns are everyday
words: those that a share of the texts already shows to have too many plain words to be trusted, as more texts only add
to them, are left out before all texts are counted.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkindex.llm.common import quoted, staged
from linkindex.llm.tokens import Cache

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "context")
#: Different instances that a pattern needs.
SUPPORT = 3
#: Confidence from which a pattern is trusted, and score, in thousandths, from which an instance is accepted.
TRUST, ACCEPT = 0.5, 800
#: Standard deviations of the confidence's lower bound.
DEVIATIONS = 1.0
#: Rounds at most; each one accepts more, and they end when one accepts nothing.
ROUNDS = 8
#: Bits of the set of patterns, least and most: at most 32 MB are broadcast.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
#: The passes that count plain words: one text of so many, and in the end all.
PASSES = (64, 1)
#: Places that a task gathers before it reports them.
FLUSH_PLACES = 500_000

# The forms of the base kinds. Quantifiers are possessive, so that no run is read twice.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

_INSTANCE = re.compile(r"[0-9@][\w@.+#/-]*+")
_INSIDE = re.compile(r"[\w@.+#/-]*\Z")
_NUMBER = re.compile(r"[0-9.+/-]+")
_TOKEN = re.compile(r"\w+|[^\w\s]")

_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xA0761D6478BD642F],
                  dtype=np.uint64)
_MIX, _HALF = np.uint64(0xD6E8FEB86659FD93), np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _MIX
    return x ^ (x >> _HALF)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the base kinds, in order."""
    found = []
    done, at = 0, text.find("@")
    while at >= 0:  # the longest run before the sign is the leftmost start
        start = done + len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        done = domain.end() if domain else at + 1
        if domain:
            found.append((start, 0, done))
        at = text.find("@", done)
    if _DIGIT.search(text):
        for m in _DOTTED.finditer(text):
            parts = m[0].split(".")
            begin = m.start()
            for k in range(0, len(parts) - 3, 4):
                own = parts[k:k + 4]
                end = begin + sum(map(len, own)) + 3
                if all(len(x := p.lstrip("0")) < 3 or len(x) == 3 and x <= "255" for p in own):
                    found.append((begin, 1, end))
                begin = end + 1
        for m in _DIGITS.finditer(text):
            if len(m[0]) >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """``start, end, seed`` of a text's instances, in order and apart from each other. Base spans that meet
    are one seed; what meets a seed is none of its own."""
    seeds: list[list[int]] = []
    for start, _, end in base:
        if seeds and start < seeds[-1][1]:
            seeds[-1][1] = max(end, seeds[-1][1])
        else:
            seeds.append([start, end])
    others: list[list[int]] = []
    done = 0
    for m in _INSTANCE.finditer(text):
        begin = m.start()
        while begin > done and _INSIDE.match(text[begin - 1]):
            begin -= 1
        done = m.end()
        run = text[begin:done]
        begin += len(run) - len(run.lstrip("./-"))
        end = done - (len(run) - len(run.rstrip("./-+#")))
        if begin >= end:
            continue
        if (others and others[-1][1] + 1 == begin and text[begin - 1] == " "
                and _NUMBER.fullmatch(text, begin, end) and _NUMBER.fullmatch(text, *_last_group(text, others[-1]))):
            others[-1][1] = end
        else:
            others.append([begin, end])
    starts, found = [s for s, _ in seeds], [(s, e, True) for s, e in seeds]
    for begin, end in others:
        run = text[begin:end]
        if len(_DIGIT.findall(run)) < 3 and "@" not in run.strip("@"):
            continue
        after = bisect_left(starts, end)
        if not after or seeds[after - 1][1] <= begin:
            found.append((begin, end, False))
    found.sort()
    return found


def _last_group(text: str, span: list[int]) -> tuple[int, int]:
    return max(span[0], text.rfind(" ", *span) + 1), span[1]


class Contexts:
    """Tokens and the patterns around their places, as 64-bit hashes."""

    def __init__(self) -> None:
        self.chunks = Cache(lambda c: b"".join(self.hashed(t) for t in _TOKEN.findall(c)), 200_000)
        self.instance = np.frombuffer(self.hashed("\0"), np.uint64)[0]

    @staticmethod
    def hashed(token: str) -> bytes:
        return (xxhash.xxh3_64_intdigest(token) or 1).to_bytes(8, "little")

    def around(self, text: str, units: list[tuple[int, int, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the tokens, each instance being one; where the instances are; and the patterns of each
        place, 0 where the text has too few tokens."""
        parts, last = [], 0
        for start, end, _ in units:
            parts += [text[last:start], "\0"]
            last = end
        text = " ".join([*(p if p == "\0" and k % 2 else p.replace("\0", "\1") for k, p in enumerate(parts)),
                         text[last:].replace("\0", "\1")]).lower()
        tokens = np.frombuffer(b"".join(map(self.chunks.__getitem__, text.split())), np.uint64)
        n = len(tokens)
        h = np.zeros(n + 4, np.uint64)
        h[3:n + 3] = tokens
        third, second, first, after = h[:n], h[1:n + 1], h[2:n + 2], h[4:]
        pair = second * _SALTS[0] + first * _SALTS[1]
        patterns = np.stack([
            np.where(second > 0, _mixed(pair), 0),
            np.where(third > 0, _mixed(pair + third * _SALTS[2]), 0),
            np.where((first > 0) & (after > 0), _mixed(first * _SALTS[2] + after * _SALTS[3]), 0),
        ], axis=1).view(np.int64)
        return tokens.view(np.int64), np.flatnonzero(tokens == self.instance), patterns


_contexts = cache(Contexts)


def contexts() -> Contexts:
    """One per Python worker."""
    _contexts().chunks.alone()
    return _contexts()


_SPAN = "struct<start:bigint,order:int,end:bigint>"
_FOUND = (f"doc_id long, base array<{_SPAN}>, units array<struct<start:bigint,end:bigint,seed:boolean,"
          "instance:bigint,patterns:array<bigint>>>")
_FOUND_ARROW = pa.schema([
    ("doc_id", pa.int64()),
    ("base", pa.list_(pa.struct([("start", pa.int64()), ("order", pa.int32()), ("end", pa.int64())]))),
    ("units", pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("instance", pa.int64()),
        ("patterns", pa.list_(pa.int64()))]))),
])


def found_in(docs: DataFrame) -> DataFrame:
    """``row, doc_id, base, units``: spans of the base kinds, and the instances with their patterns."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = contexts().around
        for batch in batches:
            base, units = [], []
            for text in batch["text"]:
                text = text.as_py() or ""
                spans = base_spans(text)
                own = instances(text, spans)
                base.append([{"start": s, "order": k, "end": e} for s, k, e in spans])
                if own:
                    _, at, patterns = around(text, own)
                    own = [{"start": s, "end": e, "seed": seed, "patterns": [p for p in found if p],
                            "instance": xxhash.xxh3_64_intdigest(text[s:e].lower()) - (1 << 63)}
                           for (s, e, seed), found in zip(own, patterns[at].tolist(), strict=True)]
                units.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(base, _FOUND_ARROW.field("base").type),
                 pa.array(units, _FOUND_ARROW.field("units").type)], schema=_FOUND_ARROW)

    return docs.mapInArrow(read, _FOUND).withColumn("row", F.monotonically_increasing_id())


def plain_words(docs: DataFrame, wanted: Broadcast) -> DataFrame:
    """``pattern, n``: the different plain tokens in the place of each pattern whose bit is set."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around, bits = contexts().around, wanted.value
        mask = np.int64(len(bits) * 8 - 1)
        gathered, held = [], 0

        def flushed() -> pa.RecordBatch:
            pattern, token = np.concatenate([g[0] for g in gathered]), np.concatenate([g[1] for g in gathered])
            pair = _mixed(pattern.view(np.uint64) + token.view(np.uint64) * _SALTS[0])
            once = np.unique(pair, return_index=True)[1]
            return pa.RecordBatch.from_arrays([pa.array(pattern[once]), pa.array(token[once])],
                                              names=["pattern", "token"])

        for batch in batches:
            for text in batch["text"]:
                text = text.as_py()
                if not text:
                    continue
                tokens, at, patterns = around(text, instances(text, base_spans(text)))
                slot = patterns & mask
                hit = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
                hit &= patterns != 0
                hit[at] = False
                place, kind = np.nonzero(hit)
                if len(place):
                    gathered.append((patterns[place, kind], tokens[place]))
                    held += len(place)
                    if held >= FLUSH_PLACES:
                        yield flushed()
                        gathered, held = [], 0
        if gathered:
            yield flushed()

    pairs = docs.select("text").mapInArrow(read, "pattern long, token long")
    return pairs.distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


def bit_set(patterns: DataFrame) -> np.ndarray:
    """The bits of the patterns, by Spark's bitmaps: 4 KB rows, whose number ``MOST_BITS`` bounds."""
    size = LEAST_BITS
    while size < MOST_BITS and size < 16 * patterns.count():
        size *= 2
    slot = F.col("pattern").bitwiseAND(F.lit(size - 1).cast("long")) + 1
    rows = patterns.select(F.bitmap_bucket_number(slot).alias("bucket"),
                           F.bitmap_bit_position(slot).alias("bit"))
    bits = np.zeros(size // 8, np.uint8)
    for row in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        begin = (row["bucket"] - 1) * 4096
        bits[begin:begin + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)[:size // 8 - begin]
    return bits


def confidence(known: Column, all_of: Column) -> Column:
    share, z = known / all_of, DEVIATIONS**2
    spread = DEVIATIONS * F.sqrt(share * (1 - share) / all_of + z / (4 * all_of * all_of))
    return (share + z / (2 * all_of) - spread) / (1 + z / all_of)


def accepted(found: DataFrame, docs: DataFrame) -> DataFrame | None:
    """``instance`` of those that their contexts give away; None if there is none."""
    units = found.select(F.explode("units").alias("u")).select("u.*")
    edges = staged(units.select("instance", "seed", F.explode("patterns").alias("pattern"))
                   .groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    shared = staged(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") >= SUPPORT))
    if shared.isEmpty():
        return None
    patterns = shared
    for one_of in PASSES:
        sent = docs.sparkSession.sparkContext.broadcast(bit_set(patterns))
        own = docs.filter(F.pmod(F.xxhash64("text"), F.lit(one_of)) == 0)
        words = staged(plain_words(own, sent))
        sent.destroy()
        # a pattern that would not be trusted if all its instances were known is left out
        patterns = staged(
            patterns.select("pattern", "held").join(words, "pattern", "left")
            .select("pattern", "held", (F.col("held") + F.coalesce("n", F.lit(0))).alias("all"))
            .filter(confidence(F.col("held"), F.col("all")) >= TRUST))
    patterns = patterns.select("pattern", "all")
    seeds = units.filter("seed").select("instance").distinct().withColumn("known", F.lit(True))
    graph = staged(edges.drop("seed").join(patterns, "pattern").join(seeds, "instance", "left")
                   .withColumn("seed", F.coalesce("known", F.lit(False))).drop("known"))
    scores, n = None, 0
    for _ in range(ROUNDS):
        score = F.when(F.col("seed"), 1000).otherwise(0)
        known = graph.withColumn("score", score)
        if scores is not None:
            known = graph.join(scores, "instance", "left").withColumn(
                "score", F.coalesce(F.when(F.col("seed"), 1000), "found", F.lit(0)))
        trusted = (
            known.groupBy("pattern").agg(F.sum("score").alias("known"), F.max("all").alias("all"),
                                         F.count(F.when(F.col("score") > 0, 1)).alias("support"))
            .filter(F.col("support") >= SUPPORT)
            .select("pattern", confidence(F.col("known") / 1000, F.col("all")).alias("confidence"))
            .filter(F.col("confidence") >= TRUST)
        )
        chance = 1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))
        now = (graph.filter("not seed").join(trusted, "pattern").groupBy("instance")
               .agg(F.floor(1000 * F.round(chance, 6)).cast("long").alias("found"))
               .filter(F.col("found") >= ACCEPT))
        if scores is not None:  # what is accepted stays, with the best score that it had
            now = now.unionByName(scores).groupBy("instance").agg(F.max("found").alias("found"))
        now = staged(now)
        more = now.count()
        if more == n:
            break
        scores, n = now, more
    return None if scores is None else scores.select("instance")


def _listed(spans: Column) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_spans(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, found`` of every row: its spans as structs of ``start``, ``order`` (the place of the
    kind in ``KINDS``) and ``end``, sorted by start, then kind."""
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).alias("text"))
    found = staged(found_in(rows))
    instances_ = accepted(found, rows)
    if instances_ is None:
        return found.select("doc_id", F.col("base").alias("found"))
    units = found.select("row", F.explode("units").alias("u")).filter("not u.seed").select("row", "u.*")
    span = F.struct("start", F.lit(len(BASE)).cast("int").alias("order"), "end")
    added = (units.join(instances_, "instance", "left_semi").groupBy("row")
             .agg(F.collect_list(span).alias("added")))
    return found.join(added, "row", "left").select(
        "doc_id", F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>")))).alias("found"))


def scan(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context`` of every row's whole text.

    Positions are code points, ends exclusive. Null and empty texts have no spans, and the digest of the
    empty text; a null id stays null; repeated rows each give a row, and their instances count once; an
    empty table gives none; other columns are not read.
    """
    rows = with_spans(docs, id_column=id_column, text_column=text_column)

    def number(kind: str) -> Column:
        order = KINDS.index(kind)
        return F.size(F.filter("found", lambda s: s["order"] == order)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["order"] < len(BASE))
    return rows.select(
        "doc_id", *(number(k) for k in BASE), F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"), number("context"))
