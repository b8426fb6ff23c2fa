"""Token counts by the whole-token shortcut.

Which vocabulary strings encode alone as one token is proved once, on the driver, by encoding each of
them; the set has at most as many strings as the vocabulary, and is broadcast. A pre-token found in it
counts one without merging; only the rest is merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkindex.llm.common import quoted
from linkindex.llm.tokens import Cache, Vocabulary


class Counter:
    """Counts the tokens of texts."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.vocabulary, self.whole = Vocabulary(path), whole
        self.cache = Cache(self.chunk_count)

    def chunk_count(self, chunk: str) -> int:
        pieces = self.vocabulary.pieces(chunk)
        if pieces is None:
            return len(self.vocabulary.library_ids(chunk))
        return sum(1 if p in self.whole else len(self.vocabulary.merged(p)) for p in pieces)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        chunks = self.vocabulary.chunks(text)
        if chunks is None:
            return len(self.vocabulary.library_ids(text))
        return sum(map(self.cache.__getitem__, chunks))


_counters: dict[str, Counter] = {}


@cache
def proved_whole_tokens(path: str) -> frozenset[str]:
    """The offline proof, once per driver and vocabulary file."""
    return Vocabulary(path).whole_tokens


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, *, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row's whole text.

    ``vocabulary`` is a file of the tokenizers library, at the same place on every machine. Null and
    empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows each give a row; an
    empty table gives none; other columns are not read. Special strings inside texts count as the
    library's default takes them: as their one special token.
    """
    whole = docs.sparkSession.sparkContext.broadcast(proved_whole_tokens(vocabulary))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _counters:
            _counters[vocabulary] = Counter(vocabulary, whole.value)
        _counters[vocabulary].cache.alone()
        count = _counters[vocabulary].count
        for batch in batches:
            counts = [count(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_bytes"], pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    narrow = docs.select(
        quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).alias("text"),
        F.coalesce(F.octet_length(quoted(text_column)), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return narrow.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
