"""The registered queries of this package, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from linkindex.llm import (
    chat, credentials, decontam, id_files, jaccard, packing, personal, ranking, sharding, token_counts, topk,
    toxicity, trie,
)
from linkindex.llm.common import ship, table


SHARDS = [f"shard-{k:03d}" for k in range(64)]


def op1_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k_search(table(spark, folder, "embeddings"), k=5, every=50, scale=256)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)],
                                 "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(turns.unionByName(more)))


def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.scan(table(spark, folder, "documents"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents"), SHARDS)


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, folder, "documents"), path, limit=1024)


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, folder, "documents"), path, end_id=1)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return id_files.round_trip(table(spark, folder, "documents"), path, end_id=2)


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.scan(table(spark, folder, "documents"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES = {
    f.__name__: _shipped(f)
    for f in (op1_exact_topk, op2_toxicity, op3_chat_formatting, op4_secret_scans, op5_sharding,
              op6_benchmark_decontamination, op7_token_counts, op8_jaccard_join,
              op9_best_fit_packing, op10_token_files, op11_personal_data, op12_ranked_search, op13_prefix_trie)
}
#: DuckDB's forms. What they leave out cannot be said in SQL: learning, regular tokenisers, files.
ORACLES: dict[str, str] = {
    "op1_exact_topk": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS t
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(coalesce(list_sum([a[1] * a[2] FOR a IN list_zip(q.t, c.t)]), 0) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s
        )
        SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
    """,
    "op3_chat_formatting": """
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                             (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        ), e AS (
            SELECT *, length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) AS n_text,
                   length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;')) AS n_role,
                   role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS merged
            FROM c
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(n_text + CASE WHEN merged THEN 10 ELSE n_role + 24 END) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op8_jaccard_join": """
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS shingle
            FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0
        ), n AS (
            SELECT r, count(*) AS n FROM s GROUP BY r
        ), p AS (
            SELECT a.r AS a, b.r AS b, count(*) AS common
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY a.r, b.r
        ), l AS (
            SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b
            JOIN d dx ON dx.r = a JOIN d dy ON dy.r = b
            WHERE 100 * common >= 80 * (x.n + y.n - common) AND dx.doc_id IS NOT NULL AND dy.doc_id IS NOT NULL
        ), c(r, t) AS (
            SELECT r, r FROM d UNION SELECT c.r, l.b FROM c JOIN l ON l.a = c.t
        ), m AS (
            SELECT c.r, min(d.doc_id) AS component_id FROM c JOIN d ON d.r = c.t GROUP BY c.r
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
        FROM d JOIN m USING (r) LEFT JOIN n USING (r)
    """,
    "op12_ranked_search": """
        WITH t AS (
            SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM documents
        ), p AS (
            SELECT r, doc_id, term, count(*) AS tf, sum(count(*)) OVER (PARTITION BY r) AS n FROM t GROUP BY r, doc_id, term
        ), c AS (
            SELECT count(DISTINCT r) AS docs, count(*) AS words FROM t
        ), f AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, docs
        ), i AS (
            SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), q AS (
            SELECT item, item_id, term, count(*) AS times FROM i GROUP BY ALL
        ), s AS (
            SELECT item, item_id, r, doc_id,
                   CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
            FROM q JOIN p USING (term) JOIN f USING (term) CROSS JOIN c GROUP BY item, item_id, r, doc_id
        ), k AS (
            SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
    """,
    "op13_prefix_trie": """
        WITH RECURSIVE bits(i, k, v) AS (
            SELECT CAST(range AS UBIGINT), 0, CAST(range AS UBIGINT) FROM range(256)
            UNION ALL
            SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE k < 8
        ), crc AS (
            SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8
        ), o AS (
            SELECT conv_id, list([r, x] ORDER BY turn NULLS FIRST, r, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')),
                                 md5(length(r) || ':' || r || x)) AS turns
            FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations)
            WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), h AS (
            SELECT conv_id, turns, conv_id - conv_id % 20 AS base,
                   CAST(xor(list_reduce([4294967295::UBIGINT] || [ascii(c)::UBIGINT FOR c IN string_split(conv_id::VARCHAR, '')],
                        lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS INTEGER) + 1])), 4294967295::UBIGINT) % 4 AS INTEGER) AS h
            FROM o, crc
        ), r AS (
            SELECT h.conv_id, coalesce(b.turns, [])[1:h.h] || h.turns[h.h + 1:] AS turns
            FROM h LEFT JOIN o b ON b.conv_id = h.base
        ), m AS (
            SELECT conv_id, d AS depth, turns[1:d] AS path, d = len(turns) AS last
            FROM r, unnest(range(0, len(turns) + 1)) AS u(d)
        ), n AS (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(path[depth][2], '[^\x20\x09-\x0D]+')) END AS words,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
            FROM m GROUP BY path, depth
        ), k AS (
            SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
        ), f AS (
            SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (path, depth)
        ), s AS (
            SELECT f.path[1:a.d] AS path, a.d AS depth, count(*) FILTER (f.n_children = 0) AS n_leaves,
                   sum((f.n_convs - 1) * f.words) AS saved_tokens
            FROM f, unnest(range(0, f.depth + 1)) AS a(d) GROUP BY ALL
        )
        SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
               s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
        FROM f JOIN s USING (path, depth)
        LEFT JOIN f p ON p.depth = f.depth - 1 AND p.path = f.path[1:f.depth - 1]
    """,
}
