"""Array expressions of linear cost, and the operators that stand on them with very many parts."""

from __future__ import annotations

import random
import re
import time
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from linkindex.llm import arrays, chat, credentials

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
IDENT = (r"\b(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)"
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.=-]{3,}+)""")
SECRET = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])"
ENDPOINT = (r"\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]++"
            r"|\b(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.:-]{4,}+")


def found(pattern, text, order, keep=lambda m: True, flags=0):
    return [(m.start(), order, m.end()) for m in re.finditer(pattern, text, flags | re.A) if keep(m)]


def brute(text):
    """All spans, by comparing every part with every other."""
    text = text or ""
    base = [found(ASSIGN, text, 0, lambda m: len(m[2]) >= 6, re.I), found(r"AKIA[A-Z0-9]+", text, 1, lambda m: len(m[0]) >= 20),
            found(r"[0-9a-f]+", text, 2, lambda m: len(m[0]) >= 24)]
    mixed = lambda m: all(re.search(p, m[0]) for p in ("[0-9]", "[a-z]", "[A-Z]"))
    ident, secret = found(IDENT, text, 3, flags=re.I), found(SECRET, text, 4, mixed)
    near = lambda p, others: any(o[0] <= p[2] + 200 and o[2] >= p[0] - 200 for o in others)
    identifiers, secrets = base[1] + ident, base[0] + base[2] + secret
    return sorted([*sum(base, []), *(p for p in ident if near(p, secrets)), *(p for p in secret if near(p, identifiers)),
                   *(p for p in found(ENDPOINT, text, 5, flags=re.I) if near(p, identifiers) and near(p, secrets))])


def masked(text):
    out, at = "", 0
    for start, _, end in brute(text):
        if start >= at:
            out += text[at:start] + credentials.MASK
        at = max(at, end)
    return out + text[at:]


def texts(seed, n, most):
    draw = random.Random(seed)
    letters = "abcdefABCDEF0123456789"
    word = lambda k: "".join(draw.choice(letters) for _ in range(k))
    bits = [lambda: f"password = {word(draw.randrange(3, 9))}", lambda: "AKIA" + word(20).upper(),
            lambda: word(40), lambda: "".join(draw.choice("0123456789abcdef") for _ in range(draw.choice([20, 30, 40]))),
            lambda: f'"user_id": "{word(6)}"', lambda: f"https://{word(5)}.example/x", lambda: f"host={word(6)}",
            lambda: "é " * draw.randrange(120), lambda: "plain words " * draw.randrange(20), lambda: "token: user: abcdefgh"]
    return ["".join(draw.choice(bits)() + draw.choice(["", " ", "\n"]) for _ in range(draw.randrange(most))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_linked_spans_against_brute_force(spark, seed):
    rows = [(i, t) for i, t in enumerate([*texts(seed, 250, 14), *texts(seed + 10, 3, 700), "", None])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.found] for r in credentials.with_spans(frame, "found").collect()}
    assert got == {i: brute(t) for i, t in rows}
    assert sum(s[1] > 2 for v in got.values() for s in v) > 100
    changed = {r.doc_id: r.text for r in credentials.masked(frame).collect()}
    assert changed == {i: t if t is None else masked(t) for i, t in rows}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 31, 32, 33, 1024, 1025, 40_000])
def test_running_and_pieces(spark, monkeypatch, n):
    if n < 2000:
        monkeypatch.setattr(arrays, "BLOCK", 3)
    draw = random.Random(n)
    numbers = [draw.randrange(9) for _ in range(n)]
    text = "".join(draw.choice("aé😀\n ") for _ in range(sum(numbers) + 5))
    points = [0, *accumulate(numbers)][:n]
    frame = spark.createDataFrame([(numbers, text, points)], "a array<int>, t string, p array<long>")
    row = frame.select(
        arrays.running_sums(F.col("a")).alias("sums"),
        arrays.running(F.col("a"), lambda x, y: F.greatest(x, y), F.lit(-1)).alias("most"),
        arrays.pieces(F.col("t"), F.col("p")).alias("pieces")).first()
    assert row.sums == list(accumulate(numbers))
    assert row.most == list(accumulate(numbers, max))
    assert row.pieces == [text[a:b] for a, b in zip(points, [*points[1:], None], strict=True)] if n else row.pieces == []


def seconds(query):
    began = time.perf_counter()
    query.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def test_very_many_parts(spark):
    """Four times the parts take far less than sixteen times the time: here at most eight, with a second's slack."""
    def secrets(n):
        text = "user=abc " * n + "x" * 300 + " password=hunter22 " * n
        return spark.createDataFrame([(1, text)], "doc_id long, text string")

    def turns(n):
        rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                     F.when(F.col("id") % 3 == 0, "assistant").otherwise("user").alias("role"),
                                     F.lit("some words é").alias("text"))
        return chat.digests(chat.format_chats(rows))

    for make in (lambda n: credentials.scan(secrets(n)), lambda n: credentials.masked(secrets(n)), turns):
        make(100).collect()
        small, large = seconds(make(10_000)), seconds(make(40_000))
        assert large < 8 * small + 1, (small, large)
    got = credentials.scan(secrets(40_000)).first()
    assert got.n_assign == 40_000 and got.spans.count("ident") == 0 + sum(
        (9 * k + 8) + 200 >= 9 * 40_000 + 301 for k in range(40_000))
