"""Personal data: base forms against plain patterns, bootstrapping against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from linkindex.llm import personal

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    digits = [int(c) for c in number][::-1]
    return sum(digits[0::2] + [sum(divmod(2 * d, 10)) for d in digits[1::2]]) % 10 == 0


def plain_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            keep = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if keep:
                found.append((m.start(), k, m.end()))
    return sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_base_spans(seed):
    draw = random.Random(seed)
    bits = ["a", "Z9", "@", "@@", ".", "..", "-", "+", "+1", " ", "  ", "0", "255", "256", "1.2.3.4", "00012", "(", ")", "é",
            "4111111111111111", "4111 1111 1111 1111", "x@y.z", "a%b@c-d.e.f", "+1 (705) 555-5569", "\n", "٣", "1.1.1.1.1.1.1.1.1"]
    for _ in range(3000):
        text = "".join(draw.choice(bits) for _ in range(draw.randrange(14)))
        assert personal.base_spans(text) == plain_spans(text), text
        units = personal.instances(text, personal.base_spans(text))
        assert all(a[1] <= b[0] for a, b in zip(units, units[1:], strict=False)), text
        assert all(s < e and seed_ == any(s <= b < e for b, _, _ in plain_spans(text)) for s, e, seed_ in units)


def test_long_runs():
    """Linear in a run's length."""
    n = 1_000_000
    assert personal.base_spans("a" * n) == personal.base_spans("1" * n) == personal.base_spans("@" * n) == []
    assert personal.base_spans("1." * n)[:2] == [(0, 1, 7), (8, 1, 15)]
    assert personal.base_spans("a" * n + "@b.c") == [(0, 0, n + 4)]
    assert len(personal.instances("1" * n + " " + "a-" * n + "12", [])) == 1


def brute(texts):
    """All spans of each text, by the rules as the module states them."""
    base = [plain_spans(t or "") for t in texts]
    places, plain = [], {}
    for number, text in enumerate(texts):
        text = text or ""
        units = personal.instances(text, base[number])
        marked, last = "", 0
        for start, end, _ in units:
            marked, last = marked + text[last:start].replace("\0", "\1") + " \0 ", end
        tokens = re.findall(r"\w+|[^\w\s]", (marked + text[last:].replace("\0", "\1")).lower())
        which = iter(units)
        for k, token in enumerate(tokens):
            around = []
            if k >= 2:
                around.append(("two", *tokens[k - 2:k]))
            if k >= 3:
                around.append(("three", *tokens[k - 3:k]))
            if 1 <= k < len(tokens) - 1:
                around.append(("sides", tokens[k - 1], tokens[k + 1]))
            if token == "\0":
                start, end, seed = next(which)
                places.append((number, start, end, seed, text[start:end].lower(), around))
            else:
                for p in around:
                    plain.setdefault(p, set()).add(token)
    held = {}
    for *_, instance, around in places:
        for p in around:
            held.setdefault(p, set()).add(instance)
    seeds = {instance for _, _, _, seed, instance, _ in places if seed}
    scores = {}
    for _ in range(personal.ROUNDS):
        trusted = {}
        for p, found in held.items():
            known = [1.0 if i in seeds else scores[i] for i in found if i in seeds or i in scores]
            n, z = len(found) + len(plain.get(p, ())), personal.DEVIATIONS**2
            share = sum(known) / n
            low = (share + z / 2 / n - math.sqrt(z) * math.sqrt(share * (1 - share) / n + z / 4 / n / n)) / (1 + z / n)
            if len(known) >= personal.SUPPORT and low >= personal.TRUST:
                trusted[p] = low
        wrong = {}
        for p, low in trusted.items():
            for i in held[p] - seeds:
                wrong[i] = wrong.get(i, 1.0) * (1 - low)
        now = {i: math.floor(1000 * round(1 - w, 6)) / 1000 for i, w in wrong.items()}
        now = {i: s for i, s in now.items() if s >= personal.ACCEPT / 1000}
        now = {i: max(now.get(i, 0), scores.get(i, 0)) for i in now.keys() | scores.keys()}
        if len(now) == len(scores):
            break
        scores = now
    for number, start, end, seed, instance, _ in places:
        if not seed and instance in scores:
            base[number].append((start, len(PLAIN), end))
    return [sorted(b) for b in base]


def listed(spans):
    return ",".join(f"{[*PLAIN, 'context'][k]}:{s}:{e}" for s, k, e in spans)


def expected(rows):
    out = []
    for (doc_id, text, *_), spans in zip(rows, brute([r[1] for r in rows]), strict=True):
        base = [s for s in spans if s[1] < 4]
        counts = [sum(k == own for _, k, _ in spans) for own in range(5)]
        out.append((doc_id, *counts[:4], hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), counts[4]))
    return sorted(out, key=repr)


def scanned(spark, rows, schema="doc_id long, text string"):
    return sorted(map(tuple, personal.scan(spark.createDataFrame(rows, schema)).collect()), key=repr)


def corpus(seed, n):
    """Prose; seeds after cues; unknown identifiers after the same cues, and after cues that only those have."""
    draw = random.Random(seed)
    prose = lambda k: " ".join(draw.choice("the of and to a in is it you that he was for on are".split()) for _ in range(k))
    email = lambda: f"{draw.choice('abcd')}{draw.randrange(10**4)}@mail{draw.randrange(9)}.example.com"
    phone = lambda: f"+1 (70{draw.randrange(9)}) 555-{draw.randrange(10**4):04d}"
    badge = lambda: f"ZX-{draw.randrange(10**5):05d}"
    rows = []
    for i in range(n):
        kind = i % 9
        middle = ["", "", f"please write to {email()} today", f"my phone number is {phone()}, call", f"the year {1900 + i}",
                  f"please write to {badge()} today" if i % 27 == 5 else "", f"my badge number: {badge()}. ask", f"token = {draw.randrange(10**12)}",
                  f"seen at {draw.choice(['a.b', 'x'])} {email()}"][kind]
        rows.append((i, f"{prose(draw.randrange(12))} {middle} {prose(draw.randrange(9))}"))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rows = corpus(seed, 400)
    got = scanned(spark, rows)
    assert got == expected(rows)
    found = {r[0]: r[7] for r in got}
    assert all(found[i] == 1 for i in range(400) if i % 27 == 5)  # unknown, in the seeds' contexts
    assert not any(found[i] for i in range(400) if i % 9 in (0, 1, 4, 7))  # harmless numbers and tokens


def test_rounds_reach_further(spark):
    """What one round accepts gives away a context that no seed has, and that another identifier."""
    rows = [(i, f"he said write to u{i}@mail.example.com today") for i in range(30)]
    rows += [(100 + i, f"he said write to ZX-{1000 + i} today") for i in range(8)]
    rows += [(200 + i, f"and her badge number ZX-{1000 + i} expired") for i in range(8)]
    rows += [(300, "and her badge number QQ-77231 expired"), (301, "and the number 4711 is large")]
    got = scanned(spark, rows)
    assert got == expected(rows)
    assert {r[0] for r in got if r[7]} == {*range(100, 108), *range(200, 208), 300}


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "mail a@b.c"), (3, "a@b.c"), (3, "a@b.c"), (4, "\0 x \0 12345 \0"), (5, "é" * 50 + " +49 30 1234567"),
            (6, "x " * 50_000 + "1.2.3.4"), (7, "4111 1111 1111 1111 4111 1111 1111 1111"), (8, "001.002.003.255 999.1.1.1 1.2.3.4.5.6.7.8")]
    assert scanned(spark, rows) == expected(rows)
    assert scanned(spark, [(*r, 1, "z") for r in rows], "doc_id long, text string, row long, found string") == expected(rows)
    assert scanned(spark, []) == []
    same = [(i, "so please write to a@b.cd today") for i in range(40)]  # copies are one seed
    same += [(50, "so please write to ZX-123 today")]
    assert scanned(spark, same) == expected(same)
    assert not any(r[7] for r in scanned(spark, same))
