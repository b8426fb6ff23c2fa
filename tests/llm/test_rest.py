"""Search, toxicity, chats, secrets, sharding, decontamination and near duplicates on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkindex.llm import chat, credentials, decontam, jaccard, sharding, topk, toxicity
from linkindex.llm.components import components
from linkindex.sources import files, staging


# ---- exact top-k search

def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VALUES", 18)  # three rows of six components
    draw = random.Random(1)
    rows = [(i, [draw.choice([0.0, 0.0, 0.5, -0.25, 0.1]) for _ in range(6)], 0) for i in range(300)]
    rows += [(400, None, 0), (401, [1.0, None], 0), (402, [float("nan")], 0), (None, [1.0], 0),
             (403, [float("inf")], 0), (404, [], 0), (450, [0.5], 0), (450, [0.5], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = {}
    for r in topk.top_k_search(frame, k=5, every=50).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    kept = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    queries = {i for i, _ in kept if i % 50 == 0}
    assert set(got) == queries
    for i, v in kept:
        if i in queries and i != 450:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in kept if j != i)[:5]
            assert sorted(got[i]) == [(k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert topk.top_k_search(frame.limit(0)).count() == 0


def test_scores_beyond_64_bits_are_an_error(spark):
    schema = "vec_id long, embedding array<double>"
    for large in (1e18, 1e8 * 3e9, -1e30):
        frame = spark.createDataFrame([(0, [large, 1.0]), (50, [large, 2.0])], schema)
        with pytest.raises(ValueError, match="64 bits"):
            topk.top_k_search(frame)
    frame = spark.createDataFrame([(0, [4e6, -4e6]), (50, [-4e6, 4e6])], schema)
    assert {(r.query_id, r.score) for r in topk.top_k_search(frame).collect()} == {
        (0, -2 * (4 * 256 * 10**6) ** 2), (50, -2 * (4 * 256 * 10**6) ** 2)}


def test_blocks_are_planned():
    assert topk.planned_blocks(0, 0, 0, 8) == (1, 1)
    assert topk.planned_blocks(51_282, 1026, 64, 6) == (12, 1)  # all cores, no row is copied
    assert topk.planned_blocks(1000, 20, 64, 100) == (1, 1)
    n, q = topk.planned_blocks(10**9, 2 * 10**7, 64, 4000)
    assert n * q >= 8000 and q <= 2 * 10**7 / 1024 / 10 and 10**9 / n <= 16_384


# ---- toxicity

def test_toxicity_learns_and_generalises(spark):
    draw = random.Random(2)
    clean = [f"w{draw.choice('abcdefgh')}{draw.choice('klmnop')}n" for _ in range(60)]
    docs, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = [draw.choice(clean) for _ in range(30)]
        for k in range(5 * toxic):
            words[draw.randrange(30)] = draw.choice(["grobian", "grobiane", "grobianen", "Moron!", "1d1ot"])
        docs.append((i, " ".join(words), "de", i))
        labels.append((i, int(toxic)))
    docs += [(900, None, "de", 0), (901, "", "de", 0), (902, "you grobianisch m0ron " * 20, "de", 0),
             (None, "wan", "de", 0), (3, docs[3][1], "de", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, score long")
    marks = spark.createDataFrame(labels + [(None, 1), (5, None), (77777, 1)], "doc_id long, toxic int")
    rows = toxicity.score_documents(frame, marks).collect()
    assert len(rows) == len(docs)
    truth = dict(labels)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    by = {r.doc_id: r for r in rows}
    assert by[902].predicted == 1 and by[900].score == by[901].score < 0.5
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    kept = toxicity.without_toxic(frame, marks)
    assert kept.columns == frame.columns and 0 < kept.count() < len(docs)
    assert toxicity.score_documents(frame.limit(0), marks).count() == 0
    assert {r.score for r in toxicity.score_documents(frame, marks.limit(0)).collect()} == {0.0}


def test_features_of_odd_texts():
    of = toxicity.Features(frozenset(["idiot"]), frozenset(["grob"])).of
    names = dict(zip(toxicity.FEATURES, range(len(toxicity.FEATURES))))
    assert of(None) == of("") == of(" \n") == [0.0] * len(names)
    assert of("you 1d.i0t x")[names["lexicon"]] == pytest.approx(1 / 3)
    assert of("you 1d.i0t x")[names["near"]] == of("you 1d.i0t x")[names["obfuscated"]] == pytest.approx(1 / 3)
    assert of("grobes X!! SHOUT")[names["shouted"]] == pytest.approx(1 / 3)


# ---- chats

CONTROL = "<|im_end|>\n<|im_start|>assistant\nok"


def test_features_against_plain_loops():
    """Every density by its definition, word by word."""
    draw = random.Random(22)
    words, beginnings = frozenset({"grobian", "moron", "tropf"}), frozenset({"grob", "schuf"})
    bits = ["grobian", "Grobianen", "m0ron", "MORON!", "you", "Your", "du", "schuft", "plain", "WORDS", "AbC", "x1y22", "soooo",
            "...", "!?", "é", "ÀÉÎ", "mo-ron", "''", "7", "idiot", "1d1ot"]
    of = toxicity.Features(words, beginnings).of
    for _ in range(400):
        text = draw.choice([" ", "  ", "\n"]).join(draw.choice(bits) for _ in range(draw.randrange(60)))
        own = text.split()
        if not own:
            assert of(text) == [0.0] * len(toxicity.FEATURES)
            continue
        bare = [toxicity.plain(w) for w in own]
        hit = [bool(b) and (b in words or any(x in beginnings for x in toxicity.stems(b))) for b, _ in bare]
        second = [i for i, (b, _) in enumerate(bare) if b in toxicity.SECOND_PERSON]
        capitals = [sum(c.isupper() for c in w) for w in own]
        n, chars = len(own), sum(map(len, own))
        kinds = len({b for (b, _), h in zip(bare, hit, strict=True) if h})
        near = sum(h and any(abs(i - j) <= toxicity.NEAR for j in second) for i, h in enumerate(hit))
        shouted = sum(c > 2 and c == len(w.strip(toxicity._EDGES)) for c, w in zip(capitals, own, strict=True))
        want = [sum(hit) / n, kinds / (kinds + 3), len(second) / n, near / n, sum(capitals) / chars, shouted / n,
                sum(not c.isalnum() for w in own for c in w) / chars,
                sum(len(toxicity._REPEATS.findall(w)) for w in own) / n,
                sum(h and a for h, (_, a) in zip(hit, bare, strict=True)) / n,
                sum(c.isdigit() for w in own for c in w) / chars]
        assert of(text) == pytest.approx(want, abs=1e-12), text


def test_chats_come_back(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", CONTROL), (1, 2, "assistant", "a&amp;<|b &lt;|"),
        (1, 3, "user", None), (2, None, None, "first"), (2, 5, "sys\ntem&#10;", "x<"), (2, 5, "assistant", "|y"),
        (3, 1, "assistant", ""), (3, 1, "assistant", ""), (None, 1, "assistant", "é😀\n"), (4, 0, "user", "q" * 70000),
    ]
    frame = spark.createDataFrame(
        [(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_chats(frame)
    read = {r.conv_id: r for r in chat.read_chats(made).collect()}
    for conv in {t[0] for t in turns}:
        own = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        assert [(t.role, t.text) for t in read[conv].turns] == [(r, x) for *_, r, x in own]
        assert read[conv].loss_text == "".join(x for *_, r, x in own if r == "assistant")
    texts = {r.conv_id: r.formatted for r in made.collect()}
    assert texts[1].count("<|im_start|>") == 3 and texts[1].count("<|im_sep|>") == 1
    assert chat.digests(chat.format_chats(frame.limit(0))).count() == 0
    digest = {r.conv_id: r for r in chat.digests(made).collect()}[3]
    assert digest.n_turns == 2 and digest.loss_chars == 0
    assert digest.turns_sha256 == hashlib.sha256(b"assistant\n\nassistant\n\n").hexdigest()


# ---- secrets

def base_spans(text):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


ACCESS = "AKIA" + "Q" * 16
SECRET_TEXTS = [
    None, "", "nothing here", "é😀 password = 'abc123' x", "token: abc, TOKEN=abcdef secret:token: abcdef",
    ACCESS + " and " + "0123456789abcdef01234567", "AKIAAKIA" + "Z" * 15 + "AKIA" + "Z" * 15,
    "api_key=api_key=abcdef api-key=no", "user=jane " + "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY0",
    "user=jane and no more", "see https://example.org/x", f"{ACCESS} password=hunter22 https://db.example.org/x",
    ACCESS + " " * 500 + "user=jane", "secret" * 50 + "=" + "a" * 5000, "token=abcdef " * 300,
]


def test_secret_spans(spark):
    frame = spark.createDataFrame([(k, t, "c") for k, t in enumerate(SECRET_TEXTS)] + [(None, "token=abcdef", "c")],
                                  "doc_id long, text string, found string")
    rows = {r.doc_id: r for r in credentials.scan(frame).collect()}
    for k, text in enumerate(SECRET_TEXTS):
        want = base_spans(text or "")
        listed = ",".join(f"{credentials.KINDS[o]}:{s}:{e}" for s, o, e in want)
        assert rows[k].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (k, rows[k].spans, listed)
        assert (rows[k].n_assign, rows[k].n_access, rows[k].n_hex) == tuple(
            sum(o == x for _, o, _ in want) for x in range(3))
    assert "ident" in rows[8].spans and "secret" in rows[8].spans
    assert rows[9].spans == rows[10].spans == ""
    assert "endpoint" in rows[11].spans and "ident" not in rows[12].spans
    assert credentials.scan(frame.limit(0)).count() == 0 and rows[None].n_assign == 1


def test_masking(spark):
    frame = spark.createDataFrame(
        [(1, "é token = \"93f225f22ac4fd8e52991f66d5fe2fb55b67009f\" end", 7, "x"), (2, "clean", 99, "y"), (3, None, None, "z")],
        "doc_id long, text string, n_chars long, spans string")
    out = credentials.masked(frame)
    assert out.columns == frame.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text == 'é [SECRET]" end' and rows[1].n_chars == len(rows[1].text) and rows[1].spans == "x"
    assert (rows[2].text, rows[2].n_chars) == ("clean", 99) and rows[3].text is None


# ---- sharding

def test_table_is_even_and_stable():
    names = [f"s{k}" for k in range(10)]
    table = sharding.fill_table(names, 1009)
    counts = Counter(table.tolist())
    assert max(counts.values()) - min(counts.values()) <= 1 and len(table) == 1009
    fewer = sharding.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.2 * 1009
    heavy = Counter(sharding.fill_table(names, 1009, [3] + [1] * 9).tolist())
    assert heavy[0] > 2.5 * heavy[1]
    for wrong in ((names, 1000), ([], 1009), (["a", "a"], 1009), (names, 7)):
        with pytest.raises(ValueError):
            sharding.fill_table(*wrong)


def test_placement(spark):
    frame = spark.createDataFrame([(k, "t", "c") for k in [1, 1, 2, None, -5]], "doc_id long, text string, slot string")
    rows = sharding.place(frame, ["a", "b", "c"], size=101).collect()
    table = sharding.fill_table(["a", "b", "c"], 101)
    for r in rows:
        text = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (slot, "abc"[table[slot]])
    assert len(rows) == 5 and sharding.place(frame.limit(0), ["a"]).count() == 0


# ---- decontamination

def brute_scores(index, words):
    scores = Counter()
    for t in {index.terms[w] for w in words if w in index.terms}:
        p = index.postings[t]
        for part, impact in zip(p.parts.tolist(), p.impacts.tolist()):
            scores[part] += impact
    return scores


def items_of(draw, n):
    return [(k, " ".join(f"t{min(int(draw.expovariate(0.02)), 400)}" for _ in range(draw.randint(3, 60)))) for k in range(n)]


def made_index(items):
    frequencies = Counter(w for _, t in items for w in set(decontam.words_of(t)))
    mean = sum(len(decontam.words_of(t)) for _, t in items) / len(items)
    return decontam.Index(items, frequencies, len(items), mean)


def test_wand_retrieves_all_above(monkeypatch):
    monkeypatch.setattr(decontam, "POSTING_BLOCK", 4)
    draw = random.Random(5)
    index = made_index(items_of(draw, 300))
    for threshold in (0.1, 0.3, 0.6):
        for _ in range(60):
            words = [f"t{min(int(draw.expovariate(0.02)), 400)}" for _ in range(draw.randint(1, 80))]
            terms = sorted({index.terms[w] for w in words if w in index.terms})
            want = sorted(p for p, s in brute_scores(index, words).items() if s >= threshold)
            assert sorted(index.above(terms, threshold - 1e-9)) == want


def test_passages_that_may_retrieve_are_kept():
    """Of all passages, those of which some part scores the threshold, by scoring every part."""
    draw = random.Random(21)
    kept = needed = every = 0
    for trial in range(12):
        index = made_index(items_of(draw, 40))
        none, stride = len(index.postings), index.stride
        words = [f"t{min(int(draw.expovariate(0.02)), 420)}" for _ in range(draw.choice([5, 60, 900]))]
        for k in range(8):  # parts of items, whole or thinned out
            own = draw.choice(index_items(index, draw))
            at = draw.randrange(len(words) + 1)
            words[at:at] = [w for w in own if draw.random() < draw.choice([1.0, 0.7, 0.5])]
        ids = np.array([index.terms.get(w, none) for w in words], dtype=np.int64)
        may = set(index.passages(ids).tolist())
        for k in range(-(-len(ids) // stride)):
            terms = set(ids[k * stride:(k + 2) * stride].tolist()) - {none}
            scores = Counter()
            for t in terms:
                for part, impact in zip(index.postings[t].parts.tolist(), index.postings[t].impacts.tolist(), strict=True):
                    scores[part] += impact
            every += 1
            kept += k in may
            if scores and max(scores.values()) >= decontam.THRESHOLD:
                needed += 1
                assert k in may, (trial, k)
    assert 50 < needed <= kept < every


def index_items(index, draw):
    """Words of the index's parts, in any order."""
    names = {k: t for t, k in index.terms.items()}
    held = {}
    for k, p in enumerate(index.postings):
        for part in p.parts.tolist():
            held.setdefault(part, []).append(names[k])
    for words in held.values():
        draw.shuffle(words)
    return list(held.values())


def accepted(index, text):
    """The items that verification accepts, of all texts."""
    words = decontam.words_of(text)
    held, line, out = decontam.shingles_of(words), f" {' '.join(words)} ", set()
    for item_id, *sets in index.texts:
        whole, question, answer = (
            len(s & held) / len(s) if len(min(s)) == 5 else float(f" {' '.join(min(s))} " in line) for s in sets)
        if whole >= 0.8 or min(question, answer) >= 0.8:
            out.add(item_id)
    return out


def test_leaks_far_apart_are_those_of_brute_force():
    draw = random.Random(3)
    items = []
    for k in range(60):
        words = [f"t{min(int(draw.expovariate(0.02)), 400)}" for _ in range(draw.choice([2, 6, 9, 40, 120, 300]))]
        at = draw.randint(1, len(words) - 1)
        items.append((k, f"{' '.join(words[:at])}? {' '.join(words[at:])}."))
    index = made_index(items)
    far, n = " ".join(["filler"] * 700), 0
    for k, text in items:
        question, answer = text.split("?")
        words = decontam.words_of(text)
        for _ in range(4):
            halves = [edited(draw, h.strip(". ").split(), len(h.split()) > 30) for h in (question, answer)]
            pieces = [words[i:i + 30] for i in range(0, len(words), 30)]
            for parts in (halves, halves[::-1], pieces):
                doc = f" {far} ".join(" ".join(p) for p in parts)
                want = accepted(index, doc)
                assert {leak["item_id"] for leak in index.leaks(doc)} == want
                n += k in want
    assert n > 200


def test_leaks(spark):
    item = "Which river runs through the old town of Bremen and meets the sea? It is the broad grey Weser river."
    short = "Two words."
    rows = [
        (1, "filler text " * 400 + item + " more filler" * 300), (2, item.upper().replace(" ", "  ")), (3, "filler " * 500),
        (4, item.split("?")[0]), (5, None), (6, ""), (7, "has two words inside"), (1, item), (None, item),
    ]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(10, item), (11, short), (12, None), (None, "x y z"), (13, "")], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontam.find_leaks(frame, bench).collect())
    assert got == Counter({(1, 10): 2, (2, 10): 1, (None, 10): 1, (7, 11): 1})
    kept = decontam.without_leaks(frame, bench)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert decontam.find_leaks(frame, bench.limit(0)).count() == 0
    assert decontam.find_leaks(frame.limit(0), bench).count() == 0


def test_leaks_of_an_id_with_several_texts(spark, monkeypatch):
    one = "Which river runs through the old town of Bremen and meets the sea? It is the broad grey Weser river."
    two = "Name the metal that is liquid at room temperature and was used in thermometers. That metal is mercury."
    rows = [(1, f"some text before {one} and after"), (2, two), (3, "nothing of it " * 20), (4, f"{one} {two}"), (2, two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for texts in ([one, two], [two, one]):
        bench = spark.createDataFrame([(7, t) for t in texts], "item_id long, text string").coalesce(1)
        for words in (decontam.SEGMENT_WORDS, 20):
            monkeypatch.setattr(decontam, "SEGMENT_WORDS", words)
            got = Counter(tuple(r) for r in decontam.find_leaks(docs, bench).collect())
            assert got == Counter({(1, 7, 1.0, 1.0, 1.0): 1, (2, 7, 1.0, 1.0, 1.0): 2, (4, 7, 1.0, 1.0, 1.0): 1})
            assert [r.doc_id for r in decontam.without_leaks(docs, bench).collect()] == [3]


def test_items_without_an_id_leave_no_leaks(spark):
    item = "Which river runs through the old town of Bremen and meets the sea? It is the broad grey Weser river."
    docs = spark.createDataFrame([(1, f"text {item} text"), (2, "other text"), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (None, None), (3, "never found here")], "item_id long, text string")
    assert [r.doc_id for r in decontam.without_leaks(docs, bench).collect()] == [2]
    assert decontam.find_leaks(docs, bench).count() == 0  # reports are by id


def test_segments_are_sent_one_after_the_other(spark, monkeypatch):
    draw = random.Random(4)
    items = [(k, " ".join(f"i{draw.randrange(10**6)}" for _ in range(20))) for k in range(30)]
    bench = spark.createDataFrame([*items, (30, "..."), (31, "")], "item_id long, text string")
    texts = [f"{t} {' '.join('filler' for _ in range(9))}" for _, t in items] + ["nothing here", None, ""]
    docs = spark.createDataFrame([(k, t, "c") for k, t in enumerate([*texts, texts[0]])], "doc_id long, text string, leaks string")
    monkeypatch.setattr(decontam, "SEGMENT_WORDS", 150)
    held, most, broadcasts = set(), [], []
    context, made = type(spark.sparkContext), spark.sparkContext.broadcast

    def broadcast(self, value):
        sent = made(value)
        held.add(sent)
        broadcasts.append(sent)
        most.append(len(held))
        destroy = sent.destroy
        sent.destroy = lambda blocking=False: (held.discard(sent), destroy(blocking))
        return sent

    monkeypatch.setattr(context, "broadcast", broadcast)
    got = sorted((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect())
    assert got == sorted([(k, k) for k in range(30)] + [(33, 0)])
    kept = decontam.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [30, 31, 32]
    assert len(broadcasts) > 4 and max(most) == 1


# ---- near duplicates

def brute_components(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5
                    else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return [(i, len(sets[k]), min(groups[root(k)])) for k, (i, _) in enumerate(rows)]


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return words


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 900)  # large clusters at this size
    draw = random.Random(8)
    texts = ["", None, " \t\n", "one", "One", "a b c d", "A b c\x0bd", "a b c d e", "a b c d e"]
    for n in (6, 9, 14, 30, 80, 300):
        for _ in range(4):
            words = [f"w{draw.randrange(10**6)}" for _ in range(n)]
            for _ in range(12):
                texts.append(" ".join(edited(draw, words, draw.randrange(1 + n // 30 + 1))))
            texts.append(" ".join(words[:draw.randint(n // 2, n)]))
    passage = [f"p{k}" for k in range(60)]
    texts += [" ".join(passage + [f"x{draw.randrange(10**6)}" for _ in range(draw.choice([5, 10, 20, 60]))]) for _ in range(40)]
    base = [f"h{k}" for k in range(120)]
    texts += [" ".join(edited(draw, base, draw.randrange(4))) for _ in range(60)]
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, class int").repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(frame).collect())
    assert got == sorted(brute_components(rows))


def test_near_duplicates_of_odd_tables(spark):
    schema = "doc_id long, text string, size int"
    text = "the same six words again here"
    rows = [(4, text, 1), (4, text, 1), (None, text, 1), (9, text + " x", 1), (9, "another text of this id", 1), (7, text, 1)]
    frame = spark.createDataFrame(rows, schema)
    got = Counter((r.doc_id, r.component_id) for r in jaccard.near_duplicates(frame).collect())
    assert got == Counter({(4, 4): 2, (None, None): 1, (9, 9): 2, (7, 4): 1})
    kept = jaccard.one_per_component(frame)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({4: 1, None: 1, 9: 2})
    assert jaccard.near_duplicates(frame.limit(0)).count() == 0


def test_rows_without_an_id_are_in_groups(spark):
    words = [f"w{k}" for k in range(40)]
    text, near, alone = " ".join(words), " ".join([*words, "x"]), " ".join(f"a{k}" for k in range(12))
    only = " ".join(f"o{k}" for k in range(40))
    rows = [(5, text, "a"), (None, text, "b"), (None, near, "c"), (None, only, "d"), (None, only, "e"), (None, f"{only} x", "f"),
            (None, alone, "g"), (8, alone + " more words than one here", "h"), (None, None, "i"), (None, "", "j"), (None, " ", "k")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    kept = jaccard.one_per_component(frame, null_ids=True)
    assert kept.columns == frame.columns
    marks = {r.mark for r in kept.collect()}
    assert kept.count() == len(marks) == 7
    assert {"a", "g", "h", "i", "j", "k"} <= marks and len(marks & {"d", "e", "f"}) == 1
    same = frame.filter("doc_id is null").filter(f"text = '{only}'")
    assert jaccard.one_per_component(same, null_ids=True).count() == 1


def signatures(tokens):
    """By part: probed rows as ``(place, weight, sig)``, all rows' sigs, weight and need."""
    sigs, rows, needs = jaccard.entries(tokens, 1)
    out = {}
    for part, weight, need in needs:
        own = np.flatnonzero(rows["mark"] >> jaccard._PART == part)
        marks = rows["mark"][own]
        counted = own[(marks & (jaccard._EMPTY | jaccard._SHORT)) != jaccard._EMPTY]
        two = bool(marks[0] & jaccard._TWO)
        held = {}
        for i in counted.tolist():
            held.setdefault(int(rows["segment"][i]) if two else int(sigs[i]), []).append(int(sigs[i]))
        out[part] = held, {int(x) for x in sigs[own]}, weight, need, two
    return out


@pytest.mark.parametrize("cuts", [8, 2, 1])
def test_every_pair_shares_a_probed_segment(monkeypatch, cuts):
    """The pigeonhole itself, on sets at the very edge of the similarity, spread evenly or in few
    segments, whichever segments are chosen to be probed."""
    monkeypatch.setattr(jaccard, "CUTS", cuts)
    draw = np.random.default_rng(4)
    met = set()
    for size in [1, 2, 3, 4, 5, 7, 8, 9, 12, 16, 20, 25, 27, 40, 64, 100, 250]:
        for trial in range(60):
            high = 2**64 - 1 if trial % 3 == 0 else 2 ** int(draw.integers(60, 64))
            large = np.unique(draw.integers(0, high, size, dtype=np.uint64))
            drop = int(draw.integers(0, jaccard.most_errors(2 * size) + 1))
            kept = draw.permutation(large)[:max(1, len(large) - drop)]
            new = draw.integers(0, high, int(draw.integers(0, 2)) * int(draw.integers(0, drop + 1)), dtype=np.uint64)
            small = np.unique(np.r_[kept, new[:len(large) - len(kept)]])
            common = len(np.intersect1d(large, small))
            if 100 * common < 80 * (len(large) + len(small) - common):
                continue
            theirs = signatures(small)
            scheme = {k: s.number for k, (s, _) in enumerate(jaccard.joined_schemes(len(large)))}
            other = {s.number: k for k, (s, _) in enumerate(jaccard.joined_schemes(len(small)))}
            found = False
            for part, (held, _, weight, need, two) in signatures(large).items():
                there = theirs.get((part & ~1) | other[scheme[part & 1]] if scheme[part & 1] in other else -1)
                met.add((part >> 1, weight < need))
                if there is None or not need:
                    continue
                covered = 0
                for place in draw.permutation(np.array(list(held), dtype=np.uint64)).tolist():
                    if covered < need:
                        segment = 2 if two and len(held[place]) > 1 else 1
                        covered += segment
                        found |= bool(there[1] & set(held[place]))
            assert found, (size, len(small), common)
    assert (0, True) in met or cuts == 1


def test_short_texts_meet_little(spark):
    """Unrelated texts of nine shingles share no signature, so none is compared; their copies are found."""
    draw = random.Random(12)
    texts = [" ".join(f"w{draw.randrange(10**7)}" for _ in range(13)) for _ in range(5000)]
    copies = [f"{texts[k]} x" for k in range(0, 5000, 50)]
    docs = spark.createDataFrame(list(enumerate(texts + copies)), "doc_id long, text string")
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    table = jaccard.staged(jaccard.reduced(jaccard.indexed(keyed, 8), 8))
    shared = table.filter("kind = 2")
    assert shared.select("class").distinct().count() < 300
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert got == {k: k for k in range(5000)} | {5000 + k: 50 * k for k in range(100)}


@pytest.mark.parametrize("rounds", [0, 2, 100])
def test_groups_of_near_copies(spark, monkeypatch, rounds):
    """A large group in several blocks, a family without links that shares signatures, and sets on the
    edge of the group."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    draw = random.Random(13)
    base = [f"h{k}" for k in range(90)]
    texts = [" ".join(edited(draw, base, draw.randrange(3))) for _ in range(150)]
    texts += [" ".join(edited(draw, base, draw.choice([2, 3, 4]))) for _ in range(60)]
    family = [f"f{k}" for k in range(60)]
    texts += [" ".join(family + [f"x{draw.randrange(10**6)}" for _ in range(22)]) for _ in range(120)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(frame).collect())
    assert got == sorted(brute_components(rows))


def test_components(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)]
    edges += [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = {n: n for e in edges if e[0] != e[1] for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    assert got == least


def test_nothing_is_left_after_a_run(spark):
    docs = spark.createDataFrame([(k, f"the same words as in row {k // 2} here") for k in range(20)], "doc_id long, text string")
    staging.clear_session(spark)
    with staging.staged_until_done(spark) as folder:
        rows = jaccard.near_duplicates(docs).collect()
        assert len(rows) == 20 and files.children(spark, folder)
    assert not files.exists(spark, folder)
    jaccard.near_duplicates(docs).collect()  # outside of a run: the session's
    own = staging.run_dir(spark)
    assert files.children(spark, own)
    staging.clear_session(spark)
    assert not files.exists(spark, own)
