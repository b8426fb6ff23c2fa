"""The corpus pipeline on a small folder with planted documents, and on empty tables."""

from __future__ import annotations

import random

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

ITEM = "Which river runs through the old town of Bremen and meets the sea? It is the broad grey Weser river."
SECRET = "password = hunter2hunter2"
DOCUMENTS = ("doc_id long, text string, lang string, source string, n_chars long, spans string, class int,"
             " score double")  # the last three clash with columns of the operators
LABELS = "doc_id long, quality int, toxic int"
BENCHMARK = "item_id long, text string"


def texts():
    """Text by id; and the ids that have to go."""
    draw = random.Random(11)
    words = [f"{a}{b}n{c}" for a in "wkmt" for b in "aeiou" for c in "dfgl"]
    rows, toxic = {}, set()
    for i in range(240):
        rows[i] = [draw.choice(words) + str(draw.randrange(50)) for _ in range(40)]
        if i % 4 == 0:
            toxic.add(i)
            for _ in range(6):
                rows[i][draw.randrange(40)] = draw.choice(["grobian", "grobiane", "moron"])
    rows = {i: " ".join(w) for i, w in rows.items()}
    rows |= {500: rows[1], 501: f"{rows[2]} tail", 502: rows[1].upper()}  # copies
    rows |= {510: f"{rows[5][:20]} {ITEM} {rows[6][-80:]}"}  # a leak
    rows |= {520: f"{rows[7]} {SECRET} some more of this text here and there"[150:]}
    rows |= {530: None, 531: "", 532: "word " * 9000}
    return rows, toxic | {500, 501, 502, 510}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, gone = texts()
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, None, None, None if t is None else len(t), "s", i, 0.5) for i, t in rows.items()]
    docs += [docs[1], docs[1], docs[5]]  # exactly repeated rows
    spark.createDataFrame(docs, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    marks = [(i, None, int(i in gone)) for i in range(240)]
    spark.createDataFrame(marks, LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], BENCHMARK).write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline(spark, folder):
    rows, gone = texts()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {}
    for r in corpus_pipeline.run(spark, folder).collect():
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert set(lengths) == set(rows) - gone
    for i in lengths:
        text = rows[i] or ""
        if i == 520:
            text = text.replace(SECRET, "[SECRET]")
            assert SECRET in rows[i]
        assert lengths[i] == len(library.encode(text, add_special_tokens=False).ids) + 1


def test_stages_keep_columns_and_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), folder)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0
