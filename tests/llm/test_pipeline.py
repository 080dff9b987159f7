"""The pipeline on awkward rows against brute force."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F
from test_operators_llm import documents, ids_of, reached, slow_fingerprint

import corpus_pipeline
from conform.llm import language, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    return "".join(WORD.findall(text or ""))


def smallest(rows):
    return min(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_run(spark, tmp_path):
    df, _ = documents(spark)
    more = [(i, f"number {i} is a text of its own, {'word ' * i}", "en", "ab"[i % 2]) for i in range(20, 60)]
    more += [(None, "one without an id", "en", "b"), (None, "and another one of them", "en", "b")]
    df = df.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string"), True)
    df = df.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))

    # Language: only what has a language stays.
    predicted = language.predicted(docs, language.learn(docs)).where("lang_pred <> 'und'")
    rows = [(r.doc_id, r.text) for r in predicted.collect()]
    assert all(any(map(str.isalpha, text)) for _, text in rows) and len(rows) > 40
    # Exact dedup: the longest of each text, then the smallest id.
    groups = {}
    for row in rows:
        groups.setdefault(plain(row[1]), []).append(row)
    rows = [smallest([r for r in g if len(r[1]) == max(len(s[1]) for s in g)]) for g in groups.values()]
    # SimHash: the smallest id of each component.
    prints = [slow_fingerprint(text) for _, text in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    components = {}
    for row, least in zip(rows, reached(len(rows), links), strict=True):
        components.setdefault(least, []).append(row)
    rows = sorted(map(smallest, components.values()), key=repr)

    stage = docs
    for name, function in corpus_pipeline.STAGES[:3]:
        stage = function(spark, stage, str(tmp_path))
        assert stage.columns == docs.columns, name
    assert sorted(((r.doc_id, r.text) for r in stage.collect()), key=repr) == rows
    # Mixing and packing: every copy that the mix takes, piece by piece.
    taken = [(r.doc_id, r.size, r.copies) for r in mixing.mixed(stage).collect()]
    mixed = mixing.mixed_rows(stage).collect()
    assert len(mixed) == sum(copies for _, _, copies in taken) and {r.text for r in mixed} <= {text for _, text in rows}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    lengths = sorted(min(4096, len(ids_of(r.text)) - at) for r in mixed for at in range(0, len(ids_of(r.text)), 4096))
    assert sorted(p.length for p in pieces) == lengths
    for sequence in {p.sequence_id for p in pieces}:
        spans = sorted((p.offset, p.length) for p in pieces if p.sequence_id == sequence)
        assert [at for at, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]] and sum(n for _, n in spans) <= 4096


def test_run_on_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
