"""Whitening, hard negatives and sentence pieces against brute force and the library."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conform.llm import negatives, pieces, queries, whitening

FOLDER = "/root/testdata/sf0.01"
MODEL = pieces.default_model()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ENCODER = pieces.PieceEncoder(MODEL)


def vectors(spark):
    """Awkward rows: nulls, infinities, copies, repeated and null ids, another length, columns named like results."""
    rng = np.random.default_rng(3)
    many = [[float(x) for x in rng.standard_normal(6) * [3, 2, 1, 1, 0.5, 0.25]] for _ in range(160)]
    rows = [(i * 10, many[i], i % 3) for i in range(160)]
    rows += [(5, many[0], 0), (0, many[1], 1), (0, many[1], 1), (None, many[2], 2), (300, many[3], None)]
    rows += [(11, None, 1), (12, [], 1), (13, [float("nan")] * 6, 2), (14, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0)]
    rows += [(15, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0], 0), (100, [1.0, 2.0], 0), (101, [2.0, 1.0], 0), (102, [1.5, 1.5], 1)]
    rows += [(2**60 + 100, many[4], 1), (2**60 + 101, many[4], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.selectExpr("*", "'x' as n", "1 as row", "'y' as component", "0 as rank", "2 as x"), rows


def usable(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def test_whitening(spark):
    df, rows = vectors(spark)
    for source in (df, df.repartition(7)):
        found = {}
        for row in whitening.whitened_vectors(source, components=4).collect():
            found.setdefault((row["n"], row["component"]), []).append(row)
        kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v, _ in rows if usable(v)]
        for size, count in ((6, 4), (2, 1)):
            mine = [(i, x) for i, x in kept if len(x) == size]
            fit = np.array(sorted({tuple(x) for _, x in mine}))
            n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
            centred = fit - fit.mean(axis=0)
            covariance = centred.T @ centred / n
            values, axes = np.linalg.eigh(covariance)
            assert max(c for m, c in found if m == n) == count
            for component in range(1, count + 1):
                result = found[n, component]
                axis = axes[:, -component] / math.sqrt(values[-component])
                expected = sorted(
                    (str(i), sum((n * c - s) ** 2 for c, s in zip(x, sums)), round(abs(float((np.array(x) - fit.mean(axis=0)) @ axis)), 6))
                    for i, x in mine
                )
                assert sorted((str(r.vec_id), r.deviation, round(abs(r.whitened), 6)) for r in result) == expected
                assert {round(r.explained, 9) for r in result} == {round(values[-component] / values.sum(), 9)}
                assert {r.identity_error < 1e-9 for r in result} == {True}
                assert len({r.identity_error for r in result}) == 1
    assert whitening.whitened_vectors(df.limit(0)).collect() == []
    assert whitening.whitened_vectors(df.where("vec_id = 5")).collect() == []  # one vector has no variance


def test_whitening_in_wide_numbers(spark):
    rows = [(i, [float(3**i) * 2**20, float(i)]) for i in range(16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(column) for column in zip(*x)]
    (fit,) = whitening.fitted(df.select(whitening.whole_numbers(F.col("embedding")).alias("x"))).values()
    exact = [[16 * a - s for a, s in zip(row, sums)] for row in x]
    trace = sum(part * part for row in exact for part in row) / 16**3
    assert fit.sums == tuple(sums) and fit.eigenvalues.sum() == pytest.approx(trace, rel=1e-12)
    with pytest.raises(Exception, match="too large"):
        df.select(whitening.whole_numbers(F.array(F.lit(1e300)))).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 12), st.integers(0, 10**6))
def test_slices(size, rank, seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-3, 4, (rank, size)).astype(float)
    covariance = rows.T @ rows
    values, axes = whitening.leading_components(covariance, size)
    expected = np.linalg.eigvalsh(covariance)[::-1]
    assert np.allclose(values, expected[: len(values)], atol=1e-10) and np.all(expected[len(values) :] < 1e-9)
    assert np.allclose(axes @ axes.T, np.eye(len(values)), atol=1e-12)
    assert np.allclose(axes @ covariance, values[:, None] * axes, atol=1e-10)
    shift = float(rng.uniform(-1, 30))
    if np.abs(expected - shift).min() > 1e-9:
        assert whitening.Factors(covariance, shift).above() == (expected > shift).sum()


def brute_negatives(rows, scale=256, count=5):
    kept = [(i, [math.floor(scale * c) for c in v], label) for i, v, label in rows if label is not None and usable(v)]

    def first(candidates):
        return sorted(candidates, key=lambda c: (-c[1], c[0] is None, c[0] or 0))[:count]

    found = []
    for at, (i, x, label) in enumerate(kept):
        if i is None or i % 100:
            continue
        scores = [
            (j, sum(a * b for a, b in zip(x, y)), other == label)
            for place, (j, y, other) in enumerate(kept)
            if place != at and len(y) == len(x)
        ]
        for positive in first([s for s in scores if s[2]]):
            p = positive[1]
            band = [s for s in scores if not s[2] and 80 * p <= 100 * s[1] <= 100 * p]
            found += [(i, positive[0], rank + 1, s[0], p, s[1]) for rank, s in enumerate(first(band))]
    return sorted(map(repr, found))


@pytest.mark.parametrize("tile", [7, 64, 4_096])
def test_hard_negatives(spark, tile):
    df, rows = vectors(spark)
    found = negatives.hard_negatives(df.repartition(3), F.col("vec_id") % 100 == 0, tile=tile)
    assert sorted(repr(tuple(row)) for row in found.collect()) == brute_negatives(rows)
    text = df.withColumn("vec_id", F.concat(F.lit("v"), F.col("vec_id")))
    assert negatives.hard_negatives(text, F.col("vec_id").rlike("(^v0|00)$"), tile=tile).count() == found.count()
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0, tile=tile).collect() == []


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 1.0], i % 2) for i in range(0, 40)] + [(None, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = negatives.hard_negatives(df, F.col("vec_id") == 0, tile=5).orderBy("positive_id", "rank").collect()
    assert [r.positive_id for r in found[::5]] == [2, 4, 6, 8, 10]
    assert [r.negative_id for r in found[:5]] == [1, 3, 5, 7, 9]


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 60), st.integers(1, 20), st.integers(1, 9), st.integers(0, 10**6))
def test_packed_scores(bits, size, count, seed):
    rng = np.random.default_rng(seed)
    a, c = (rng.integers(-(2**bits), 2**bits, (n, size)) for n in (3, count))
    exact = a.astype(object) @ c.astype(object).T
    assert (negatives.packed_scores(a, c) == exact).all()


def documents(spark):
    texts = [None, "", " ", "  two  spaces ", "plain words, plain words.", "a▁b", "tab\tand\r\nline", "日本語 😀 ﷺ\x00", "<s> <0x41>"]
    texts += [" " * 70 + "x" * 70 + " " * 33, "ab" * 40_000, ("some words again; " * 9_000), "é" * 5]
    rows = [(i, text) for i, text in enumerate(texts)] + [(4, texts[4]), (4, texts[4]), (None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as ids", "1 as decoded"), rows


def test_sentence_pieces(spark, monkeypatch):
    df, rows = documents(spark)
    found = pieces.encoded_documents(df).collect()
    expected = [(i, LIBRARY.encode(text or "")) for i, text in rows]
    assert sorted(repr((r.doc_id, list(r.ids))) for r in found) == sorted(map(repr, expected))
    assert sorted(r.decoded for r in found) == sorted(LIBRARY.decode(ids) for _, ids in expected)
    assert pieces.encoded_documents(df.limit(0)).collect() == []
    ids = spark.createDataFrame([([264, 287],), ([],), (None,), ([3, None],)], "ids array<int>")
    assert [r[0] for r in ids.select(pieces.decoded("ids", MODEL)).collect()] == ["a b", "", None, None]


def test_sentence_pieces_query(spark):
    found = {row.doc_id: row for row in queries.op13_sentence_pieces(spark, FOLDER).collect()}
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(texts)
    for doc_id, text in texts:
        ids = LIBRARY.encode(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
        assert found[doc_id][1:] == (len(ids), digest, decoded)


MERGING = st.sampled_from(sorted(piece.replace("▁", " ") for piece in ENCODER.scores) + list(" \t\r\n;aeé日😀▁"))


@settings(max_examples=300, deadline=None)
@given(st.lists(MERGING, max_size=25).map("".join), st.integers(0, 40), st.sampled_from([1 << 14, 20]))
def test_table_of_prefixes(text, blanks, prefixes):
    text = text + " " * blanks + text[::-1]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pieces, "_PREFIXES", prefixes)
        patch.setattr(pieces, "_IDS", 5)
        ENCODER.memo.clear()
        ids = ENCODER.ids(text)
        assert ids.tolist() == LIBRARY.encode(text)
        assert ENCODER.text(ids) == LIBRARY.decode(ids.tolist())


def test_other_vocabularies_are_refused(monkeypatch):
    other = pieces.PieceEncoder(MODEL)
    other.scores = {piece: 0.0 for piece in other.scores}
    other.pairs, other.memo = {}, {}
    with pytest.raises(ValueError, match="merge by score"):
        other.check()
