"""The text operators against brute force, on nulls, empty and long texts, ties, repeated rows and empty tables."""

from __future__ import annotations

import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conform.llm import embeddings, exact, html, language, matrices, mixing, packing, revisits, simhash, tokens
from conform.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = tokens.default_tokenizer()
LIBRARY = Tokenizer.from_file(PATH)


def documents(spark):
    """Awkward rows: nulls, empties, white space, copies, repeated rows, a long text, a column named like results."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta,", "gamma7", "straße", "don't", "12.5"]) for _ in range(9_000))
    near = long.split()
    near[4_000] = "changed"
    texts = [None, "", " \t\n", "Hello  World.", "HelloWorld.", "Hello  World.", long, " ".join(near), long + " ", "é" * 9, "?!"]
    rows = [(i, text, ["en", None, "de"][i % 3], ["a", "b", None][i % 3]) for i, text in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id", "en", "a"), (None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "'x' as kept", "1 as size", "'y' as score")
    return df, rows


def empty(df):
    return df.limit(0)


def test_exact_dedup(spark):
    df, rows = documents(spark)
    result = exact.exact_duplicates(df, "doc_id", "text", shortest=8, longest=32).collect()
    groups = {}
    for row in rows:
        groups.setdefault("".join(WORD.findall(row[1] or "")), []).append(row)
    best = {k: min(v, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0] for k, v in groups.items()}
    expected = sorted((str(r[0]), str(best[k]), len(v)) for k, v in groups.items() for r in v)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in result) == expected
    assert sum(r.kept for r in result) == len(groups)
    left = exact.without_exact_duplicates(df)
    assert left.count() == len(groups) and left.columns == df.columns
    assert exact.exact_duplicates(empty(df), "doc_id", "text").collect() == []


def test_shared_chunk_hashes_are_told_apart(spark, monkeypatch):
    df = spark.createDataFrame([(1, "ab"), (2, "ba"), (3, "ab"), (4, ""), (4, "")], "doc_id long, text string")
    shared = spark.createDataFrame([("ab", 0), ("ba", 1)], "chunk string, place int")
    known = shared.selectExpr("xxhash64(chunk) as hash", "place", "chunk")
    monkeypatch.setattr(exact, "_shared_hashes", lambda chunked: known)
    sizes = sorted((r.doc_id, r.keep_id, r.group_size) for r in exact.exact_duplicates(df, "doc_id", "text").collect())
    assert sizes == [(1, 1, 2), (2, 2, 1), (3, 1, 2), (4, 4, 2), (4, 4, 2)]


def test_mixing(spark):
    df, rows = documents(spark)
    result = mixing.mixed(df).collect()
    assert len(result) == len(rows)
    sizes = {}
    for row in rows:
        sizes[row[3]] = sizes.get(row[3], 0) + len(WORD.findall(row[1] or ""))
    for row in result:
        assert row.source_size == sizes[row.source] and 0 <= row.taken <= 2 * row.size
        assert row.target <= 2 * row.source_size + 1e-9
    assert sum({r.source: r.target for r in result}.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert sorted(map(repr, result)) == sorted(map(repr, mixing.mixed(df.repartition(3)).collect()))
    again = mixing.mixed_rows(df)
    assert again.columns == df.columns and again.count() == sum(r.copies for r in result)
    assert mixing.mixed(empty(df)).collect() == []


def test_mix_comes_near_its_targets(spark):
    df = spark.range(4_000).selectExpr(
        "id as doc_id", "repeat('w ', cast(id % 50 as int)) as text", "if(id % 3 = 0, 'hot', concat('s', id % 40)) as source"
    )
    taken = mixing.mixed(df).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for row in taken:
        assert abs(row["sum(taken)"] - row["max(target)"]) <= 25


@pytest.mark.parametrize("text", ["'a b c d e f g h i j'", "repeat('w ', cast(id % 20 as int))"])
def test_rows_that_share_an_id_are_mixed_one_by_one(spark, text):
    df = spark.range(400).selectExpr("cast(null as long) as doc_id", f"{text} as text", "if(id < 100, 'a', null) as source", "id as n")
    result = mixing.mixed(df.repartition(5)).collect()
    assert len(result) == 400
    for source in ("a", None):
        taken = sum(r.taken for r in result if r.source == source)
        assert abs(taken - next(r.target for r in result if r.source == source)) <= 10
    rows = mixing.mixed_rows(df).collect()
    assert len(rows) == sum(r.copies for r in result)
    assert sum(len((r.text or "").split()) for r in rows) == sum(r.taken for r in result)
    assert sorted(rows, key=repr) == sorted(mixing.mixed_rows(df.repartition(7)).collect(), key=repr)
    assert max(sum(r.n == n for r in rows) for n in range(400)) <= 2


def test_exact_dedup_of_repeated_rows_in_many_parts(spark):
    df = spark.range(0, 600, 1, 12).selectExpr("if(id % 3 = 0, null, 7) as doc_id", "if(id % 2 = 0, 'a text', ' a text') as text")
    result = exact.exact_duplicates(df, "doc_id", "text").collect()
    assert len(result) == 600 and sum(r.kept for r in result) == 1
    kept = next(r for r in result if r.kept)
    assert (kept.doc_id, kept.n_points) == (7, 7) and {(r.keep_id, r.group_size) for r in result} == {(7, 600)}


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aAzé ñß1'.,?!<|>\n\x1c\x85\xa0́Σİ汉") | st.characters(codec="utf-8"), max_size=60))
def test_word_encoder(text):
    encoder = tokens.word_encoder(PATH)
    for case in (text, text + "<|startoftext|>" + text, text.upper() + "<|ENDOFTEXT|> don't"):
        ids = np.frombuffer(encoder.ids(case), dtype="<u4").tolist()
        assert ids == LIBRARY.encode(case, add_special_tokens=False).ids


@pytest.mark.parametrize("chunk, overlap", [(32_768, 256), (4_000, 2), (5_000, 64)])
def test_token_counts(spark, chunk, overlap):
    df, rows = documents(spark)
    unbroken = [(50, "x" * 12_000, "en", "a"), (51, "x" * 6_000 + " " + "y" * 6_000, "en", "a")]
    df, rows = df.unionByName(spark.createDataFrame(unbroken, "doc_id long, text string, lang string, source string"), True), rows + unbroken
    result = tokens.token_counts(df, chunk=chunk, overlap=overlap).collect()
    counts = [len(LIBRARY.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    expected = [(r[0], len((r[1] or "").encode()), n, n > 2_048) for r, n in zip(rows, counts, strict=True)]
    assert sorted(map(repr, map(tuple, result))) == sorted(map(repr, expected))
    assert tokens.token_counts(empty(df)).collect() == []


def test_copies_of_a_long_text_are_encoded_once(spark, monkeypatch):
    text = " ".join(f"word{i}" for i in range(3_000))
    rows = [(i, text) for i in range(40)] + [(None, text), (40, "short"), (41, "汉" * 9_000), (41, "汉" * 9_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    taken, plain = [], tokens._spliced

    def spliced(texts, path, chunk, overlap):
        taken.append((texts.count(), chunk, overlap))
        return plain(texts, path, chunk, overlap)

    monkeypatch.setattr(tokens, "_spliced", spliced)
    found = tokens.token_counts(df, chunk=4_000).collect()
    expected = [(i, len(t.encode()), n := len(LIBRARY.encode(t, add_special_tokens=False).ids), n > 2_048) for i, t in rows]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    # Two different long texts; the one without any place to splice goes round until it is taken as a whole.
    assert taken[0] == (2, 4_000, 256) and all(n == 1 and chunk >= overlap for n, chunk, overlap in taken[1:])


def test_vocabulary_of_another_kind(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    assert not tokens.words_apart(other) and tokens.words_apart(LIBRARY)
    df, rows = documents(spark)
    found = tokens.token_counts(df, path=path, chunk=1_000).collect()
    expected = [(r[0], len(other.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    assert sorted(repr((r.doc_id, r.n_tokens)) for r in found) == sorted(map(repr, expected))


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def test_packing_and_matrices(spark, tmp_path):
    df, rows = documents(spark)
    result = matrices.packed_documents(df, capacity=512).collect()
    expected = []
    for row in rows:
        ids = ids_of(row[1])
        parts = [(at, np.array(ids[at : at + 512], "<u4")) for at in range(0, len(ids), 512)]
        expected += [(row[0], i, at, len(part), zlib.crc32(part.tobytes())) for i, (at, part) in enumerate(parts)]
    assert sorted(map(repr, (tuple(r)[:5] for r in result))) == sorted(map(repr, expected))
    for sequence in {r.sequence_id for r in result}:
        spans = sorted((r.offset, r.length) for r in result if r.sequence_id == sequence)
        ends = np.cumsum([length for _, length in spans])
        assert [at for at, _ in spans] == [0, *ends[:-1]] and ends[-1] <= 512
    matrices.write_matrices(df, str(tmp_path / "m"), capacity=512)
    back = {}
    for row in spark.read.parquet(str(tmp_path / "m")).collect():
        ids = np.frombuffer(row.input_ids, "<u2")
        assert len(ids) == 512 and not ids[row.n_tokens :].any()
        cuts = row.cumulative_lengths
        assert row.position_resets == cuts if row.n_tokens < 512 else cuts[:-1]
        for part, low, high in zip(row.documents, cuts, cuts[1:], strict=False):
            back.setdefault((part.doc_id, part.piece), []).append(ids[low:high].tolist())
    for row in rows:
        if row[0] not in (3, None):
            pieces = [back[row[0], i][0] for i in range(-(-len(ids_of(row[1])) // 512))]
            assert sum(pieces, []) == ids_of(row[1])
    assert matrices.packed_documents(empty(df)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=200))
def test_plans(lengths):
    histogram = {length: lengths.count(length) for length in lengths}
    for planner in (packing.best_fit_decreasing, lambda h, c: packing.linear_grouping(h, c, groups=6)):
        plan, filled = planner(histogram, 60), {}
        for length, low, high, first, offset in plan.moves:
            for i in range(high - low):
                filled.setdefault(first + i, []).append((offset, length))
        assert sorted(length for spans in filled.values() for _, length in spans) == sorted(lengths)
        assert set(filled) == set(range(plan.sequences))
        for spans in filled.values():
            spans.sort()
            assert [at for at, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]] and sum(n for _, n in spans) <= 60


def slow_fingerprint(text, length=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + length]) for i in range(len(words) - length + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def reached(n, links):
    least = list(range(n))
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(least[a], least[b])
            moved |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_simhash(spark):
    df, rows = documents(spark)
    prints = [slow_fingerprint(r[1] or "") for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    least = reached(len(rows), links)
    names = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            names[least[i]] = min(names.get(least[i], row[0]), row[0])
    expected = [(r[0], format(p, "016x"), names.get(n)) for r, p, n in zip(rows, prints, least, strict=True)]
    result = simhash.simhash_groups(df, tile=3).collect()
    assert sorted(map(repr, map(tuple, result))) == sorted(map(repr, expected))
    assert simhash.one_of_each_group(df).columns == df.columns
    assert simhash.simhash_groups(empty(df)).collect() == []


A, B, C, D = ("first one text here", "second other words there", "third of them says this", "and a fourth goes here")


@pytest.mark.parametrize(
    "kind, rows",
    [
        ("long", [(None, A), (None, B), (None, C), (5, A + " x"), (5, B + " y"), (6, C)]),
        ("long", [(None, A), (None, B), (7, C)]),
        ("string", [(None, A), ("null", B), ("null", C), (None, D), (None, D)]),
    ],
)
def test_one_row_of_each_component_stays(spark, kind, rows):
    df = spark.createDataFrame(rows, f"id {kind}, text string").selectExpr("*", "map('a', id) as more", "1 as __place2")
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (slow_fingerprint(rows[i][1]) ^ slow_fingerprint(rows[j][1])).bit_count() <= 3]
    least, groups = reached(len(rows), links), {}
    for i, row in enumerate(rows):
        groups.setdefault(least[i], []).append(row)
    for source in (df, df.repartition(5), df.unionByName(df)):
        kept = simhash.one_of_each_group(source, "id", "text")
        assert kept.columns == df.columns
        found = [(r.id, r.text) for r in kept.collect()]
        assert len(found) == len(groups)
        for group in groups.values():
            (one,) = [row for row in found if row in group]
            assert (one[0] is None, one[0] or 0) == min((r[0] is None, r[0] or 0) for r in group)


def test_exact_dedup_keeps_the_same_row_on_reruns(spark):
    rows = [(1, "a b", source, lang) for source in "xyz" for lang in ("en", None)] + [(1, "a\tb", "w", "en"), (None, "", "x", None), (None, None, "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    kept = {tuple(sorted(map(repr, exact.without_exact_duplicates(df.repartition(n)).collect()))) for n in (1, 3, 8)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2


def test_sample_of_a_language_is_bounded(spark):
    df = spark.range(4_000).selectExpr("cast(null as long) as doc_id", "concat('text ', id) as text", "if(id % 2 = 0, 'a', 'b') as lang")
    sample = language.sampled(df, "doc_id", "text", "lang", 100)
    assert {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()} == {"a": 100, "b": 100}
    again = language.sampled(df.repartition(7), "doc_id", "text", "lang", 100)
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, again.collect()))
    assert language.sampled(df.limit(0), "doc_id", "text", "lang", 100) is None


@settings(max_examples=150, deadline=None)
@given(st.text("aAbÀ \n\x85\x1c\xa0", max_size=40), st.integers(1, 4), st.sampled_from([1, 5, 1 << 20]))
def test_fingerprint(text, length, block):
    before, simhash._BLOCK = simhash._BLOCK, block
    try:
        assert simhash.fingerprint(text, length) == slow_fingerprint(text, length)
    finally:
        simhash._BLOCK = before


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.25 * rng.normal(size=8)).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, [2 * x for x in rows[0][1]]), (303, None), (304, [0.0] * 8)]
    rows += [(305, [float("nan")] * 8), (306, [float("inf")] * 8), (307, []), (308, [1.0, 0.0]), (309, [1.0, 0.1]), (310, [1.0] + [None] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as kept")
    good = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in good}
    links = [(i, j) for i in good for j in good if i < j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    least, n = reached(len(rows), links), [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    expected = [(r[0], n[i], least[i], least[i] == i) for i, r in enumerate(rows)]
    result = embeddings.near_duplicate_vectors(df, pivots=5, tile=16).collect()
    assert sorted(map(tuple, result)) == expected and len(links) > 500
    assert embeddings.near_duplicate_vectors(empty(df)).collect() == []


@pytest.mark.parametrize("kind", ["clustered", "alone", "both", "in a chain"])
@pytest.mark.parametrize("options", [{}, {"pivots": 3, "sample": 60, "tile": 16}, {"cell_degrees": 70.0, "tile": 50}])
def test_embedding_cells(spark, kind, options):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, 16))
    crowded = centres[rng.integers(0, 12, 200)] + 0.3 * rng.normal(size=(200, 16))
    alone = rng.normal(size=(200, 16))
    angles = np.linspace(0, 2.5, 120)
    chain = np.zeros((120, 16))
    chain[:, 0], chain[:, 1] = np.cos(angles), np.sin(angles)
    vectors = {"clustered": crowded, "alone": alone, "both": np.vstack([crowded, alone]), "in a chain": chain}[kind]
    # Every third row repeats an id, every tenth has none.
    ids = [None if i % 10 == 7 else i - i % 3 for i in range(len(vectors))]
    rows = [(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    links = [(i, j) for i, j in zip(*np.nonzero(near), strict=True) if i != j]
    least, names = reached(len(rows), links), {}
    for i, at in zip(ids, least, strict=True):
        if i is not None:
            names[at] = min(names.get(at, i), i)
    expected = [(i, int(near[at].sum()) - 1, names.get(n), i == names.get(n)) for at, (i, n) in enumerate(zip(ids, least, strict=True))]
    found = embeddings.near_duplicate_vectors(df, **options).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert sorted(map(tuple, found)) == [(i, 0) for i in range(41)] + [(i, 100) for i in range(100, 160)]


def test_main_text(spark):
    page = "<nav>m{0}</nav><div>Box</div><article><h1>T&amp;{0}</h1><div>Share</div><p>One<br>two<p>Same</article><div class=ad>x"
    rows = [(i, f"http://Host.example/{i}", page.format(i)) for i in range(12)]
    rows += [(90, None, None), (91, "odd", ""), (92, "http://other.example", page.format(0)), (None, "http://x.example/", "<p>a &lt;b&gt;  c</p>tail")]
    rows += [(93, "http://y.example", "<body><div class='comments'>no</div><form>no</form><ul><li>a<li>b</ul>end")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "0 as n_chars")
    found = {(r.page_id, r.url): r.text for r in html.main_texts(df).collect()}
    assert len(found) == len(rows)
    # What occurs on many pages of a host goes with its frame; running text of the article stays.
    assert found[3, "http://Host.example/3"] == "T&3\n\nOne two\n\nSame"
    assert found[92, "http://other.example"] == "T&0\n\nShare\n\nOne two\n\nSame"
    assert found[90, None] == "" and found[91, "odd"] == ""
    assert found[None, "http://x.example/"] == "a <b> c\n\ntail" and found[93, "http://y.example"] == "a\n\nb\n\nend"
    assert html.main_texts(empty(df)).collect() == []


def test_templates_by_nested_loops(spark):
    """Frames without telling names go if they recur on many pages of their host, counted by hand."""
    rng = random.Random(12)
    frames = [f"<div><div>part {i}</div><p>of frame {i}</p></div>" for i in range(12)]
    words = [f"w{i}" for i in range(300)]
    pages = []
    for i in range(90):
        host = rng.choice(["a", "a", "b"])
        used = rng.sample(range(12), rng.randint(0, 5)) if host == "a" else rng.sample(range(12), 2)
        body = " ".join(rng.choice(words) for _ in range(30))
        pages.append((i, host, used, body))
    pages += [(200 + i, "b", [11], "the same text on every page") for i in range(20)]  # mirrors count once
    pages += [(i, host, used, body) for i, host, used, body in pages[:5]]  # repeated rows
    texts = {(host, tuple(used), body) for _, host, used, body in pages}

    def kept(host, used):
        return [f for f in used if sum(h == host and f in u for h, u, _ in texts) < 10]

    rows = [
        (i, f"http://{host}.example/{i}", "".join(frames[f] for f in used) + f"<section><h2>{body[:20]}</h2><p>{body}</p></section>")
        for i, host, used, body in pages
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = sorted((r.page_id, r.text) for r in html.main_texts(df).collect())
    expected = []
    for i, host, used, body in pages:
        parts = [text for f in kept(host, used) for text in (f"part {f}", f"of frame {f}")]
        expected.append((i, "\n\n".join([*parts, " ".join(body[:20].split()), body])))
    assert found == sorted(expected)
    assert any(len(kept(host, used)) < len(used) for _, host, used, _ in pages)


@pytest.mark.parametrize(
    "page, blocks",
    [
        ("<article><p>a<div class='story-widget'><p>b</div><section class=related-work>c</section></article>", ["a", "b", "c"]),
        ("<article><p>a<div class='ad-slot'>b</div><div class='share'>c</div><ul class='x comments'><li>d</ul></article>", ["a"]),
        ("<article>card</article><div><p>" + "main text " * 20 + "</div><div class='site-footer'>b</div>", ["card", ("main text " * 20).strip()]),
        ("<div class='sidebar-left'>a</div><div class=story>b</div>", ["b"]),
    ],
)
def test_names_of_page_parts(page, blocks):
    assert [text for text, _ in html.PageReader(page).main()] == blocks


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</span>" * 100_000, "<div>" * 100_000 + "x" + "</div>" * 100_000, "<span>" * 30_000 + "<p>t" * 30_000])
def test_deep_pages_take_time_by_length(page):
    started = time.perf_counter()
    html.PageReader(page).main()
    assert time.perf_counter() - started < 5


def test_revisits(spark):
    rows = [
        (1, "response", "HTTP://Host.example:80/a/?b=2&a=1&utm_source=x#top", 10, {"etag": '"1"', "content-length": "5", "date": "d1"}),
        (2, "revisit", "https://host.example/a?a=1&b=2", 20, {"etag": 'W/"1"', "content-length": "0", "date": "d2"}),
        (3, "revisit", "https://host.example/a?a=1&b=2", 10, {"etag": '"1"'}),
        (4, "revisit", "https://host.example/a?a=1&b=2", 90_000, {"etag": '"2"', "date": "d4"}),
        (5, "revisit", "https://host.example/a?a=1&b=2", 200_000, None),
        (6, "revisit", None, 5, None),
        (7, "response", None, 4, None),
        (8, "revisit", None, None, None),
        (9, "request", None, 1, None),
    ]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, at long, headers map<string,string>")
    df = df.selectExpr("record_id", "kind", "url", "timestamp_seconds(at) as date", "headers", "1 as state")
    found = {r.record_id: (r.response_id, r.state, r.headers) for r in revisits.resolve_revisits(df).collect()}
    assert found == {
        2: (1, "resolved", {"etag": 'W/"1"', "content-length": "5", "date": "d2"}),
        3: (None, "missing", {"etag": '"1"'}),
        4: (1, "mismatch", {"etag": '"2"', "date": "d4"}),
        5: (1, "resolved", {"etag": '"1"', "content-length": "5", "date": "d1"}),
        6: (7, "resolved", {}),
        8: (None, "missing", {}),
    }
    assert revisits.resolve_revisits(empty(df)).collect() == []


def test_revisits_of_one_address_against_brute_force(spark):
    rng = random.Random(3)
    micros = [0, 1, 5, 999_999, 1_000_000, 3_599_999_999, 3_600_000_000, -1, -3_600_000_001]
    spread = [rng.choice(micros) + rng.choice([0, 0, 7_200_000_000, 90_000_000_000]) for _ in range(300)]
    rows = [(rng.choice([None, i, i]), rng.choice(["response", "revisit", "revisit"]), "h/a", at) for i, at in enumerate(spread)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, at long")
    df = df.selectExpr("record_id", "kind", "url", "timestamp_micros(at) as date", "map('etag', cast(at as string)) as headers")
    full = [row for row in rows if row[1] == "response"]

    def answer(revisit):
        earlier = [(r[3], r[0] is not None, r[0] or 0) for r in full if r[3] < revisit[3]]
        best = max(earlier, default=None)
        return (revisit[0], None, "missing") if best is None else (revisit[0], best[2] if best[1] else None, "mismatch")

    found = [(r.record_id, r.response_id, r.state) for r in revisits.resolve_revisits(df.repartition(4)).collect()]
    assert sorted(map(repr, found)) == sorted(repr(answer(row)) for row in rows if row[1] == "revisit")


def test_language(spark):
    df, rows = documents(spark)
    found = language.predicted(df, language.learn(df)).collect()
    for row in found:
        letters = any(map(str.isalpha, row.text or ""))
        assert (row.lang_pred == "und") == (not letters) and 0 <= row.score <= 1
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
    assert len(found) == len(rows) and "kept" in df.columns
    assert language.learn(empty(df)) is None
    assert {r.lang_pred for r in language.predicted(df, None).collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in language.predicted(docs, language.learn(docs)).collect() if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_code_lengths_by_brute_force(order):
    import pandas as pd

    samples = {"x": b"abracadabra abra", "y": b"banana bandana ab"}
    counts = {lang: {} for lang in samples}
    for lang, data in samples.items():
        for k in range(1, order + 2):
            for i in range(len(data) - k + 1):
                counts[lang][data[i : i + k]] = counts[lang].get(data[i : i + k], 0) + 1
    rows = [(lang, len(g), int.from_bytes(g, "big"), n) for lang, c in counts.items() for g, n in c.items()]
    trees = language._frozen(pd.DataFrame(rows, columns=["lang", "k", "gram", "n"]), order)
    text = "abanda qbra"
    for column, lang in enumerate(trees.languages):
        bits = 0.0
        for i in range(len(text)):
            for k in range(min(i, order), -2, -1):
                if k < 0:
                    bits += 8
                    break
                context, symbol = text[i - k : i].encode(), text[i : i + 1].encode()
                after = {g: n for g, n in counts[lang].items() if len(g) == k + 1 and g.startswith(context)}
                total = sum(after.values()) + len(after)
                if context + symbol in after:
                    bits += np.log2(total / after[context + symbol])
                    break
                bits += np.log2(total / len(after)) if after else 0
        assert language.code_lengths(trees, text)[column] == pytest.approx(bits)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAzé ñßÀÞµ²×12'.,?!<|>sSrE\n\x1c\x85\xa0́Σİ汉") | st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_texts_of_a_block(texts):
    special = "<|startoftext|> <|STARTOFTEXT|> don'T 'Re'LL ''s"
    cases = ["", special, *texts, *(special.join(text) for text in texts), "\n a\t"]
    encoder = tokens.WordEncoder(PATH)
    for _ in range(2):  # the second time from memory
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.each(pa.array(cases))]
        assert found == [LIBRARY.encode(case, add_special_tokens=False).ids for case in cases]


def test_different_parts_of_words_are_encoded_once(monkeypatch):
    encoder, taken, plain = tokens.WordEncoder(PATH, remembered=7), [], tokens.WordEncoder._part
    monkeypatch.setattr(tokens.WordEncoder, "_part", lambda self, part: taken.append(part) or plain(self, part))
    texts = ["Anlyha. anlyha", "ANLYHA!! été", "(Été) anlyha.", "Été!!"]
    expected = [LIBRARY.encode(text, add_special_tokens=False).ids for text in texts]
    for _ in range(2):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.each(pa.array(texts))] == expected
    assert sorted(taken) == sorted(["anlyha", ".", "!!", "été", "(", ")"])
    more = "one two three anlyha"
    assert np.frombuffer(encoder.ids(more), "<u4").tolist() == LIBRARY.encode(more, add_special_tokens=False).ids
    assert len(encoder.memo) == 7


@pytest.mark.parametrize("block", [1, 40, 1 << 23])
def test_blocks_of_texts(monkeypatch, block):
    monkeypatch.setattr(tokens, "_BLOCK", block)
    texts = ["a b", "", "long text " * 9 + "\x1cend", "é", "汉" * 30, "x  y", "", "word " * 20]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in tokens.WordEncoder(PATH).each(pa.array(texts))]
    assert found == [LIBRARY.encode(text, add_special_tokens=False).ids for text in texts]
    assert list(tokens.WordEncoder(PATH).each(pa.array([], "string"))) == []
