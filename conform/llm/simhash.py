"""SimHash near-dedup by tiled exact comparison."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.llm.components import connected_components
from conform.llm.forest import least_reachable
from conform.llm.staging import BLANKS, check_columns, row_hash, staged, text_or_empty

#: Shingles whose bits are summed at once, and code points taken apart at once.
_SHINGLES, _BLOCK = 8_192, 1 << 20

_WORD = re.compile(f"[^{BLANKS}]+")
_SPACE = re.compile(f"[{BLANKS}]")
#: What str.split() takes for white space beyond that.
_SEPARATORS = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def fingerprint(text: str, length: int = 3) -> int:
    """64 bits, each set if it is set in more than half of the XXH64 hashes (seed 42) of the text's word shingles.

    Shingles count as often as they occur; a text of fewer words has one shingle, the whole sequence, and one without
    words the fingerprint zero. Long texts are taken apart block by block.
    """
    votes, shingles, words, start = np.zeros(64, dtype=np.int64), 0, [], 0
    while start < len(text):
        cut = _SPACE.search(text, start + _BLOCK)
        end = cut.start() if cut else len(text)
        words += _words(text[start:end])
        start = end
        if len(words) >= length or end == len(text) and words and not shingles:
            keys = _shingles(words, length)
            for at in range(0, len(keys), _SHINGLES):
                hashes = [xxhash.xxh64_intdigest(key, 42) for key in keys[at : at + _SHINGLES]]
                bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
                votes += bits.sum(axis=0, dtype=np.int64)
            shingles += len(keys)
            words = words[len(words) - length + 1 :]
    return int(np.packbits(2 * votes > shingles).view(">u8")[0]) if shingles else 0


def _words(text: str) -> list[str]:
    lowered = text.lower() if text.isascii() else text.translate(_LOWER)
    return _WORD.findall(lowered) if _SEPARATORS.search(lowered) else lowered.split()


def _shingles(words: list[str], length: int) -> list[str]:
    if len(words) < length:
        return [" ".join(words)]
    return [" ".join(group) for group in zip(*(words[i:] for i in range(length)), strict=False)]


def simhash_groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 3,
    radius: int = 3,
    tile: int = 4_096,
) -> DataFrame:
    """One row per row of ``df``: id, fingerprint in hex, and component_id, the smallest id that links reach.

    Fingerprints link if they differ in at most ``radius`` bits. Rows with the same fingerprint are one node. The
    different fingerprints lie in classes by the population counts of their two halves, of which there are 33 x 33
    however many documents there are, and are dealt by hash into tiles of about ``tile`` within their class. A bit that differs
    moves one of the two counts by one, so only tiles whose counts differ by ``radius`` in sum at most are compared,
    all others are skipped. A task gets one pair of tiles and compares them by exclusive-or and bit count; it returns
    the smallest fingerprint that each one reaches inside the pair, never pairs, so a group of any size gives no more
    rows than it has members in each pair of tiles. All links follow from these by transitivity.

    The comparison is exact and its work is quadratic in the number of different fingerprints, about a quarter of all
    pairs. Null and empty texts have fingerprint zero and link like any other. A null id is not a component's
    name unless no other id is in it. Rows that repeat an id are returned as often; other columns are not touched.
    """
    check_columns(df, id_column, text_column)

    prints = _fingerprints(df, id_column, text_column, length)
    named = _components(prints, F.col("id"), radius, tile).select("print", F.col("best").alias("component_id"))
    return prints.join(named, "print").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _fingerprints(df: DataFrame, id_column: str, text_column: str, length: int, *more: Column) -> DataFrame:
    """id, print and more columns of every row, stored."""

    @F.pandas_udf("long")
    def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            prints = np.array([fingerprint(text, length) for text in batch], dtype=np.uint64)
            yield pd.Series(prints.view(np.int64))

    found = df.select(F.col(id_column).alias("id"), hashed(text_or_empty(text_column)).alias("print"), *more)
    return staged(found, "fingerprints")


def _components(prints: DataFrame, candidate: Column, radius: int, tile: int) -> DataFrame:
    """print, component and the component's best, the smallest candidate of its rows. Components are told apart by their smallest fingerprint."""
    nodes = staged(prints.groupBy("print").agg(F.min(candidate).alias("least")), "nodes")
    links = staged(_tile_links(nodes, radius, tile), "tile-links")
    reached = connected_components(links, "a", "b")
    members = nodes.join(reached, nodes["print"] == reached["node"], "left").select(
        "print", "least", F.coalesce("component", "print").alias("component")
    )
    # Written, so that a component of very many members is a skewed join that adaptive execution can split.
    names = staged(members.groupBy("component").agg(F.min("least").alias("best")), "names")
    return members.join(names, "component").select("print", "component", "best")


def _tile_links(nodes: DataFrame, radius: int, tile: int) -> DataFrame:
    """Links between fingerprints that give the same components as all links."""
    high, low = F.bit_count(F.shiftrightunsigned("print", 32)), F.bit_count(F.col("print").bitwiseAND(0xFFFFFFFF))
    classed = nodes.select("print", (high * 33 + low).cast("int").alias("class"))
    # At most 33 x 33 rows, whatever the input.
    sizes = classed.groupBy("class").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    sizes = F.broadcast(staged(sizes, "tiles"))
    dealt = classed.join(sizes, "class").withColumn("tile", F.pmod(F.xxhash64("print"), "tiles").cast("int"))
    near = [
        (33 * x + y)
        for x in range(-radius, radius + 1)
        for y in range(-radius, radius + 1)
        if abs(x) + abs(y) <= radius and (x, y) >= (0, 0)
    ]
    # A tile goes to the pairs with each tile of its class and of the classes after it, and likewise to those before it.
    other = sizes.select(F.col("class").alias("other"), F.col("tiles").alias("others"))
    left = dealt.withColumn("other", F.explode(F.transform(F.array(*map(F.lit, near)), lambda step: F.col("class") + step)))
    left = left.join(F.broadcast(other), "other").withColumn("their", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    left = left.where((F.col("class") != F.col("other")) | (F.col("tile") <= F.col("their")))
    right = dealt.withColumn("first", F.explode(F.transform(F.array(*map(F.lit, near)), lambda step: F.col("class") - step)))
    right = right.join(F.broadcast(other), right["first"] == other["other"]).withColumn(
        "their", F.explode(F.sequence(F.lit(0), F.col("others") - 1))
    )
    right = right.where((F.col("class") != F.col("first")) | (F.col("their") < F.col("tile")))
    pairs = left.select("class", "tile", "other", "their", "print", F.lit(0).alias("side")).unionByName(
        right.select(
            F.col("first").alias("class"),
            F.col("their").alias("tile"),
            F.col("class").alias("other"),
            F.col("tile").alias("their"),
            "print",
            F.lit(1).alias("side"),
        )
    )

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        prints = rows["print"].to_numpy().view(np.uint64)
        side = rows["side"].to_numpy()
        a, b = prints[side == 0], prints[side == 1]
        same = (key[0], key[1]) == (key[2], key[3])
        return _pair_links(a, a if same else b, same, radius)

    return pairs.groupBy("class", "tile", "other", "their").applyInPandas(compare, "a long, b long")


def _pair_links(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> pd.DataFrame:
    """From each fingerprint of two tiles to the smallest it reaches by links inside the pair."""
    starts, ends = [], []
    for at in range(0, len(a), 256):
        near = np.bitwise_count(a[at : at + 256, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        starts.append(i + at)
        ends.append(j if same else j + len(a))
    nodes = a if same else np.concatenate([a, b])
    i = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
    j = np.concatenate(ends) if ends else np.zeros(0, dtype=np.int64)
    least = least_reachable(len(nodes), i, j)
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return pd.DataFrame({"a": nodes[moved].view(np.int64), "b": nodes[least[moved]].view(np.int64)})


def one_of_each_group(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 3,
    radius: int = 3,
    tile: int = 4_096,
) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: one of each component that ``simhash_groups`` finds.

    Of a component, the smallest id stays, null ids last; of rows that agree in it, the one of smallest hash over
    all columns. A component is told apart by its smallest fingerprint, not by an id, so rows with null or repeated ids and
    different texts stay beside each other. Rows equal in every column are one. An empty table gives an empty one.
    """
    check_columns(df, id_column, text_column)
    prints = _fingerprints(df, id_column, text_column, length, row_hash(df).alias("hash"))
    candidate = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    kept = _components(prints, candidate, radius, tile).select(F.col("best.hash").alias("__row")).distinct()
    left = df.withColumn("__row", row_hash(df)).join(kept, "__row", "left_semi")
    # Rows of one hash are equal in every column, and the join has put them side by side already.
    return left.dropDuplicates(["__row"]).drop("__row")
