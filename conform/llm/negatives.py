"""Hard-negative mining by Kronecker-packed products."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.llm.staging import check_columns, staged
from conform.llm.whitening import whole_numbers

#: Bits of the whole numbers that a double holds exactly, and fields of a number that is wider than these.
_BITS, _FIELDS = 53, 8
#: Anchors whose scores are in memory at once.
_BLOCK = 128


def packed_scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """The inner products of whole-number rows, exact, several candidates to a multiplication.

    A bias makes all components of either side non-negative. The biased components that some candidates have in one dimension then
    lie in fields of one wide integer, each as wide as the largest sum of products can get, so that no field reaches
    into the next. Every wide integer is multiplied once by the anchor's component and added up over the dimensions; the fields of
    the sum, less what the bias added, are the scores. While two or more fields fit into the 53 bits that a double holds, doubles carry the
    wide integers and a matrix product adds them up without rounding. Where one alone fits, so do doubles; where none does,
    Python's unbounded integers carry eight.
    """
    size = anchors.shape[1]
    if not (len(anchors) and len(candidates) and size):
        return np.zeros((len(anchors), len(candidates)), dtype=np.int64)
    bias_a, bias_c = (max(0, -int(side.min())) for side in (anchors, candidates))
    largest = (max(int(anchors.max()), 0) + bias_a) * (max(int(candidates.max()), 0) + bias_c)
    kind = np.int64 if largest * size < 1 << 62 else object
    a, c = anchors.astype(kind) + bias_a, candidates.astype(kind) + bias_c
    width = max(1, int((a @ c.max(axis=0)).max()).bit_length())
    fields = max(1, _BITS // width) if width <= _BITS else _FIELDS
    kind = np.int64 if width * fields <= _BITS else object
    filled = np.zeros((-(-len(c) // fields) * fields, size), dtype=kind)
    filled[: len(c)] = c
    wide = sum(filled[field::fields] << field * width for field in range(fields))
    if kind is np.int64:
        sums = (a.astype(float) @ wide.astype(float).T).astype(np.int64)
    else:
        sums = a.astype(object) @ wide.T
    scores = np.empty((len(a), len(filled)), dtype=kind)
    for field in range(fields):
        scores[:, field::fields] = (sums >> field * width) & ((1 << width) - 1)
    return scores[:, : len(c)] - bias_c * a.sum(axis=1)[:, None] - bias_a * c.sum(axis=1)[None, :] + size * bias_a * bias_c


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    tile: int = 4_096,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for the rows where ``anchors`` holds.

    A component c counts as floor(scale * c), and a score is the whole inner product of two rows' vectors, exact. The positives of an anchor
    are the first ``positives`` other rows of its label; for each of them come the first ``negatives`` rows of other
    labels whose score is at least ``low`` and at most ``high`` per cent of the positive's. Higher scores come first,
    then smaller ids, null ids last.

    All anchors meet all rows, in pairs of tiles dealt by hash, however labels are spread; a task multiplies one pair by
    ``packed_scores`` and returns no more rows per anchor than are asked for, the first of its tile. These merge to the
    first of all. Positives are known before negatives are looked for, so that the products are formed twice and never stored.
    Shuffled are rows times tiles of anchors and anchors times tiles of rows.

    Rows whose label or vector is null or whose vector has entries that are null, infinite or NaN take no part; an entry
    beyond 2^53 once scaled fails the job. Only vectors of one length meet. Ids (integers or strings) may repeat or be
    null: each row is one of its own, and a row of equal id and score gives an equal row of the result. An anchor without positives, or
    a positive without negatives, gives no row, like an empty table. Other columns are not touched.
    """
    check_columns(df, id_column, vector_column, label_column)
    kind = df.schema[id_column].dataType
    if not isinstance(kind, (T.IntegralType, T.StringType)):
        raise ValueError(f"ids must be integers or strings, not {kind.simpleString()}")
    key_type = "long" if isinstance(kind, T.IntegralType) else "string"
    rows = df.select(
        # Stored below, so that a row keeps its number. A key that is never null keeps integers whole in Python.
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).isNull().alias("none"),
        F.coalesce(F.col(id_column).cast(key_type), F.lit(0).cast(key_type)).alias("key"),
        F.col(label_column).cast("string").alias("label"),
        whole_numbers(F.col(vector_column), scale, 0).alias("x"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    rows = staged(rows.where("label is not null and x is not null").withColumn("size", F.size("x")), "vectors")
    pairs = _Pairs(rows, tile, key_type)
    names = ["row", "none", "key"]
    found = pairs.selected(rows.where("anchor").withColumn("bars", F.array().cast("array<long>")), positives, None)
    first = [F.desc("score"), "other_none", "other_key", "other_row"]
    best = Window.partitionBy("row").orderBy(*first)
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    chosen = staged(found.drop("place", "bar"), "positives")
    bars = chosen.groupBy("row").agg(F.collect_set("score").alias("bars"))  # at most ``positives`` of them
    found = pairs.selected(rows.where("anchor").join(bars, "row"), negatives, (low, high))
    best = Window.partitionBy("row", "bar").orderBy(*first)
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    found = found.select(
        "row", "bar", "rank", F.col("other_none").alias("n_none"), F.col("other_key").alias("n_key"), F.col("score").alias("n_score")
    )
    joined = chosen.withColumnRenamed("score", "bar").join(found, ["row", "bar"])

    def named(none: str, key: str) -> Column:
        return F.when(~F.col(none), F.col(key).cast(kind))

    return joined.select(
        named(*names[1:]).alias("anchor_id"),
        named("other_none", "other_key").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        named("n_none", "n_key").alias("negative_id"),
        F.col("bar").alias("positive_score"),
        F.col("n_score").alias("negative_score"),
    )


class _Pairs:
    """Tiles of anchors against tiles of all rows."""

    def __init__(self, rows: DataFrame, tile: int, key_type: str):
        self.rows, self.key_type = rows, key_type
        # One row per length of a vector.
        sizes = rows.groupBy("size").agg(
            F.ceil(F.count_if("anchor") / tile).cast("int").alias("anchor_tiles"),
            F.ceil(F.count("*") / tile).cast("int").alias("row_tiles"),
        )
        self.sizes = staged(sizes.where("anchor_tiles > 0"), "tiles")

    def selected(self, anchors: DataFrame, count: int, band: tuple[int, int] | None) -> DataFrame:
        """Each anchor's first rows in every tile: of its label without a band, else of other labels for each of its bars."""
        sizes = F.broadcast(self.sizes)
        number = F.xxhash64("row")
        left = anchors.join(sizes, "size").select(
            *anchors.columns,
            F.lit(0).alias("side"),
            F.pmod(number, "anchor_tiles").cast("int").alias("a"),
            F.explode(F.sequence(F.lit(0), F.col("row_tiles") - 1)).alias("b"),
        )
        right = self.rows.join(sizes, "size").select(
            *self.rows.columns,
            F.array().cast("array<long>").alias("bars"),
            F.lit(1).alias("side"),
            F.explode(F.sequence(F.lit(0), F.col("anchor_tiles") - 1)).alias("a"),
            F.pmod(number, "row_tiles").cast("int").alias("b"),
        )
        columns = ["size", "a", "b", "side", "row", "none", "key", "label", "x", "bars"]
        grouped = left.select(columns).unionByName(right.select(columns)).groupBy("size", "a", "b")
        schema = (
            f"row long, none boolean, key {self.key_type}, bar long, "
            f"other_row long, other_none boolean, other_key {self.key_type}, score long"
        )

        def select(rows: pd.DataFrame) -> pd.DataFrame:
            # In the order of ties, so that a stable sort by score settles them.
            rows = rows.sort_values(["none", "key", "row"], ignore_index=True)
            rows["label"] = pd.factorize(rows["label"])[0]
            mine, theirs = (rows[rows["side"] == side].reset_index(drop=True) for side in (0, 1))
            return _first_of_tile(mine, theirs, count, band)

        return grouped.applyInPandas(select, schema)


def _first_of_tile(mine: pd.DataFrame, theirs: pd.DataFrame, count: int, band: tuple[int, int] | None) -> pd.DataFrame:
    found = []  # places of an anchor and of a row, the bar, the score
    if len(mine) and len(theirs):
        vectors = np.stack(theirs["x"].to_numpy())
        labels, numbers = theirs["label"].to_numpy(), theirs["row"].to_numpy()
        for start in range(0, len(mine), _BLOCK):
            block = mine.iloc[start : start + _BLOCK]
            scores = packed_scores(np.stack(block["x"].to_numpy()), vectors)
            for at, label, number, bars in zip(block.index, block["label"], block["row"], block["bars"], strict=True):
                row = scores[at - start]
                if band is None:
                    places = np.flatnonzero((labels == label) & (numbers != number))
                    found += [(at, place, 0, row[place]) for place in _best(row, places, count)]
                    continue
                low, high = band
                others = np.flatnonzero(labels != label)
                for bar in map(int, bars):
                    scaled = 100 * row[others]
                    places = others[(scaled >= low * bar) & (scaled <= high * bar)]
                    found += [(at, place, bar, row[place]) for place in _best(row, places, count)]
    at = [entry[0] for entry in found]
    place = [entry[1] for entry in found]
    named = mine.loc[at, ["row", "none", "key"]].reset_index(drop=True)
    named["bar"] = np.array([entry[2] for entry in found], dtype=np.int64)
    others = theirs.loc[place, ["row", "none", "key"]].reset_index(drop=True).add_prefix("other_")
    scores = pd.Series(np.array([int(entry[3]) for entry in found], dtype=np.int64), name="score")
    return pd.concat([named, others, scores], axis=1)


def _best(scores: np.ndarray, places: np.ndarray, count: int) -> np.ndarray:
    """The places of the highest scores, of equal ones the first."""
    values = scores[places]
    if len(places) > count:
        least = np.partition(values, len(values) - count)[len(values) - count]
        places = places[values >= least]
        values = scores[places]
    return places[np.argsort(-values, kind="stable")[:count]]
