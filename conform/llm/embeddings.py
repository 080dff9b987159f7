"""Embedding near-dedup by an exact metric range join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.components import connected_components
from conform.llm.forest import least_reachable
from conform.llm.staging import check_columns, staged

#: Added to angles that decide on replication, far above the rounding of a double and far below any real gap.
_SLACK = 1e-9


def near_duplicate_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = 0.9,
    pivots: int = 1_024,
    sample: int = 4_096,
    cell_degrees: float = 35.0,
    tile: int = 8_192,
) -> DataFrame:
    """One row per row of ``df``: id, n_links, component_id and kept.

    Two vectors of the same dimension link if their cosine in double precision reaches ``cosine``. Vectors that are null, empty or zero, or
    have null or infinite components or NaN, link with nothing.

    Equal vectors become one. A vector within ``cell_degrees`` of a pivot belongs to the cell of its nearest pivot, every
    other one to the far cell. Each cell's covering radius R, the largest angle of its vectors to its pivot, is measured. If x links with
    y of cell j, their angle is at most r, so by the triangle inequality x is within R_j + r of pivot j; and as x is nearer to its own
    pivot, it is at most r beyond the boundary between the two. Only where both allow it, x is copied to cell j, vectors of the far cell
    to any cell, others to cells behind their own. So every link is found in one cell, and cells join independently. A
    cell's own vectors and its copies are dealt by hash into tiles, and a task compares one pair of tiles by a matrix product.
    It returns counts of links and the smallest id that each vector reaches inside the pair, never the pairs.

    Pivots come from the ``sample`` vectors of smallest hash: those that have others of them within ``cell_degrees``, one
    for each such neighbourhood and ``pivots`` at most, so there are more of them the more vectors crowd. They decide where
    the work is done, never what is found. Vectors that are alone in all directions cannot be told apart by angles to pivots: the far
    cell compares all pairs of its own, without copies.
    Rows that repeat an id count as vectors of their own, and null ids get no component. An empty table gives an empty one; other
    columns are not touched.
    """
    check_columns(df, id_column, vector_column)
    vectors = df.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    vectors = vectors.withColumn("usable", usable)
    good = vectors.where("usable")
    # 128 bits name a vector, ids may repeat.
    node = F.concat(F.hex(F.xxhash64("vector")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "vector")))
    classes = good.groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = staged(classes.withColumn("node", node), "vectors")
    chosen = classes.orderBy("node").limit(sample).select("vector").collect()
    by_size: dict[int, list] = {}
    for row in chosen:
        by_size.setdefault(len(row.vector), []).append(row.vector)
    tight = math.radians(cell_degrees)
    centres = {size: _crowded(_unit(np.array(rows)), tight, pivots) for size, rows in by_size.items() if size}
    owned = staged(_owned(classes, centres, tight), "cells")
    # One number for each pivot.
    radii = {(r["size"], r["cell"]): r["radius"] for r in owned.groupBy("size", "cell").agg(F.max("angle").alias("radius")).collect()}
    copies = staged(_copied(owned, centres, radii, cosine), "copies")
    placed = owned.select(*copies.columns).unionByName(copies)
    found = staged(_compared(placed, cosine, tile), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(found, "node", "least")
    joined = (
        classes.select("vector", "node", "least", "n")
        .join(counts, "node", "left")
        .join(components, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    joined = staged(joined, "classes")
    # Written, so that a component of very many members is a skewed join that adaptive execution can split.
    names = staged(joined.groupBy("component").agg(F.min("least").alias("component_id")), "names")
    answers = joined.join(names, "component").select(
        "vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    alone = vectors.where(~F.col("usable")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    rows = good.join(answers, "vector").select("id", "n_links", "component_id").unionByName(alone)
    return rows.select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _crowded(rows: np.ndarray, tight: float, count: int) -> np.ndarray:
    """Up to ``count`` of the rows that have another row within ``tight``, none of them within ``tight`` of one before."""
    near = rows @ rows.T >= math.cos(tight)
    chosen, covered = [], near.sum(axis=1) < 2
    for at in np.argsort(-near.sum(axis=1), kind="stable"):
        if not covered[at] and len(chosen) < count:
            chosen.append(int(at))
            covered |= near[at]
    return rows[chosen]


_PLACED = "node string, n long, size int, cell int, own boolean, unit binary"


def _owned(classes: DataFrame, centres: dict[int, np.ndarray], tight: float) -> DataFrame:
    """node, n, size, cell, own, unit (the unit vector in doubles), and the angle to the cell's pivot; cell -1 is the far one."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["vector"].map(len)):
                units = _unit(np.stack(part["vector"].to_numpy()).astype(float))
                pivots = centres.get(size, units[:0])
                cell, angle = np.full(len(part), -1), np.zeros(len(part))
                if len(pivots):
                    products = np.clip(units @ pivots.T, -1, 1)
                    nearest = products.argmax(axis=1)
                    angles = np.arccos(products[np.arange(len(part)), nearest])
                    inside = angles <= tight
                    cell[inside], angle[inside] = nearest[inside], angles[inside]
                yield pd.DataFrame(
                    {
                        "node": part["node"].to_numpy(),
                        "n": part["n"].to_numpy(),
                        "size": size,
                        "cell": cell,
                        "own": True,
                        "unit": [unit.tobytes() for unit in units],
                        "angle": angle,
                    }
                )

    return classes.select("node", "n", "vector").mapInPandas(place, f"{_PLACED}, angle double")


def _copied(
    owned: DataFrame, centres: dict[int, np.ndarray], radii: dict[tuple[int, int], float], cosine: float
) -> DataFrame:
    """The copies of vectors in the cells where a vector of that cell could link with them."""
    radius = math.acos(max(-1.0, min(1.0, cosine)))
    # A pivot nobody belongs to gets no copies.
    reach = {
        size: np.array([radii.get((size, at), -math.inf) for at in range(len(pivots))]) + radius + _SLACK
        for size, pivots in centres.items()
    }

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby("size"):
                pivots = centres.get(size)
                if pivots is None or not len(pivots):
                    continue
                units = np.frombuffer(b"".join(part["unit"]), dtype=float).reshape(len(part), size)
                cell = part["cell"].to_numpy()
                products = np.clip(units @ pivots.T, -1, 1)
                near = (np.arccos(products) <= reach[size]) & (np.arange(len(pivots)) > cell[:, None])
                row, other = np.nonzero(near)
                own = cell[row]
                # The sine of the angle to the plane that halves the way between two pivots; the far cell has no such plane.
                apart = np.linalg.norm(pivots[own] - pivots[other], axis=1)
                gap = products[row, own] - products[row, other]
                beyond = np.arcsin(np.clip(gap / np.maximum(apart, 1e-12), -1, 1))
                kept = (own < 0) | (beyond <= radius + _SLACK)
                row, other = row[kept], other[kept]
                columns = part[["node", "n", "size", "unit"]].iloc[row]
                yield columns.assign(cell=other, own=False)[["node", "n", "size", "cell", "own", "unit"]]

    return owned.mapInPandas(copy, _PLACED)


def _compared(placed: DataFrame, cosine: float, tile: int) -> DataFrame:
    """node, links to other vectors and the least node reached, for each pair of tiles with a link."""
    # At most two rows per pivot and dimension.
    owns, copies = F.count_if("own"), F.count_if(~F.col("own"))
    sizes = placed.groupBy("size", "cell").agg(
        F.ceil(owns / tile).cast("int").alias("owns"), F.ceil(copies / tile).cast("int").alias("copies")
    )
    sizes = F.broadcast(staged(sizes, "tiles"))
    dealt = placed.join(sizes, ["size", "cell"])
    slot = F.when(F.col("own"), F.pmod(F.xxhash64("node"), "owns")).otherwise(
        F.col("owns") + F.pmod(F.xxhash64("node"), "copies")
    )
    dealt = dealt.withColumn("tile", slot.cast("int"))
    # Own tiles meet themselves, the own tiles behind them and all tiles of copies.
    left = dealt.where("own").withColumn("b", F.explode(F.sequence("tile", F.col("owns") + F.col("copies") - 1)))
    right = dealt.where("tile > 0").withColumn(
        "a", F.explode(F.sequence(F.lit(0), F.least(F.col("tile"), F.col("owns")) - 1))
    )
    columns = ["size", "cell", "a", "b", "side", "node", "n", "unit"]
    left = left.withColumn("a", F.col("tile")).withColumn("side", F.lit(0)).select(columns)
    right = right.where("owns > 0").withColumn("b", F.col("tile")).withColumn("side", F.lit(1)).select(columns)

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        units = np.frombuffer(b"".join(rows["unit"]), dtype=float).reshape(len(rows), key[0])
        side, node, n = rows["side"].to_numpy(), rows["node"].to_numpy(), rows["n"].to_numpy()
        first = np.flatnonzero(side == 0)
        second = first if key[2] == key[3] else np.flatnonzero(side == 1)
        links, starts, ends = np.zeros(len(rows), dtype=np.int64), [], []
        for at in range(0, len(first), 512):
            part = first[at : at + 512]
            i, j = np.nonzero(units[part] @ units[second].T >= cosine)
            i, j = part[i], second[j]
            i, j = i[i != j], j[i != j]
            np.add.at(links, i, n[j])
            if key[2] != key[3]:
                np.add.at(links, j, n[i])
            starts.append(i)
            ends.append(j)
        least = least_reachable(len(rows), np.concatenate(starts or [first]), np.concatenate(ends or [first]))
        linked = np.flatnonzero(links)
        return pd.DataFrame({"node": node[linked], "links": links[linked], "least": node[least[linked]]})

    return left.unionByName(right).groupBy("size", "cell", "a", "b").applyInPandas(
        compare, "node string, links long, least string"
    )
