"""Language of whole texts by prediction by partial matching."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conform.llm.staging import check_columns, staged, text_or_empty

#: Bytes scored at once.
_BLOCK = 1 << 16

#: Orders up to this one have a table over all contexts; higher ones only the contexts that occur.
_DENSE = 2


class Numbers:
    """Places of known numbers: a table at least four times as large, in which a number stands at or behind its hash."""

    def __init__(self, known: np.ndarray):
        self.shift = np.uint64(64 - max(6, int(4 * len(known)).bit_length()))
        self.keys = np.full(1 << int(64 - self.shift), -1, dtype=np.int64)
        self.places = np.full(len(self.keys), -1, dtype=np.int32)
        left, slot = np.arange(len(known)), self._slots(known)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = known[left[free]]  # of several for one slot, the last stays
            put = self.keys[slot] == known[left]
            self.places[slot[put]] = left[put]
            left, slot = left[~put], (slot[~put] + 1) & (len(self.keys) - 1)

    def _slots(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each number wanted, -1 where it is unknown."""
        slot = self._slots(wanted)
        key = self.keys[slot]
        places = np.where(key == wanted, self.places[slot], -1)
        left = np.flatnonzero((key != wanted) & (key >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            key = self.keys[slot[left]]
            hit = key == wanted[left]
            places[left[hit]] = self.places[slot[left[hit]]]
            left = left[~hit & (key >= 0)]
        return places


@dataclass
class ContextTrees:
    """Frozen code lengths in bits under every language's tree.

    ``codes`` maps bytes to the letters of an alphabet of ``size``, the last of which stands for all bytes unseen. ``dense``
    has, for a context of two letters and the next one, the code length in each language. For each order above,
    ``grams`` has the numbers of context and letter that some language has seen, ``costs`` their code lengths,
    ``contexts`` the numbers of contexts and ``escapes`` what it costs there to go down an order.
    """

    languages: list[str]
    codes: np.ndarray
    size: int
    dense: np.ndarray
    grams: list[Numbers]
    costs: list[np.ndarray]
    contexts: list[Numbers]
    escapes: list[np.ndarray]

    def bits(self, data: np.ndarray, first: int = 0) -> np.ndarray:
        """For each byte from ``first`` on, its code length in each language."""
        letters = self.codes[data]
        n = len(letters)
        padded = np.concatenate([np.full(_DENSE + len(self.grams), self.size - 1), letters])
        number = np.zeros(n, dtype=np.int64)
        highest = _DENSE + len(self.grams)
        for back in range(_DENSE, -1, -1):
            number = number * self.size + padded[highest - back : highest - back + n]
        found = self.dense[number[first:]]
        power = self.size ** (_DENSE + 1)
        for order, grams, costs, contexts, escapes in zip(
            range(_DENSE + 1, highest + 1), self.grams, self.costs, self.contexts, self.escapes, strict=True
        ):
            number = number + padded[highest - order : highest - order + n] * power
            power *= self.size
            gram = number[first:]
            at = grams.find(gram)
            seen = at >= 0
            missed = np.flatnonzero(~seen)
            context = contexts.find(gram[missed] // self.size)
            known = context >= 0
            found[missed[known]] += escapes[context[known]]
            found[seen] = costs[at[seen]]
        return found


def held_out(id_column: str) -> Column:
    """Documents kept from learning: the checksum of the id leaves 2 when divided by 4. A null id is held out of nothing."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    order: int = 3,
    rows_per_language: int = 600,
) -> ContextTrees | None:
    """Context trees of each language, from a bounded sample of labelled rows; None if there are none.

    The sample has, of each language, the ``rows_per_language`` rows of smallest hash outside the held-out fold, with
    their whole texts. Spark picks them by ids and labels alone and counts their contexts; what reaches the driver is
    bounded by the sample. There are as many languages as there are labels, so their row counts are a small table: from
    a language's count follows which hashes can be among the smallest, and only those rows are ranked. Null ids and ids that
    repeat share a hash; of their rows those with the smallest hash of the text come first, and never more than asked for.
    Null texts count as empty, an empty table or one without labels has no trees.
    """
    sample = sampled(df, id_column, text_column, language_column, rows_per_language)
    if sample is None:
        return None

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                data = _bytes(text)
                for k in range(1, order + 2):
                    if len(data) >= k:
                        windows = np.zeros(len(data) - k + 1, dtype=np.int64)
                        for back in range(k):
                            windows = windows * 256 + data[back : len(data) - k + 1 + back]
                        gram, n = np.unique(windows, return_counts=True)
                        yield pd.DataFrame({"lang": lang, "k": k, "gram": gram, "n": n})

    counted = sample.mapInPandas(grams, "lang string, k int, gram long, n long")
    counts = staged(counted.groupBy("lang", "k", "gram").agg(F.sum("n").alias("n")), "contexts").toPandas()
    return _frozen(counts, order) if len(counts) else None


def sampled(df: DataFrame, id_column: str, text_column: str, language_column: str, rows: int) -> DataFrame | None:
    """lang and text of the rows to learn from, at most ``rows`` of each label; None without labels."""
    check_columns(df, id_column, text_column, language_column)
    labelled = df.where(F.col(language_column).isNotNull() & ~held_out(id_column))
    place = F.xxhash64(F.col(id_column), F.lit("sample"))
    ids = labelled.select(F.col(language_column).alias("lang"), place.alias("place"))
    last = _last_places(ids, rows)
    if not last:
        return None
    bounds = df.sparkSession.createDataFrame(last, "lang string, last long")
    texts = labelled.select(F.col(language_column).alias("lang"), place.alias("place"), text_or_empty(text_column).alias("text"))
    sample = texts.join(F.broadcast(bounds), "lang").where("place <= last")
    # Rows that share an id share its hash: they are told apart by their texts, and no more than asked for are taken.
    first = Window.partitionBy("lang").orderBy("place", F.xxhash64("text"))
    sample = sample.withColumn("number", F.row_number().over(first)).where(F.col("number") <= rows)
    return sample.select("lang", "text")


def _last_places(ids: DataFrame, rows: int) -> list:
    """For each language the hash of its ``rows``-th row by hash, or of its last one.

    Hashes are spread evenly, so the part of them that holds four times as many rows is ranked. Where ids repeat so
    often that it holds fewer than asked for, that language is ranked again with a part four times as large.
    """
    counts = ids.groupBy("lang").agg(F.count("*").alias("all")).collect()
    by_place = Window.partitionBy("lang").orderBy("place")
    parts = {row["lang"]: 4.0 * rows / row["all"] for row in counts}
    totals = {row["lang"]: row["all"] for row in counts}
    found = []
    while parts:
        limits = [(lang, int(min(part, 1.0) * (2**64 - 1)) - 2**63) for lang, part in parts.items()]
        limits = [(lang, min(limit, 2**63 - 1)) for lang, limit in limits]
        table = F.broadcast(ids.sparkSession.createDataFrame(limits, "lang string, limit long"))
        near = ids.join(table, "lang").where("place <= limit").drop("limit")
        chosen = near.withColumn("n", F.row_number().over(by_place)).where(F.col("n") <= rows)
        ranked = chosen.groupBy("lang").agg(F.max("place").alias("last"), F.count("*").alias("n")).collect()
        whole = [row for row in ranked if row["n"] >= min(rows, totals[row["lang"]])]
        found += [(row["lang"], row["last"]) for row in whole]
        done = {row["lang"] for row in whole}
        parts = {lang: part * 4 for lang, part in parts.items() if lang not in done}
    return found


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)


def _frozen(counts: pd.DataFrame, order: int) -> ContextTrees:
    languages = sorted(counts["lang"].unique())
    seen = np.unique(counts.loc[counts["k"] == 1, "gram"].to_numpy())
    size = len(seen) + 1
    codes = np.full(256, size - 1, dtype=np.int64)
    codes[seen] = np.arange(len(seen))
    # Order by order, the cost of a letter behind a context: seen there, or an escape and the cost one order below.
    lower = np.full((size, len(languages)), 8.0)
    dense = lower
    grams, costs, contexts, escapes = [], [], [], []
    for k in range(1, order + 2):
        part = counts[counts["k"] == k]
        raw = part["gram"].to_numpy()
        gram = np.zeros(len(raw), dtype=np.int64)
        for back in range(k - 1, -1, -1):
            gram = gram * size + codes[(raw >> (8 * back)) & 255]
        language = np.searchsorted(languages, part["lang"].to_numpy())
        n = part["n"].to_numpy(dtype=float)
        context, at = np.unique(gram // size, return_inverse=True)
        total = np.zeros((len(context), len(languages)))
        kinds = np.zeros_like(total)
        np.add.at(total, (at, language), n)
        np.add.at(kinds, (at, language), 1.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
        known, slot = np.unique(gram, return_inverse=True)
        if k <= _DENSE + 1:
            everywhere = np.zeros((size ** (k - 1), len(languages)), dtype=float)
            everywhere[context] = escape
            below = dense if k == 1 else np.tile(dense, (size, 1))
            dense = below.reshape(size ** (k - 1), size, -1) + everywhere[:, None, :]
            dense = dense.reshape(size**k, -1)
            dense[gram, language] = np.log2((total + kinds)[at, language] / n)
            continue
        tree = ContextTrees(languages, codes, size, dense, grams, costs, contexts, escapes)
        cost = _lower_costs(tree, known, k) + escape[np.searchsorted(context, known // size)]
        cost[slot, language] = np.log2((total + kinds)[at, language] / n)
        grams, costs = [*grams, Numbers(known)], [*costs, cost]
        contexts, escapes = [*contexts, Numbers(context)], [*escapes, escape]
    return ContextTrees(languages, codes, size, dense, grams, costs, contexts, escapes)


def _lower_costs(tree: ContextTrees, grams: np.ndarray, k: int) -> np.ndarray:
    """The costs of grams of ``k`` letters without the first one."""
    number = grams % tree.size ** (_DENSE + 1)
    found = tree.dense[number].astype(float)
    for i in range(len(tree.grams)):
        number = grams % tree.size ** (_DENSE + 2 + i)
        at = tree.grams[i].find(number)
        missed = np.flatnonzero(at < 0)
        context = tree.contexts[i].find(number[missed] // tree.size)
        found[missed[context >= 0]] += tree.escapes[i][context[context >= 0]]
        found[at >= 0] = tree.costs[i][at[at >= 0]]
    return found


def code_lengths(trees: ContextTrees, text: str) -> np.ndarray:
    """Bits of the whole text in each language."""
    total = np.zeros(len(trees.languages))
    data = _bytes(text)
    overlap = _DENSE + len(trees.grams)
    for start in range(0, len(data), _BLOCK):
        low = max(0, start - overlap)
        bits = trees.bits(data[low : start + _BLOCK], start - low)
        total += np.ones(len(bits)) @ bits
    return total


def predicted(
    df: DataFrame,
    trees: ContextTrees | None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``df`` with held_out, lang_pred and score in place of columns of these names.

    A text's language is the one whose tree gives it the shortest code, the first by name of equals. Each byte is coded
    behind its longest context the tree has seen; where it has never followed, it escapes to shorter ones, at last to
    eight bits. ``score`` is the share of that language if every language is as likely beforehand.
    ``und`` with score 0 stands for null and empty texts, for texts without a letter, and for everything if there was nothing to learn from.
    """
    check_columns(df, id_column, text_column)
    kept = [name for name in df.columns if name not in ("held_out", "lang_pred", "score")]
    broadcast = df.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("lang_pred string, score double")
    def best(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = broadcast.value
        for batch in texts:
            yield pd.DataFrame([_best(known, text) for text in batch], columns=["lang_pred", "score"])

    return df.select(
        *kept, held_out(id_column).alias("held_out"), best(text_or_empty(text_column)).alias("__best")
    ).select(*kept, "held_out", "__best.*")


def _best(trees: ContextTrees | None, text: str) -> tuple[str, float]:
    if trees is None or not any(map(str.isalpha, text)):
        return "und", 0.0
    bits = code_lengths(trees, text)
    least = int(bits.argmin())
    return trees.languages[least], float(1 / np.exp2(np.maximum(bits[least] - bits, -1000.0)).sum())
