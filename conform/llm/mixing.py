"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conform.llm.staging import BLANKS, check_columns, row_hash, staged, text_or_empty
from conform.operators.keys import gapless_key

#: Hexadecimal digits of the hash that one histogram resolves.
_DIGITS = 3


def word_count(text: str | Column) -> Column:
    """Runs of anything but white space; null has none."""
    return F.regexp_count(text_or_empty(text), F.lit(f"[^{BLANKS}]+")).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: the water level of all sources.

    ``sizes`` has one row per source. In code point order, null last, sources get the weights in turn. A target is
    ``level * weight``, cut at ``most * source_size``, with the level at which the targets sum up to ``share`` of all
    sizes: what handing on the excess by weight again and again ends in. In the order of size per weight the sources that are cut
    come first, so the level follows from running sums over the sources, a few numbers each.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double")).withColumn(
        "cap", F.col("source_size") * most
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    levelled = weighed.withColumn("level", left / F.sum("weight").over(onward))
    # The first source that reaches its share of what the ones before leave sets the level; later ones would set a lower one.
    uncut = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    first = F.max(uncut).over(everything)
    return levelled.select(
        "source", "source_size", F.least(F.coalesce(F.col("weight") * first, F.col("cap")), F.col("cap")).alias("target")
    )


def mixed(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of ``df``: id, size in words, source_size, target of its source, copies and taken words.

    A document is taken 0 to ``most`` times. Each source goes through its documents in the order of a hash of id and text,
    round after round, until its target is used up; the last document is taken if that brings the sum nearer. Which
    documents come before the budget's end is found without sorting: words are summed by source and hash bucket, whole
    buckets below the threshold are in, those above are out, and only the bucket at the threshold is looked at
    with the next digits of the hash, until all rows in it have one hash. A source's documents are spread over its buckets
    in every shuffle and summed before it, so a source may hold any part of all rows.

    Rows of one hash are copies in id and text; of the copies at the threshold as many are taken as bring the sum
    nearest, whichever, since they are alike. Null text has size 0 and hashes like empty text, null sources are a source
    of their own, and a null id hashes like the text ``null``. Other columns are not touched; an empty input gives an
    empty result.
    """
    check_columns(df, id_column, text_column, source_column)
    sized = df.select(
        F.col(id_column).alias("id"),
        F.struct(F.col(source_column).alias("source")).alias("source"),
        word_count(text_column).alias("size"),
        _order(id_column, text_column, seed).alias("hash"),
    )
    rows = None
    for part, split in _decisions(staged(sized, "sizes"), weights, share, most):
        if split:
            part = _numbered(part, ["source"]).withColumn("extra", F.col("number") <= F.col("extra"))
        part = part.select("id", "source", "size", F.col("extra").cast("int").alias("extra"), "plan")
        rows = part if rows is None else rows.unionByName(part)
    copies = F.col("plan.rounds") + F.col("extra")
    return rows.select(
        F.col("id").alias(id_column),
        F.col("source.source").alias("source"),
        "size",
        "plan.source_size",
        "plan.target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def _order(id_column: str, text_column: str, seed: str) -> Column:
    identifier = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", F.lit(seed), identifier, F.md5(text_or_empty(text_column).cast("binary"))))


def _decisions(
    sized: DataFrame, weights: Sequence[int], share: float, most: float
) -> Iterator[tuple[DataFrame, bool]]:
    """``sized`` (source, size, hash and others) in parts, with ``plan`` and ``extra``, what comes on top of whole rounds.

    ``extra`` is 1 or 0; in parts that come with True it is the number of rows that are taken of their source's in that part,
    which share one hash.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Whole rounds through the source, and the words of the round that the target cuts off.
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sizes = sizes.withColumn("source", F.col("source.source"))
    plan = source_targets(sizes, weights, share, most).withColumn("rounds", F.least(rounds, F.lit(most)).cast("int"))
    plan = plan.withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size"))
    plan = staged(plan.withColumn("source", F.struct("source")), "targets")
    edge = plan.select("source", "budget", F.struct("rounds", "source_size", "target").alias("plan"))
    columns, open_rows, digits = sized.columns, sized, 0
    while True:
        digits += _DIGITS
        open_rows = open_rows.withColumn("bucket", F.substring("hash", 1, digits))
        buckets = staged(_decided(open_rows, edge), "buckets")
        known = open_rows.join(buckets.drop("budget"), ["source", "bucket"])
        yield known.where("state = 'whole'").select(*columns, "extra", "plan"), False
        # At most one bucket of each source is cut by its threshold.
        states = {row["state"] for row in buckets.where("state <> 'whole'").select("state").distinct().collect()}
        if "split" in states:
            yield known.where("state = 'split'").select(*columns, "extra", "plan"), True
        if "open" not in states:
            return
        edge = buckets.where("state = 'open'").select("source", "budget", "plan")
        open_rows = staged(known.where("state = 'open'").select(*columns), "boundary")


def _decided(rows: DataFrame, edge: DataFrame) -> DataFrame:
    """For each source and bucket its ``state``: ``whole``, with ``extra`` 1 below the threshold and 0 above; ``split`` at it, if all
    rows have one hash, with ``extra`` of them taken; or ``open``, with the budget left. The source's plan goes along, so
    that no row has to meet it again."""
    sums = rows.groupBy("source", "bucket").agg(
        F.sum("size").alias("words"), F.count("*").alias("rows"), (F.min("hash") == F.max("hash")).alias("alike")
    )
    before = F.coalesce(
        F.sum("words").over(
            Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    left = F.col("budget") - before
    summed = sums.join(edge, "source").withColumn("left", left)
    # Copy after copy is taken while that brings the sum nearer to the budget.
    nearest = F.floor(F.try_divide(F.col("left") * F.col("rows"), F.col("words")) + 0.5).cast("long")
    taken = F.when(F.col("left") <= 0, 0).when(F.col("words") <= F.col("left"), F.col("rows"))
    taken = taken.when(F.col("alike"), F.least(nearest, F.col("rows")))
    state = F.when(F.col("taken").isNull(), "open").when(F.col("taken").isin(0, F.col("rows")), "whole").otherwise("split")
    counted = summed.withColumn("taken", taken).withColumn("state", state)
    extra = F.when(F.col("state") == "whole", (F.col("taken") > 0).cast("long")).otherwise(F.col("taken"))
    return counted.select("source", "bucket", "state", extra.alias("extra"), F.col("left").alias("budget"), "plan")


def _numbered(rows: DataFrame, group: list[str]) -> DataFrame:
    """The rows with ``number``, from 1 within each group by the hash over all columns, however large a group is."""
    hashed = staged(rows.withColumn("__all", row_hash(rows)), "copies")
    counted = hashed.transform(gapless_key, [*group, "__all"], "__place", tie_break=[], key_type="bigint")
    counted = staged(counted, "places")
    first = counted.groupBy(*group).agg(F.min("__place").alias("__first"))
    found = counted.join(first, group)
    return found.withColumn("number", F.col("__place") - F.col("__first") + 1).drop("__place", "__first", "__all")


def mixed_rows(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """The rows of ``df`` as often as ``mixed`` takes them, with all their columns.

    Of copies in id and text that are taken unevenly, those of smallest hash over all columns come first, so reruns agree.
    Texts move once, to meet the decision on their hash; the copies that are told apart move again.
    """
    check_columns(df, id_column, text_column, source_column)
    # A struct equals another with nulls in the same places.
    source, order = F.struct(F.col(source_column).alias("source")).alias("source"), _order(id_column, text_column, seed).alias("hash")
    sized = df.select(source, word_count(text_column).alias("size"), order)
    whole, split = None, False
    for part, cut in _decisions(staged(sized, "sizes"), weights, share, most):
        extra = F.col("extra").cast("int")
        copies, more = (F.col("plan.rounds"), F.col("extra")) if cut else (F.col("plan.rounds") + extra, F.lit(0).cast("long"))
        part = part.groupBy("source", "hash").agg(F.max(copies).alias("__copies"), F.max(more).alias("__more"))
        part = part.where("__copies + __more > 0")
        whole = part if whole is None else whole.unionByName(part)
        split = split or cut
    counts = staged(whole.select(F.struct("source", "hash").alias("__row"), "__copies", "__more"), "taken")
    met = df.withColumn("__row", F.struct(source, order)).join(counts, "__row")
    if split:
        met = staged(met, "met")
        told = _numbered(met.where("__more > 0"), ["__row"])
        told = told.withColumn("__copies", F.col("__copies") + (F.col("number") <= F.col("__more")).cast("int"))
        met = met.where("__more = 0").unionByName(told.drop("number")).where("__copies > 0")
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*df.columns)
