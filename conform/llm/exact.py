"""Exact dedup by content-defined chunk recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.llm.staging import BLANKS, check_columns, row_hash, staged, text_or_empty

#: Rows of one group that one task joins, about.
_SLICE = 1_000_000


def normalised(text: str | Column) -> Column:
    """The text without white space; null is empty."""
    return F.regexp_replace(text_or_empty(text), f"[{BLANKS}]+", "")


def chunks_of(text: Column, shortest: int, longest: int) -> Column:
    """The text cut where its content says so: behind the first punctuation mark after ``shortest`` code points,
    after ``longest`` at the latest. An insertion changes the chunks around it; later cuts fall into place again."""
    pattern = rf"(?s).{{{shortest},{longest - 1}}}?\p{{P}}|.{{{longest}}}|.+"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def exact_duplicates(
    df: DataFrame, id_column: str, text_column: str, shortest: int = 512, longest: int = 4096
) -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256 of the normalised text and n_points.

    Every text becomes a recipe: the ordered identifiers of its chunks. An identifier is the 64-bit hash of the chunk
    and, where the dictionary of all distinct chunks shows that chunks of different text share a hash, the chunk's
    place among them; so equal identifiers mean equal chunks, and equal recipes equal texts. The dictionary is the
    only place to which text moves, each distinct chunk once per task; groups are found on the recipes. Copies,
    however many, are combined before the shuffle, and the join back to the documents moves only recipes. There a
    group is cut into slices of its documents, and its row is repeated for those slices that it has, so that a group
    may hold any part of all rows. Repeated rows are combined for each part of the input alone and slices are cut by that
    part too, so no task repeats more of them than one part had.

    Null text counts as empty and all empty texts are one group. Of a group, the longest original text stays, then
    the smallest id (null ids come last); of rows that agree in all of that, one is marked as kept. Other columns are
    not touched.
    """
    check_columns(df, id_column, text_column)
    chunked = df.select(*_described(id_column, text_column), normalised(text_column).alias("plain")).select(
        "id",
        "points",
        "part",
        F.sha2("plain", 256).alias("sha"),
        chunks_of(F.col("plain"), shortest, longest).alias("chunks"),
    )
    shared = _shared_hashes(chunked)
    if shared is None:
        recipe = F.transform("chunks", lambda chunk: F.xxhash64(chunk))
        documents = chunked.groupBy("id", "points", "sha", "part", recipe.alias("recipe")).agg(F.count("*").alias("copies"))
    else:
        documents = _numbered(chunked, shared)
    documents = staged(documents, "recipes")
    # A slice of a group has about _SLICE rows at most; the count comes from the footers of the files.
    slices = F.lit(max(32, documents.count() // _SLICE))
    documents = documents.withColumn("slice", F.pmod(F.xxhash64("id", "sha", "part"), slices).cast("int"))
    described = F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("none"), "id", "part")
    parts = documents.groupBy("recipe", "slice").agg(F.min(described).alias("best"), F.sum("copies").alias("rows"))
    groups = parts.groupBy("recipe").agg(
        F.min("best").alias("best"), F.sum("rows").alias("group_size"), F.collect_list("slice").alias("slices")
    )
    groups = groups.withColumn("slice", F.explode("slices")).drop("slices")
    best = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("points") == -F.col("best.less"))
    best = best & (F.col("part") == F.col("best.part"))
    return (
        documents.join(groups, ["recipe", "slice"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            F.col("id").alias(id_column),
            F.col("best.id").alias("keep_id"),
            "group_size",
            (best & (F.col("copy") == 1)).alias("kept"),
            F.col("sha").alias("text_sha256"),
            F.col("points").alias("n_points"),
        )
    )


def without_exact_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` that ``exact_duplicates`` keeps, with all their columns: one of each group of equal texts.

    Where rows agree in id, length and text without white space, but not in everything, the one of smallest hash over
    all columns stays, so that reruns agree.
    """
    kept = exact_duplicates(df, id_column, text_column).where("kept").select(
        _key(F.col(id_column), F.col("n_points"), F.col("text_sha256")).alias("__row")
    )
    sha = F.sha2(normalised(text_column), 256)
    points = F.char_length(text_or_empty(text_column)).cast("long")
    keyed = df.select(
        _key(F.col(id_column), points, sha).alias("__row"), row_hash(df).alias("__hash"), F.struct("*").alias("__whole")
    )
    # The join has put rows of one key side by side already.
    left = keyed.join(kept, "__row", "left_semi").groupBy("__row").agg(F.min_by("__whole", "__hash").alias("__whole"))
    return left.select("__whole.*")


def _described(id_column: str, text_column: str) -> list[Column]:
    points = F.char_length(text_or_empty(text_column)).cast("long")
    return [F.col(id_column).alias("id"), points.alias("points"), F.spark_partition_id().alias("part")]


def _key(identifier: Column, points: Column, sha: Column) -> Column:
    # concat_ws leaves nulls out: without an id there is no second colon.
    return F.concat_ws(":", sha, points.cast("string"), identifier.cast("string"))


def _shared_hashes(chunked: DataFrame) -> DataFrame | None:
    """The distinct chunks whose hash another chunk has too, each with its place; None if there are none."""
    dictionary = (
        chunked.select(F.explode("chunks").alias("chunk")).select(F.xxhash64("chunk").alias("hash"), "chunk").distinct()
    )
    shared = staged(dictionary.groupBy("hash").agg(F.count("*").alias("texts")).where("texts > 1"), "chunk-hashes")
    if shared.isEmpty():
        return None
    numbered = dictionary.join(shared.select("hash"), "hash").groupBy("hash")
    places = numbered.agg(F.sort_array(F.collect_list("chunk")).alias("chunks"))
    return staged(places.select("hash", F.posexplode("chunks").alias("place", "chunk")), "shared-chunks")


def _numbered(chunked: DataFrame, shared: DataFrame) -> DataFrame:
    """Documents with recipes of hashes and places, for the rare case of different chunks with one hash."""
    row = ["id", "points", "sha", "part"]
    parts = chunked.select(*row, F.posexplode_outer("chunks").alias("at", "chunk"))
    parts = parts.withColumn("hash", F.xxhash64("chunk")).join(shared, ["hash", "chunk"], "left")
    place = F.coalesce(F.col("place"), F.lit(0)).cast("long")
    parts = parts.groupBy(*row, "at", "hash", place.alias("place")).agg(F.count("*").alias("copies"))
    listed = F.when(F.col("at").isNotNull(), F.struct("at", "hash", "place"))
    recipe = F.transform(F.sort_array(F.collect_list(listed)), lambda part: F.array(part["hash"], part["place"]))
    return parts.groupBy(*row).agg(F.flatten(recipe).alias("recipe"), F.max("copies").alias("copies"))
