"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm import (
    embeddings,
    exact,
    html,
    language,
    matrices,
    mixing,
    negatives,
    pieces,
    revisits,
    simhash,
    tokens,
    whitening,
)
from conform.sources.workspace import new_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(_table(spark, folder, "embeddings"))


def op2_token_matrices(spark: SparkSession, folder: str) -> DataFrame:
    """The matrices are written to the shared folder; checksums stand for them here."""
    place = new_folder(spark, "matrices")
    matrices.write_matrices(_table(spark, folder, "documents"), place)
    return spark.read.parquet(place).select(
        "sequence_id",
        "n_tokens",
        F.size("documents").alias("n_segments"),
        F.crc32("input_ids").alias("ids_crc32"),
        "cumulative_lengths",
        "position_resets",
        F.transform("documents", lambda part: part["doc_id"]).alias("doc_ids"),
    )


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, folder, "documents"), "doc_id", "text")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mixed(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_texts(_table(spark, folder, "pages"))


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return matrices.packed_documents(_table(spark, folder, "documents"))


def op7_revisits(spark: SparkSession, folder: str) -> DataFrame:
    resolved = revisits.resolve_revisits(revisits.captures(_table(spark, folder, "pages")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return resolved.withColumn("headers", F.array_join(entries, ";"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(_table(spark, folder, "documents"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    found = language.predicted(documents, language.learn(documents))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_vectors(_table(spark, folder, "embeddings"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every hundredth row is an anchor; some labels are moved on, as the contract says."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Checksums stand for the ids and the text they give."""
    found = pieces.encoded_documents(_table(spark, folder, "documents"))
    decimal = F.array_join(F.transform("ids", lambda each: each.cast("string")), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_token_matrices": op2_token_matrices,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_mixing": op4_mixing,
    "op5_main_text": op5_main_text,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_revisits": op7_revisits,
    "op8_simhash": op8_simhash,
    "op9_token_counts": op9_token_counts,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sentence_pieces": op13_sentence_pieces,
}
