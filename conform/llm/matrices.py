"""Packed matrices of token ids for training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.packing import best_fit_decreasing, linear_grouping, packed
from conform.llm.staging import staged
from conform.llm.tokens import REMEMBERED, bytes_per_id, default_tokenizer, token_pieces


def packed_documents(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    capacity: int = 4096,
    end_id: int | None = 1,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece of a document: id, piece, start, length, ids_crc32, sequence_id and offset.

    Every document's ids and an end id are cut into pieces of ``capacity``, and the pieces packed by linear grouping.
    Rows that repeat an id are packed each for itself; other columns are not touched. Null text counts as empty, an empty
    table gives an empty result, and ties of length are packed in any order. ``remembered`` bounds the parts of words that each Python
    worker keeps with their ids: fewer where it shares an executor's memory with other work.
    """
    pieces = token_pieces(
        df, id_column, text_column, path or default_tokenizer(), capacity, end_id, remembered=remembered
    )
    rows = packed(staged(pieces, "pieces"), capacity, linear_grouping)
    return rows.select(
        F.col("id").alias(id_column),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )


def write_matrices(
    df: DataFrame,
    folder: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    capacity: int = 4096,
    end_id: int | None = 1,
    pad_id: int = 0,
) -> None:
    """Best-fit-decreasing packing, written to ``folder`` as Parquet with one row per sequence.

    sequence_id; input_ids, exactly ``capacity`` little-endian unsigned ids of 16 bits, or 32 for vocabularies that need them,
    padded at the end; n_tokens without
    padding; cumulative_lengths, from 0 to n_tokens; position_resets, the offsets at which positions start from 0 again
    (the padding's included); and documents, the id, piece and start of each segment. So every document can be put
    together again. Longer documents are cut without loss; documents without any id (null and empty texts when there is
    no end id) are in no sequence. The ids move once, to their sequence, which holds ``capacity`` of them at most.
    """
    path = path or default_tokenizer()
    width = bytes_per_id(path, end_id, pad_id)
    pieces = token_pieces(df, id_column, text_column, path, capacity, end_id, width)
    rows = packed(staged(pieces, "pieces", "zstd"), capacity, best_fit_decreasing).where("length > 0")
    segments = F.sort_array(F.collect_list(F.struct("offset", "length", "id", "piece", "start", "ids")))
    joined = F.aggregate("segments", F.lit(b""), lambda so_far, segment: F.concat(so_far, segment["ids"]))
    lengths = F.sum("length").cast("int")
    sequences = rows.groupBy("sequence_id").agg(lengths.alias("n_tokens"), segments.alias("segments"))
    ends = F.transform("segments", lambda segment: (segment["offset"] + segment["length"]).cast("int"))
    resets = F.transform("segments", lambda segment: segment["offset"].cast("int"))
    padding = F.when(F.col("n_tokens") < capacity, F.array("n_tokens")).otherwise(F.array().cast("array<int>"))
    pad = pad_id.to_bytes(width, "little") * capacity
    padded = F.substring(F.concat(joined, F.lit(pad)), 1, width * capacity)
    sequences.select(
        "sequence_id",
        padded.alias("input_ids"),
        "n_tokens",
        F.concat(F.array(F.lit(0)), ends).alias("cumulative_lengths"),
        F.concat(resets, padding).alias("position_resets"),
        F.transform(
            "segments",
            lambda segment: F.struct(
                segment["id"].alias(id_column), segment["piece"].alias("piece"), segment["start"].alias("start")
            ),
        ).alias("documents"),
    ).write.parquet(folder, compression="zstd")
