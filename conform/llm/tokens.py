"""Token ids and counts of whole texts."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, pairwise
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conform.llm.staging import check_columns, staged, text_or_empty

#: Parts of words that one Python worker remembers, about 160 bytes each, and bytes of text that it takes apart at once.
REMEMBERED, _BLOCK = 800_000, 1 << 23
#: Chunks of a text that are handed on together.
_PARTS = 64

#: Where the tokens left and right of a place cannot depend on each other: behind white space and beside a digit.
STABLE = re.compile(r"(?<=[\t-\r ])(?=[^\s])|(?<=[0-9])(?=[0-9A-Za-z])|(?<=[A-Za-z])(?=[0-9])")
_SPACE = re.compile(r"[\t-\r ]")


def default_tokenizer() -> str:
    """The vocabulary file for production, from the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def bytes_per_id(path: str, *others: int | None) -> int:
    """2 if all ids of the vocabulary and the other ids fit, else 4."""
    from tokenizers import Tokenizer

    largest = max([Tokenizer.from_file(path).get_vocab_size() - 1, *(other or 0 for other in others)])
    return 2 if largest < 1 << 16 else 4


#: What a vocabulary file says of normalising and splitting where ``STABLE`` and words hold.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of ASCII and the letters of Latin-1, which NFC leaves alone, and ``_SPLIT`` for what remains of these in lower case.
_LETTERS = "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
_PLAIN = r"^[!-~À-ÖØ-öø-ÿ]+$"
_PART = rf"('s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^a-z0-9{_LETTERS}]+)"


def words_apart(tokenizer) -> bool:
    """Whether the tokenizer is known to drop white space, to lower letters and to split as ``STABLE`` says."""
    config = json.loads(tokenizer.to_str())
    splits = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        (config.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
        and len(splits) == 2
        and splits[0].get("pattern") == {"Regex": _SPLIT}
        and (splits[0].get("behavior"), splits[0].get("invert")) == ("Removed", True)
        and (splits[1].get("type"), splits[1].get("add_prefix_space"), splits[1].get("use_regex")) == ("ByteLevel", False, False)
        and config.get("post_processor") is None
        # Special strings are found in the text as it is: they must stay inside a word, and none be or be in one part of words.
        and not any(re.search(r"\s", t["content"]) or t["normalized"] or t["lstrip"] or t["rstrip"] for t in config["added_tokens"])
        and not any("'" in t["content"] or len(re.findall(_PART, t["content"])) < 2 for t in config["added_tokens"])
    )


class WordEncoder:
    """Ids of texts as the library gives them.

    Under a tokenizer that drops white space and never joins what white space separates, a text has the ids of its words
    in turn, and a word those of the parts that the tokenizer splits it into. So Arrow finds the different words of a block of texts,
    words of plain letters are split by the tokenizer's own rule, and each different part is given to the library's model once and
    remembered, up to a bound. All other words go to the library as they are, and so do those that hold a special string, which has
    no white space. ``apart`` tells whether the vocabulary file describes such a tokenizer; under any other, texts are
    encoded as a whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.apart = words_apart(self.tokenizer)
        self.memo: dict[str, bytes] = {}
        self.remembered = remembered
        if self.apart:
            self.model = self.tokenizer.model
            special = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
            self.special = "|".join(special)
            spelled = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.spelling = {ord(letter): spelled(letter)[0][0] for letter in _LETTERS}

    def ids(self, text: str) -> bytes:
        """The ids as unsigned little-endian 32-bit numbers."""
        return next(self.each(pa.array([text], pa.large_string())))

    def each(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each of the texts, none of which is null, as ``ids`` gives them."""
        if not self.apart:
            for text in texts:
                yield self._whole(text.as_py())
            return
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        blocks = np.cumsum(sizes, dtype=np.int64) // _BLOCK
        cuts = (np.flatnonzero(np.diff(blocks)) + 1).tolist()
        for low, high in pairwise([0, *cuts, len(texts)] if len(texts) else []):
            if sizes[low] > _BLOCK:
                yield b"".join(self._block(pa.array([part], pa.large_string()))[0] for part in _cut(texts[low].as_py()))
                low += 1
            yield from self._block(texts.slice(low, high - low))
            # Workers live on: what Arrow keeps of a block would be missing elsewhere.
            pa.default_memory_pool().release_unused()

    def _block(self, texts: pa.Array) -> list[bytes]:
        # Splits at the six characters of _SPACE; the empty words at the ends have no ids.
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        return _joined(split.offsets, self._words(words.dictionary).take(words.indices)).to_pylist()

    def _words(self, words: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(words, _PLAIN)
        if self.special:
            plain = pc.and_not(plain, pc.match_substring_regex(words, self.special))
        apart = pc.ascii_rtrim(pc.replace_substring_regex(pc.utf8_lower(words), _PART, r"\1 "), " ")
        split = pc.split_pattern(pc.if_else(plain, apart, words), " ")
        parts = split.flatten().dictionary_encode()
        known = self._parts(parts.dictionary.to_pylist())
        return _joined(split.offsets, pa.array(known, pa.large_binary()).take(parts.indices))

    def _parts(self, parts: list[str]) -> list[bytes]:
        ids, fresh = list(map(self.memo.get, parts)), {}
        for at, known in enumerate(ids):
            if known is None:
                ids[at] = fresh[parts[at]] = self._part(parts[at])
        self.memo.update(islice(fresh.items(), max(0, self.remembered - len(self.memo))))
        return ids

    def _part(self, part: str) -> bytes:
        """The ids of a part, or of a word that was not taken apart."""
        if not re.fullmatch(_PLAIN, part) or self.special and re.search(self.special, part):
            return self._whole(part)
        tokens = self.model.tokenize(part.translate(self.spelling))
        return pack(f"<{len(tokens)}I", *[token.id for token in tokens])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def _joined(offsets: pa.Array, ids: pa.Array) -> pa.Array:
    """The ids from each offset to the next as one."""
    return pc.binary_join(pa.ListArray.from_arrays(offsets, ids), pa.scalar(b"", pa.large_binary()))


def _cut(text: str) -> Iterator[str]:
    """A long text, cut at white space."""
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + _BLOCK)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


@lru_cache(maxsize=2)
def word_encoder(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    """One encoder per vocabulary and Python worker."""
    return WordEncoder(path, remembered)


def token_pieces(
    df: DataFrame,
    id_column: str,
    text_column: str,
    path: str,
    capacity: int,
    end_id: int | None,
    id_bytes: int = 0,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Every document's ids, then ``end_id``, cut into pieces of ``capacity``; one row per piece.

    id, piece, start, length, ids_crc32 (of 32-bit ids), and ids in little-endian ``id_bytes`` (2 or 4) if asked for; ``part`` and ``place`` number
    the pieces of one length within a task. Only longer documents are cut and nothing is lost; null text is empty, and
    a document without ids gives one piece of length 0 (with an end id there is none). ``remembered`` bounds the parts of words that
    each Python worker keeps with their ids; it changes time and memory only.
    """
    check_columns(df, id_column, text_column)
    kind = df.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length int, ids_crc32 long, part int, place long" + ", ids binary" * bool(id_bytes)
    tail = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, part = word_encoder(path, remembered), {}, TaskContext.get().partitionId()
        for batch in batches:
            rows, held = [], 0
            for number, text_ids in enumerate(encoder.each(batch.column("text"))):
                data = text_ids + tail
                for piece, at in enumerate(range(0, max(len(data), 1), width)):
                    ids = data[at : at + width]
                    length = len(ids) // 4
                    seen[length] = place = seen.get(length, -1) + 1
                    row = number, piece, at // 4, length, zlib.crc32(ids), part, place
                    if id_bytes == 2:
                        ids = np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes()
                    rows.append((*row, ids) if id_bytes else row)
                held += len(data)
                if held > _BLOCK:
                    yield _batch(rows, batch.column("id"))
                    rows, held = [], 0
            if rows:
                yield _batch(rows, batch.column("id"))

    source = df.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    return source.mapInArrow(cut, schema)


#: The columns of a piece behind its id.
_PIECE = {"piece": "int32", "start": "int64", "length": "int32", "ids_crc32": "int64", "part": "int32", "place": "int64", "ids": "binary"}


def _batch(rows: list[tuple], identifiers: pa.Array) -> pa.RecordBatch:
    """Pieces as Arrow has them; a row begins with the place of its document's id among ``identifiers``."""
    numbers, *values = zip(*rows, strict=True)
    columns = {name: pa.array(column, kind) for (name, kind), column in zip(_PIECE.items(), values, strict=False)}
    return pa.RecordBatch.from_pydict({"id": identifiers.take(pa.array(numbers, "int64")), **columns})


def token_counts(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    limit: int = 2048,
    chunk: int = 32_768,
    overlap: int = 256,
) -> DataFrame:
    """One row per row of ``df``: id, n_bytes, n_tokens and over_limit of the whole text.

    A document of up to ``chunk`` code points is encoded at once. Each different longer text is taken once, however many
    rows have it, and cut into chunks that repeat the first ``overlap`` code points of the next; these are encoded in any
    tasks, with offsets. Two neighbours are spliced at the first place of their overlap where no token can span by
    the rule ``STABLE``, if neither encoding has a token across it and both have the same ids from there to the next
    such place; tokens left of it count for the one, tokens right of it for the other. Texts with an overlap that
    shows no such place go round again with eight times the overlap and chunks that are at least as long, at last as a
    whole, so the result never depends on the cut. Counts are joined back to the rows by the text's SHA-256.

    Null text is empty and has no tokens; rows that repeat an id, or id and text, are counted each for itself; an empty
    table gives an empty one, other columns are not touched. Under a vocabulary that does not split as the rule says, texts are encoded as a whole.
    """
    check_columns(df, id_column, text_column)
    path = path or default_tokenizer()
    text = text_or_empty(text_column)
    rows = df.select(F.col(id_column).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = word_encoder(path)
        for batch in texts:
            found = encoder.each(pa.array(batch, pa.large_string()))
            yield pd.Series([len(ids) // 4 for ids in found], dtype="int64")

    long = F.char_length("text") > chunk if word_encoder(path).apart else F.lit(False)
    counted = rows.where(~long).select("id", "n_bytes", count("text").alias("n_tokens"))
    keyed = rows.where(long).withColumn("sha", F.sha2("text", 256))
    # Copies of a text become one in each task before they are shuffled.
    texts = staged(keyed.groupBy("sha").agg(F.first("text").alias("text")), "long-texts")
    pending, known = texts, None
    while not pending.isEmpty():
        spliced = staged(_spliced(pending, path, chunk, overlap), "token-counts")
        done = spliced.where("aligned").select("sha", "n_tokens")
        known = done if known is None else known.unionByName(done)
        pending = texts.join(spliced.where("not aligned").select("sha"), "sha", "left_semi")
        overlap *= 8
        chunk = max(chunk, overlap)
    if known is not None:
        counted = counted.unionByName(keyed.select("id", "n_bytes", "sha").join(known, "sha").drop("sha"))
    over = F.col("n_tokens") > limit
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", over.alias("over_limit"))


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """sha, n_tokens and aligned for different long texts."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for sha, text in zip(batch["sha"], batch["text"], strict=True):
                # What is left for the last chunk must be longer than the overlap before it.
                starts = [at for at in range(0, len(text), chunk) if at == 0 or len(text) - at > overlap]
                ends = [*(at + overlap for at in starts[1:]), len(text)]
                for low in range(0, len(starts), _PARTS):
                    numbers = range(low, min(low + _PARTS, len(starts)))
                    parts = [text[starts[number] : ends[number]] for number in numbers]
                    last = [number == len(starts) - 1 for number in numbers]
                    yield pd.DataFrame({"sha": sha, "at": numbers, "last": last, "part": parts})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = word_encoder(path).tokenizer
        for batch in batches:
            found = []
            for part, at, last in zip(batch["part"], batch["at"], batch["last"], strict=True):
                encoding = tokenizer.encode(part, add_special_tokens=False)
                if at == 0 and last:  # the whole text
                    found.append((len(encoding), 0, 0, True))
                    continue
                spans = np.array(encoding.offsets, dtype=np.int64).reshape(-1, 2)
                ids = np.array(encoding.ids, dtype="<u4")
                begin, head = (0, 0) if at == 0 else _splice(part, 0, overlap, spans, ids)
                end, tail = (len(part), 0) if last else _splice(part, len(part) - overlap, len(part), spans, ids)
                aligned = begin is not None and end is not None and begin <= end
                inside = (spans[:, 0] >= begin) & (spans[:, 0] < end) if aligned else np.zeros(0)
                found.append((int(inside.sum()), head, tail, aligned))
            counts = pd.DataFrame(found, columns=["n", "head", "tail", "aligned"], index=batch.index)
            yield pd.concat([batch[["sha", "at"]], counts], axis=1)

    # Chunks take their time by the CPU, not by their bytes: the number of tasks is given, so that adaptive execution
    # does not pack them into a few. Which task a chunk goes to is the same whenever one is repeated.
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = texts.select("sha", "text").mapInPandas(cut, "sha string, at int, last boolean, part string")
    encoded = chunks.repartition(tasks, "sha", "at").mapInPandas(
        encode, "sha string, at int, n long, head long, tail long, aligned boolean"
    )
    # The ids behind a splice, seen from its two sides: chunk ``at`` has the splice at its head, the one before at its
    # tail. A text's chunks, a few numbers each, are compared with their neighbours in turn.
    before = F.lag("tail").over(Window.partitionBy("sha").orderBy("at"))
    compared = encoded.withColumn("met", F.col("aligned") & ((F.col("at") == 0) | (F.col("head") == before)))
    return compared.groupBy("sha").agg(F.sum("n").alias("n_tokens"), F.min("met").alias("aligned"))


def _splice(part: str, low: int, high: int, spans: np.ndarray, ids: np.ndarray) -> tuple[int | None, int]:
    """The first stable place of ``part[low:high]`` and a checksum of the ids up to the second; None if there aren't two."""
    region = part[low:high]
    places = STABLE.finditer(region)
    pair = [match.start() + low for match, _ in zip(places, range(2), strict=False)]
    if len(pair) < 2:
        return None, 0
    first, second = pair
    across = (spans[:, 0] < first) & (spans[:, 1] > first) | (spans[:, 0] < second) & (spans[:, 1] > second)
    if across.any():
        return None, 0
    return first, zlib.crc32(ids[(spans[:, 0] >= first) & (spans[:, 0] < second)].tobytes())
