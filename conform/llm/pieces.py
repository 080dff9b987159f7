"""SentencePiece encoding by a table of each prefix's last token, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.llm.staging import check_columns, text_or_empty

#: Code points taken apart at once, ids decoded at once, and prefixes kept before their tokens are recovered.
_BLOCK, _IDS, _PREFIXES = 1 << 20, 1 << 18, 1 << 14
#: Words that one Python worker remembers, the longest of them, and pairs of tokens whose test it remembers.
_MEMO, _LONGEST, _PAIRS = 400_000, 48, 250_000
#: Rows whose results leave a worker together.
_ROWS = 512

_SPACE, _LETTER = "▁", r"[^\W\d_]"


def default_model() -> str:
    """The vocabulary file for production, from the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder:
    """Ids of texts under a SentencePiece vocabulary of merge type, and texts of ids.

    Merging takes the pair of best score, leftmost first, until no two neighbours form a piece. Two facts make a table
    possible. Every part of a merged text between two of its token ends is itself merged to just these tokens, so a
    prefix has one last token, whatever follows. And a row of tokens is the merged form of its text if each pair of
    neighbours is. So the last token of a prefix is the one piece that ends there (an automaton gives all of them) and
    is compatible with the last token of the prefix before it; where no piece is, it is the last character alone. The
    ids follow backwards from the end.

    Two tokens are compatible if merging their joint text ends with just these two. Only what lies at the border matters:
    the tokens grow towards it along the merges that form them, best score first, and they are incompatible if a piece
    across the border comes before.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(model.get_piece_size())
        plain = [i for i in numbers if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids_of = {model.id_to_piece(i): np.array([i], dtype="<u4").tobytes() for i in plain}
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in numbers if model.is_byte(i)}
        if len(self.bytes) < 256 or any(model.is_unused(i) for i in plain):
            raise ValueError(f"{path} must spell unknown characters in bytes and use all of its pieces")
        self.is_byte = np.array([model.is_byte(i) for i in numbers])
        self.letter = next(i for i in plain if re.fullmatch("[a-z]", model.id_to_piece(i)))
        # Each text that merging makes one token of, with its growth at its right and at its left border:
        # what is at the border, and the score of the merge that makes it part of something larger.
        self.right: dict[str, list[tuple[str, float]]] = {}
        self.left: dict[str, list[tuple[str, float]]] = {}
        automaton = ahocorasick.Automaton()
        for piece in sorted(self.scores, key=lambda text: (-self.scores[text], len(text))):
            if len(piece) > 1 and self._grow(piece):
                automaton.add_word(piece, (piece, len(piece)))
        automaton.make_automaton()
        self.automaton = automaton
        self.longest = max(map(len, self.right), default=1)
        self.word, self.word_start = self._words(), re.compile(f"(?<=[^{_SPACE}]){_SPACE}")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, bytes] = {}

    def _words(self) -> re.Pattern | None:
        """A pattern that cuts a normalised text where no piece reaches across; None if there may be no such place.

        Places are looked for in front of spaces, around characters that no piece joins with others, and between a
        letter and a mark behind it.
        """
        inside = {piece[at : at + 2] for piece in self.scores for at in range(len(piece) - 1)}
        if any(pair[0] != _SPACE and pair[1] == _SPACE for pair in inside):
            return None
        latin = [chr(code) for code in range(256)]
        joined = {character for pair in inside for character in pair}
        alone = "".join(re.escape(c) for c in latin if c not in joined)
        behind = {pair[1] for pair in inside if re.match(_LETTER, pair)}
        marks = "".join(re.escape(c) for c in latin if c in joined and c not in behind and not re.match(_LETTER, c))
        plain = f"[^{_SPACE}{alone}{marks}]*"
        word = f"(?:{_SPACE}+|[^{_SPACE}{alone}]){plain}"
        if marks:
            word += f"(?:(?<!{_LETTER})[{marks}]{plain})*"
        return re.compile(f"[{alone}]|{word}" if alone else word)

    def check(self) -> None:
        """Compare with the library on every piece; a vocabulary that is not of merge type differs."""
        texts = [piece.replace(_SPACE, " ") for piece in self.scores]
        for text, ids in zip(texts, self.library.encode(texts, num_threads=1), strict=True):
            if self.ids(text).tolist() != ids:
                raise ValueError(f"the vocabulary does not merge by score: {text!r} has the ids {ids}")

    def ids(self, text: str) -> np.ndarray:
        normal, parts, start = self.library.normalize(text), [], 0
        while start < len(normal):
            cut = self.word_start.search(normal, start + _BLOCK) if self.word else None
            end = cut.start() if cut else len(normal)
            parts.append(self._block(normal[start:end]))
            start = end
        return np.frombuffer(b"".join(parts), dtype="<i4")

    def _block(self, normal: str) -> bytes:
        memo = self.memo
        words = self.word.findall(normal) if self.word else [normal]
        new = [word for word in set(words) if word not in memo]
        if not new:
            return b"".join(map(memo.__getitem__, words))
        found = {word: self._spelled(self.tokens(word)) for word in new}
        if len(memo) < _MEMO:
            memo.update(found if len(max(new, key=len)) <= _LONGEST else {w: found[w] for w in new if len(w) <= _LONGEST})
        return b"".join([found[word] if word in found else memo[word] for word in words])

    def text(self, ids: np.ndarray) -> str:
        """The library's text of the ids, decoded in parts that do not cut a character spelled in bytes."""
        parts, start = [], 0
        while start < len(ids):
            end = min(start + _IDS, len(ids))
            while end < len(ids) and self.is_byte[ids[end]]:
                end += 1
            if start == 0:
                parts.append(self.library.decode(ids[:end].tolist()))
            else:  # behind a letter, a space at the front is no longer the one put before the text
                parts.append(self.library.decode([self.letter, *ids[start:end].tolist()])[1:])
            start = end
        return "".join(parts)

    def _spelled(self, tokens: list[str]) -> bytes:
        ids_of = self.ids_of
        for token in tokens:
            if token not in ids_of:  # a character without a piece, of which there are no more than Unicode has
                ids_of[token] = np.array([self.bytes[byte] for byte in token.encode()], dtype="<u4").tobytes()
        return b"".join(map(ids_of.__getitem__, tokens))

    def tokens(self, text: str) -> list[str]:
        """The tokens of a normalised text, recovered backwards from the table of its prefixes.

        The table is made for a window at a time. Where the paths back from all prefixes that a later token can follow
        meet, the tokens before are certain: they are recovered, and the next window starts there. So a text
        without spaces needs no table of its own length.
        """
        if len(text) <= _PREFIXES:
            return _recovered(self._table(text, ""))
        found, start, head, width = [], 0, "", _PREFIXES
        while start + width < len(text):
            last = self._table(text[start : start + width], head)
            cut = self._meeting(last)
            if cut:
                found += _recovered(last[:cut])
                start, head, width = start + cut, last[cut - 1], _PREFIXES
            else:
                width *= 2
        return found + _recovered(self._table(text[start:], head))

    def _table(self, text: str, head: str) -> list[str]:
        """The last token of every prefix of the text, which follows the token ``head``."""
        last, settled, known = list(text), -1, self.pairs.get
        for end, (piece, length) in self.automaton.iter(text):
            if end == settled:
                continue
            previous = last[end - length] if end >= length else head
            if previous:
                fits = known((previous, piece))
                if not (self._compatible(previous, piece) if fits is None else fits):
                    continue
            last[end] = piece
            settled = end
        return last

    def _meeting(self, last: list[str]) -> int:
        """The length of the longest prefix whose end lies on the paths back from all prefixes that a token can follow."""
        ends = {len(last) - back for back in range(self.longest)}
        while len(ends) > 1:
            end = max(ends)
            ends.remove(end)
            ends.add(end - len(last[end - 1]))
        return ends.pop()

    def _compatible(self, first: str, second: str) -> bool:
        known = self._apart(first, second)
        if len(self.pairs) >= _PAIRS:
            self.pairs.clear()
        self.pairs[first, second] = known
        return known

    def _apart(self, first: str, second: str, joined: float | None = None) -> bool:
        """Whether no merge across the border comes before both tokens are whole, and then none either.

        With ``joined``, whether the merge of the whole tokens is the first one across the border.
        """
        score = self.scores.get
        rights, lefts = self.right.get(first), self.left.get(second)
        i = j = 0
        while True:
            a, grow_a = rights[i] if rights else (first, -np.inf)
            b, grow_b = lefts[j] if lefts else (second, -np.inf)
            across = score(a + b)
            whole = grow_a == grow_b == -np.inf
            if across is not None and across > grow_a and across >= grow_b:
                return whole and joined is not None
            if whole:
                return across is None
            # Of equal scores the left one merges first.
            if grow_a >= grow_b:
                i += 1
            else:
                j += 1

    def _grow(self, piece: str) -> bool:
        """Find the last merge that forms the piece and note its borders; False if merging makes no token of it."""
        for cut in range(1, len(piece)):
            first, second = piece[:cut], piece[cut:]
            if (cut == 1 or first in self.right) and (cut == len(piece) - 1 or second in self.right):
                if self._apart(first, second, joined=self.scores[piece]):
                    end = self.scores[piece]
                    right = self.right.get(second, [(second, -np.inf)])
                    left = self.left.get(first, [(first, -np.inf)])
                    self.right[piece] = [*right[:-1], (second, end), (piece, -np.inf)]
                    self.left[piece] = [*left[:-1], (first, end), (piece, -np.inf)]
                    return True
        return False


def _recovered(last: list[str]) -> list[str]:
    found, end = [], len(last)
    while end:
        token = last[end - 1]
        found.append(token)
        end -= len(token)
    found.reverse()
    return found


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per vocabulary and Python worker."""
    return PieceEncoder(path)


def encoded(text: str | Column, path: str) -> Column:
    """A struct of ``ids`` (array of int) and ``decoded``, the text that the ids stand for."""

    @F.pandas_udf("ids array<int>, decoded string")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = piece_encoder(path)
        for batch in texts:
            for at in range(0, len(batch), _ROWS):
                ids = [encoder.ids(each) for each in batch.iloc[at : at + _ROWS]]
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": [encoder.text(each) for each in ids]})

    return encode(text_or_empty(text))


def decoded(ids: str | Column, path: str) -> Column:
    """The text of ids as the library's decode gives it; null for null, and for a row with an id that is null."""

    @F.pandas_udf("string")
    def decode(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = piece_encoder(path)
        for batch in rows:
            yield pd.Series([None if each is None else encoder.text(np.asarray(each, dtype="<i4")) for each in batch], dtype=object)

    column = F.col(ids) if isinstance(ids, str) else ids
    return decode(F.when(F.forall(column, lambda each: each.isNotNull()), column))


def encoded_documents(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None
) -> DataFrame:
    """One row per row of ``df``: id, ids of the whole text without begin or end, and decoded, the text of these ids.

    The ids are those of the sentencepiece library, and its decode gives the text. ``path`` names a vocabulary of merge
    type that spells unknown characters in bytes; any other is refused before the job starts.

    No row is shuffled: a task encodes its rows one after the other. Words are encoded once per worker as long as it remembers them (up to a
    bound), where no piece reaches across a word's start; a long text is taken block by block, and one without spaces is
    recovered behind the table as it goes. Null text is empty and has no ids. Rows that repeat an id are encoded each for
    itself, an empty table gives an empty one, other columns are not touched.
    """
    check_columns(df, id_column, text_column)
    path = path or default_model()
    piece_encoder(path).check()
    rows = df.select(F.col(id_column), encoded(text_column, path).alias("__encoded"))
    return rows.select(id_column, "__encoded.ids", "__encoded.decoded")
