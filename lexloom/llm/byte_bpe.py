"""Byte-level BPE in linear time, exact to the merges.

The bytes of a piece are read as Latin-1 so that a pyahocorasick automaton over all tokens lists
every token at every place in one pass.  Encoding walks left to right, takes the longest token
whose neighbour to the left is compatible with it, and steps back where none is.  Two adjacent
tokens are compatible if merging their bytes gives just these two; this is memoised by pair.  A
prefix has one encoding only in which all neighbours are compatible, so a place once given up is
never tried again, which bounds the work by the number of matches.

Texts are cut before spaces and the parts memoised, which is right for a pattern whose pieces end
there; any other pattern is refused.

Defined results: null counts as empty and has no tokens; texts of any length are encoded whole;
special strings inside texts are ordinary text; repeated rows give repeated results; ids are cast to
long; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from lexloom.llm.index import mapped

#: A space between white space, or before the end after white space, belongs to a longer run.
_RUNS = re.compile(r"\s \s|\s \Z")
#: Fixed value: the split pattern of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters below are letters to any version of Unicode; signs of one byte that are no quote and no space.
LATIN, SIGNS = "\u0250", frozenset(".,;:!?)")
#: Entries after which a worker empties a memo; results do not depend on it.
MEMO = 500_000
_SHIFT = 24


def printable_bytes() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens by id, and the order in which pairs of tokens merge."""

    def __init__(self, tokens: dict[int, bytes], pattern: str, pairs: dict[tuple[bytes, bytes], int] | None = None, specials: tuple[str, ...] = ()):
        if pattern != SPLIT:
            raise ValueError("texts are cut before spaces, which is right for one pattern only")
        self.tokens, self.pairs, self.specials = tokens, pairs, specials
        self.ids = {b: i for i, b in tokens.items()}
        self.pattern = regex.compile(pattern)
        self._fits: dict[int, bool] = {}
        reached = self.reached = {t: i for t, i in self.ids.items() if len(t) == 1 or self.merged(t) == [t]}  # no merges lead to others
        self.automaton = ahocorasick.Automaton()
        for token, number in reached.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), number))
        self.automaton.make_automaton()
        self.lengths, self.shorter = [0] * (max(tokens) + 1), [-1] * (max(tokens) + 1)
        for token, number in reached.items():
            self.lengths[number] = len(token)
            self.shorter[number] = next((reached[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in reached), -1)

    def _order(self, a: bytes, b: bytes) -> int | None:
        return self.ids.get(a + b) if self.pairs is None else self.pairs.get((a, b))

    def merged(self, piece: bytes) -> list[bytes]:
        """The definition: merge the pair that comes first, leftmost among equals, until none merges."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            orders = [(o, i) for i in range(len(parts) - 1) if (o := self._order(parts[i], parts[i + 1])) is not None]
            if not orders:
                return parts
            i = min(orders)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, a: int, b: int) -> bool:
        key = a << _SHIFT | b
        found = self._fits.get(key)
        if found is None:
            if len(self._fits) > 4 * MEMO:
                self._fits.clear()
            left, right = self.tokens[a], self.tokens[b]
            found = self._fits[key] = self.merged(left + right) == [left, right]
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.reached.get(piece)
        if whole is not None:
            return [whole]
        size, lengths, shorter, known = len(piece), self.lengths, self.shorter, self._fits.get
        longest = [-1] * (size + 1)
        for end, (length, number) in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length] = number  # ends rise, so the longest comes last
        given_up, path = bytearray(size + 1), []
        place, number, last = 0, longest[0], -1
        while place < size:
            while number >= 0:
                after = place + lengths[number]
                if not given_up[after]:
                    if last < 0:
                        break
                    fits = known(last << _SHIFT | number)
                    if self.fits(last, number) if fits is None else fits:
                        break
                number = shorter[number]
            if number >= 0:
                path.append(number)
                place, last = after, number
                number = longest[place]
            else:
                given_up[place] = 1
                number = path.pop()
                place -= lengths[number]
                number, last = shorter[number], path[-1] if path else -1
        return path

    def prefix_counts(self, piece: bytes) -> list[int]:
        """The token count of every prefix of the piece's bytes, 0 for the empty one.

        Among the tokens that end a prefix, just one is compatible with the last token of the
        shorter prefix before it.
        """
        counts, lasts, known = [0] * (len(piece) + 1), [-1] * (len(piece) + 1), self._fits.get
        for end, (length, number) in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            if lasts[end] < 0:
                start = end - length
                if start:
                    fits = known(lasts[start] << _SHIFT | number)
                    if not (self.fits(lasts[start], number) if fits is None else fits):
                        continue
                counts[end], lasts[end] = counts[start] + 1, number
        return counts

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)


def ranks_of(path: str) -> dict[int, bytes]:
    """Lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


@functools.cache
def rank_file(path: str, pattern: str) -> Vocabulary:
    """A file of ranks; the rank is both id and order."""
    return Vocabulary(ranks_of(path), pattern)


@functools.cache
def merges_file(path: str, pattern: str) -> Vocabulary:
    """A tokenizer JSON with a vocabulary and a list of merges in their order."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte = printable_bytes()
    raw = lambda token: bytes(byte[c] for c in token)
    specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
    tokens = {i: raw(t) for t, i in spec["model"]["vocab"].items() if t not in specials}
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    return Vocabulary(tokens, pattern, {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}, tuple(specials))


def chunks(text: str) -> list[str] | None:
    """Parts of the text before each space, which split into pieces alone as they do in the text.

    The pattern's pieces end before a space, but for runs of white space with a space inside or,
    at the end, after their first character; with such a run the text has no chunks.
    """
    return None if _RUNS.search(text) else text.split(" ")


class Memo:
    """The results of a function for recent texts: when full, the newer half stays."""

    def __init__(self, function, most: int = MEMO):
        self.function, self.most = function, most
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def __call__(self, text: str):
        found = self.new.get(text)
        if found is None:
            found = self.old.get(text)
            if found is None:
                found = self.function(text)
            if len(text) < 64:
                if len(self.new) >= self.most:
                    self.new, self.old = {}, self.new
                self.new[text] = found
        return found

    def all(self, texts: list[str]) -> list:
        found = list(map(self.new.get, texts))
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            found[at] = self(texts[at])
        return found


class Encoder:
    """Encodes texts with memoised chunks: ids as little-endian 32-bit bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.piece = Memo(self._piece, MEMO // 8)
        #: By what follows the chunk's space.
        self.chunk = Memo(self._word, MEMO)

    def _piece(self, piece: str) -> bytes:
        ids = self.vocabulary.encode_piece(piece.encode("utf-8"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        """The ids of a space and what follows it, up to the next space: letters are one piece, a sign behind them another."""
        if word.isalpha() and max(word) < LATIN:
            return self._piece(" " + word)
        head = word[:-1]
        if head.isalpha() and word[-1] in SIGNS and max(head) < LATIN:
            return self.chunk(head) + self.piece(word[-1])
        return self._whole(" " + word)

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.vocabulary.pieces(text)))

    def encode(self, text: str) -> bytes:
        parts = chunks(text)
        if parts is None:
            return self._whole(text)
        return self._whole(parts[0]) + b"".join(self.chunk.all(parts[1:]))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(rank_file(path, pattern))


def _encode(batches, path: str, pattern: str):
    encoder = _encoder(path, pattern)
    for batch in batches:
        ids = [encoder.encode(x or "") for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])


def _digests(batches, path: str, pattern: str):
    encoder = _encoder(path, pattern)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for batch in batches:
        ids = [encoder.encode(x or "") for x in batch.column("text").to_pylist()]
        columns = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(encoder.decode(x)).hexdigest() for x in ids])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)


def _decode(batches, path: str, pattern: str):
    encoder = _encoder(path, pattern)
    for batch in batches:
        texts = [None if x is None else encoder.decode(x) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "bytes"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text as little-endian unsigned 32-bit integers."""
    return mapped(_texts(docs, id_col, text_col), _encode, "doc_id long, ids binary", path, pattern)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) of rows (doc_id, ids)."""
    return mapped(encoded.select("doc_id", "ids"), _decode, "doc_id long, bytes binary", path, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the ids of each text and of the bytes that the ids decode to, in one pass."""
    return mapped(_texts(docs, id_col, text_col), _digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", path, pattern)


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
