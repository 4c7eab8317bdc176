"""Token counts from exact prefix counts.

A dynamic programme gives the token count of every prefix of a chunk of text (see
``Vocabulary.prefix_counts``); chunks are memoised, and a text is the running sum over its chunks.
From that, the count of the whole text, the count of any prefix and the longest prefix within a
budget are looked up without encoding again.

Defined results: null counts as empty, with no tokens; special strings inside a text are one
token each, as the library reads them by default; texts of any length are counted whole; repeated
rows give repeated results; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import functools
import operator
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import byte_bpe
from lexloom.llm.index import mapped

LIMIT = 1024
_LAST = operator.itemgetter(-1)
_WHITE = regex.compile(r"\s").match
#: With a space after white space, prefixes end otherwise than chunks do.
_RUNS = regex.compile(r"\s ")
#: Runs on which the library's split may overflow its stack; they are counted here.
_LONG = re.compile(r"\s{50000}|\S{200000}").search
#: The contractions of the pattern.
_CONTRACTIONS = frozenset(["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"])


class PrefixCounts:
    """Counts at every prefix of one text, by code points."""

    def __init__(self, parts: list[list[int]]):
        """``parts``: for each chunk, the counts of its prefixes of 0, 1, ... code points."""
        self.parts = parts
        self.chars = np.zeros(len(parts) + 1, np.int64)
        self.tokens = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) - 1, out=self.chars[1:])
        np.cumsum(np.fromiter(map(_LAST, parts), np.int64, len(parts)), out=self.tokens[1:])

    @property
    def total(self) -> int:
        return int(self.tokens[-1])

    def at(self, chars: int) -> int:
        """Tokens of the first ``chars`` code points."""
        i = int(np.searchsorted(self.chars, chars, "right")) - 1
        return int(self.tokens[i]) + (self.parts[i][chars - int(self.chars[i])] if chars > self.chars[i] else 0)

    def within(self, budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens."""
        i = int(np.searchsorted(self.tokens, budget, "right")) - 1
        if i == len(self.parts):
            return int(self.chars[-1])
        left, part = budget - int(self.tokens[i]), self.parts[i]
        return int(self.chars[i]) + next(n for n in range(len(part) - 1, -1, -1) if part[n] <= left)


def _small(counts: list[int]) -> bytes | list[int]:
    """Counts of a byte each, as a memo of very many keeps them."""
    return bytes(counts) if max(counts) < 256 else counts


class Counter:
    """Prefix counts of texts, from memoised chunks and pieces."""

    def __init__(self, vocabulary: byte_bpe.Vocabulary):
        self.vocabulary = vocabulary
        self.piece = byte_bpe.Memo(lambda x: _small(self._piece(x)), byte_bpe.MEMO // 8)
        #: By what follows the chunk's space.
        self.chunk = byte_bpe.Memo(self._word, byte_bpe.MEMO)
        self.first = byte_bpe.Memo(self._whole, byte_bpe.MEMO // 32)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, vocabulary.specials)) + ")") if vocabulary.specials else None

    def _piece(self, piece: str) -> list[int]:
        """Counts of the piece's prefixes by code points."""
        raw = piece.encode("utf-8")
        counts = self.vocabulary.prefix_counts(raw)
        if len(raw) == len(piece):
            return counts
        return [0, *[counts[at + 1] for at in range(len(raw)) if at + 1 == len(raw) or raw[at + 1] & 0xC0 != 0x80]]

    def _word(self, word: str) -> bytes | list[int]:
        """Counts of the prefixes of a space and what follows it, up to the next space.

        Letters are one piece; a sign behind them is another, of one token.
        """
        if word.isalpha() and max(word) < byte_bpe.LATIN:
            return _small(self._piece(" " + word))
        head = word[:-1]
        if head.isalpha() and word[-1] in byte_bpe.SIGNS and max(head) < byte_bpe.LATIN:
            counts = self.chunk(head)
            return _small([*counts, counts[-1] + 1])
        return _small(self._whole(" " + word))

    def _whole(self, chunk: str) -> list[int]:
        """Counts of the chunk's prefixes, each as if the text ended there.

        A prefix splits as the chunk does, but in two places.  A run of white space before
        another character leaves its last character to the next piece; the prefix that ends
        there keeps the run in one.  And a contraction that is cut is a quote and letters.
        So besides each piece one prefix of it is counted anew at most, or two short ones.
        """
        counts, held, before, last = [0], 0, 0, ""
        for piece in self.vocabulary.pieces(chunk):
            own, c = self.piece(piece), piece[0]
            if c == "'" and piece in _CONTRACTIONS:
                counts += [held + sum(self.piece(x)[-1] for x in self.vocabulary.pieces(piece[:n])) for n in range(1, len(piece))]
                counts.append(held + own[-1])
            elif last and (c <= " " or c > "~") and _WHITE(c) and _WHITE(last[-1]):
                counts.append(before + self.piece(last + c)[-1])
                counts += [held + x for x in own[2:]]
            elif held:
                counts += [held + x for x in own[1:]]
            else:
                counts += own[1:]
            before, held, last = held, held + own[-1], piece
        return counts

    def prefixes(self, text: str) -> PrefixCounts:
        out: list[list[int]] = []
        before = ""
        for i, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if i % 2:
                out.append(self._special(part, before))
            elif _RUNS.search(part):
                out.append(self._whole(part))
            elif part:
                first, *others = part.split(" ")
                if first:
                    out.append(self.first(first))
                out += self.chunk.all(others)
            before = "" if i % 2 else part
        return PrefixCounts(out)

    def _special(self, content: str, before: str) -> list[int]:
        """One token if whole; cut, it is text that may join the piece before it."""
        tail = (self.vocabulary.pieces(before) or [""])[-1]
        count = lambda text: sum(self.piece(x)[-1] for x in self.vocabulary.pieces(text))
        held = count(tail)
        return [0, *[count(tail + content[:n]) - held for n in range(1, len(content))], 1]


@functools.cache
def _counter(path: str, pattern: str) -> Counter:
    return Counter(byte_bpe.merges_file(path, pattern))


def _count(batches, path: str, pattern: str, limit: int):
    counter = _counter(path, pattern)
    for batch in batches:
        texts = [x or "" for x in batch.column("text").to_pylist()]
        found = []
        for text in texts:
            prefixes = counter.prefixes(text)
            found.append((prefixes.total, prefixes.within(limit)))
        tokens = pa.array([n for n, _ in found], pa.int64())
        columns = [pa.array([len(x.encode("utf-8")) for x in texts], pa.int64()), tokens, pa.compute.greater(tokens, limit), pa.array([n for _, n in found], pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_tokens", "over_limit", "chars_within_limit"])


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and the code points that fit into the limit."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return mapped(texts, _count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chars_within_limit long", path, pattern, limit)


@functools.cache
def _library(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={t: i for i, t in byte_bpe.ranks_of(path).items()}, special_tokens={})


def total(text: str, path: str, pattern: str, specials: tuple[str, ...] = ()) -> int:
    """Tokens of a text by a file of ranks, each special string one."""
    parts = re.split("(" + "|".join(map(re.escape, specials)) + ")", text) if specials else [text]
    number = len(parts) // 2
    for part in filter(None, parts[::2]):
        if len(part) >= 50_000 and _LONG(part):
            own = byte_bpe.rank_file(path, pattern)
            number += sum(len(own.encode_piece(x.encode("utf-8"))) for x in own.pieces(part))
        else:
            number += len(_library(path, pattern).encode_ordinary(part))
    return number


def _totals(batches, path: str, pattern: str, specials: tuple[str, ...]):
    for batch in batches:
        totals = [total(x or "", path, pattern, specials) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(totals, pa.int64())], ["doc_id", "n_tokens"])


def token_totals(docs: DataFrame, path: str, pattern: str, specials: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row, for callers that ask for whole texts only: the library counts them.

    ``path`` is a file of ranks; with the ranks and special strings of a vocabulary these are the numbers
    that ``token_counts`` gives.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return mapped(texts, _totals, "doc_id long, n_tokens long", path, pattern, specials)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
