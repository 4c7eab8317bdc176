"""License scans by diagonal voting.

Each document gives the rolling hashes of its two- and three-word windows; Spark joins them to
the windows of the templates, a table of fixed size that is broadcast.  A hit at word p of the
document and word q of a template votes for the diagonal p - q.  Votes are aggregated by diagonal
into a bit for each q, so a diagonal is a row or a few of fixed size however often it is hit.  The
rows of a document then stream past in order of template and diagonal: neighbouring diagonals of a
template (words put in or left out) are merged into spans no wider than the template, and a span
counts if a chain of its hits, rising in the document and in the template alike, covers enough of
the template; a phrase of the base set must be covered in full on one diagonal.  A document's words
never leave the task that read them: only hits move, and each document sends one more row with its
word count.  All work after the join is linear in the hits.

Documents are told apart by id and a 128-bit hash of the text, which a repeated task gives again;
equal rows are voted for once and come out as often as they went in.

Defined results: null and empty texts have no words and no labels; very long texts are scanned
whole; rows that repeat an id are scanned each on its own, as are rows without one; ids are cast to
long; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import operator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import store, text as tx
from lexloom.llm.index import mapped, mixed

#: The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: The method's own templates: short notices, and passages of public license texts.
TEMPLATES = [
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("creative commons attribution", "cc-by"),
    ("the mit license", "mit"),
    ("apache license version 2 0", "apache-2.0"),
    ("mozilla public license", "mpl"),
    ("dedicated to the public domain", "public-domain"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License", "apache-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl"),
]
COVER, SLACK, WINDOWS = 0.8, 4, (2, 3)
#: Template words in the mask of one row.
_BITS = 62

#: ASCII but for digits and small letters separates words; every byte of other characters is in one.
_GAPS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_END = np.int64(0x4C6F6F6D)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_GAPS).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_hashes = _Hashes()


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of ``size`` word hashes, by the place of its first word."""
    out = np.full(max(0, words.size - size + 1), size, np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + out.size])
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def templates(own: list[tuple[str, str]]) -> list[tuple[list[bytes], str, bool]]:
    return [(words_of(text), label, base) for group, base in ((list(BASE.items()), True), (own, False)) for text, label in group]


def _windows(count: int) -> int:
    return min(count, WINDOWS[-1])


def _emit(batches):
    for batch in store.blocks(batches, "text", 4 << 20):
        texts = [x or "" for x in batch.column("text").to_pylist()]
        words = [words_of(x) for x in texts]
        low, high = tx.key_arrays([tx.digest(x.encode("utf-8", "surrogatepass")) for x in texts])
        sizes, parts = [], []
        for own in words:
            hashed = word_hashes(own)
            rolled = [rolling(hashed, k).view(np.int64) for k in WINDOWS]
            parts += [*rolled, np.array([_END])]
            sizes.append(sum(x.size for x in rolled) + 1)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        grams = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), batch.column("doc_id"), pa.array([len(x) for x in words], pa.int64()), grams], ["lo", "hi", "doc_id", "n_words", "grams"])


def template_rows(known: list[tuple[list[bytes], str, bool]]) -> list[tuple[int, int, int]]:
    """(gram, template, word) of every template window; the end mark belongs to template -1."""
    rows = [(int(_END), -1, 0)]
    for number, (words, _, _) in enumerate(known):
        rows += [(int(h), number, q) for q, h in enumerate(rolling(word_hashes(words), _windows(len(words))).view(np.int64))]
    return rows


def chained(hits: list[tuple[int, int]], size: int, window: int) -> int:
    """Template words under the best chain of hits (diagonal, q): both p and q rise along it."""
    best = np.zeros(size + 1, np.int64)  # of chains whose last hit is at q, under q + 1
    back = np.minimum(window, np.arange(size, -1, -1))  # what a hit at q adds to a chain ending at q - size + k
    for _, group in itertools.groupby(sorted((d + q, q) for d, q in hits), operator.itemgetter(0)):
        found = []
        for _, q in group:
            held = best[1 : q + 1]
            reached = held > 0
            found.append((q, max(window, int((held + back[size - q : size])[reached].max()) if reached.any() else 0)))
        for q, covered in found:
            best[q + 1] = max(best[q + 1], covered)
    return int(best.max())


class Spans:
    """The best cover of one template by merged spans of its diagonals, which arrive in order."""

    def __init__(self, size: int, slack: int):
        self.size, self.window, self.slack = size, _windows(size), slack
        self.best, self.open = 0, []

    def _covered(self, mask: int) -> int:
        out = 0
        for i in range(self.window):
            out |= mask << i
        return out.bit_count()

    def add(self, diagonal: int, mask: int) -> None:
        """``mask`` has a bit for each q that the diagonal hits."""
        if self.best == self.size:
            return
        if self.open and (diagonal - self.open[-1][0] > self.slack or diagonal - self.open[0][0] > self.size):
            self.close(diagonal)
        self.open.append((diagonal, mask))

    def close(self, at: int | None = None) -> None:
        """Verify the open span; of one that goes on at ``at``, its later half stays open."""
        union = functools.reduce(operator.or_, (m for _, m in self.open), 0)
        most = self._covered(union)
        if most > self.best:
            if len(self.open) > 1:
                most = chained([(d, q) for d, m in self.open for q in range(m.bit_length()) if m >> q & 1], self.size, self.window)
            self.best = max(self.best, most)
        going_on = at is not None and at - self.open[-1][0] <= self.slack
        self.open = [x for x in self.open if at - x[0] <= self.size // 2] if going_on else []

    @property
    def cover(self) -> float:
        if self.open:
            self.close()
        return self.best / self.size


class _Found:
    """What the rows of one document give."""

    def __init__(self, known, slack: int):
        self.known, self.slack = known, slack
        self.n_base, self.first, self.last = 0, None, None
        self.base: set[str] = set()
        self.spans: dict[int, Spans] = {}

    def add(self, number: int, diagonal: int, mask: int) -> None:
        words, label, is_base = self.known[number]
        if not is_base:
            if number not in self.spans:
                self.spans[number] = Spans(len(words), self.slack)
            self.spans[number].add(diagonal, mask)
        elif mask.bit_count() == len(words) - _windows(len(words)) + 1:
            self.n_base += 1
            self.first = diagonal if self.first is None else min(self.first, diagonal)
            self.last = diagonal if self.last is None else max(self.last, diagonal)
            self.base.add(label)

    def row(self, cover: float) -> tuple:
        covers = {number: x.cover for number, x in self.spans.items()}
        own = {self.known[number][1] for number, x in covers.items() if x >= cover}
        return (self.n_base, self.first, self.last, ",".join(sorted(self.base)), ",".join(sorted(self.base | own)), max([float(bool(self.base)), *covers.values()]))


_KEY = ["lo", "hi", "doc_id"]
_KINDS = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}


def _verify(batches, known, cover: float, slack: int):
    """Votes in order of document, template, diagonal and part in; documents out.

    A document's first row is its mark, under template -1: its word count and copies.
    """
    rows, document, diagonal = [], None, None

    def flush():
        if diagonal:
            document[3].add(*diagonal)

    def done():
        flush()
        if document is not None:
            rows.extend([(document[1][2], document[2], *document[3].row(cover))] * document[0])

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS.values())], list(_KINDS))

    for got in batches:
        for *key, n_words, number, at, part, mask, copies in zip(*[x.to_pylist() for x in got.columns], strict=True):
            if number < 0:
                done()
                document, diagonal = (copies, key, n_words, _Found(known, slack)), None
                if len(rows) >= 4096:
                    yield batch()
                    rows = []
            elif diagonal and diagonal[:2] == (number, at):
                diagonal = (number, at, diagonal[2] | mask << _BITS * part)
            else:
                flush()
                diagonal = (number, at, mask << _BITS * part)
    done()
    if rows:
        yield batch()


RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, own: list[tuple[str, str]] | None = None, cover: float = COVER, slack: int = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The license labels and base places of every row of ``docs``."""
    known = templates(TEMPLATES if own is None else own)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    grams = mapped(texts, _emit, "lo long, hi long, doc_id long, n_words long, grams array<bigint>")
    places = grams.select(*_KEY, "n_words", F.posexplode("grams").alias("at", "gram"))
    table = docs.sparkSession.createDataFrame(template_rows(known), "gram long, template int, word int")
    twos = F.greatest(F.col("n_words") - 1, F.lit(0))
    place = F.when(F.col("at") < twos, F.col("at")).otherwise(F.col("at") - twos)
    hits = places.join(F.broadcast(table), "gram").select(
        *_KEY, "n_words", "template", F.when(F.col("template") >= 0, place - F.col("word")).otherwise(0).alias("diagonal"),
        F.floor(F.col("word") / _BITS).cast("int").alias("part"), F.expr(f"shiftleft(1L, word % {_BITS})").alias("bit"))
    votes = hits.groupBy(*_KEY, "n_words", "template", "diagonal", "part").agg(F.bit_or("bit").alias("mask"), F.count(F.lit(1)).alias("copies"))
    order = [*_KEY, "template", "diagonal", "part"]
    rows = votes.repartition(*_KEY).sortWithinPartitions(*order)
    return mapped(rows, _verify, RESULT, known, cover, slack)


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
