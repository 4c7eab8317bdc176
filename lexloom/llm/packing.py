"""Packing into token-budget batches, in length buckets that minimise padding.

A histogram of all lengths up to the budget goes to the driver, exact to the token; it has
``budget`` bins at most, whatever the corpus.  A dynamic programme over it chooses the boundaries of
the buckets so that the padding over all documents is least.  Longer documents are batches of their
own, unpadded, in a bucket behind the others.  The documents of a bucket are dealt by a hash of their
row number to cells of about ``CELL_ROWS``, so neither a bucket nor rows without an id meet in one
task, and form batches inside their cell, longest first; at most one batch of each cell is not full.

Defined results: a null or empty text has length 0; repeated rows and rows without an id are packed
each, ties by id and row number; very long texts are counted whole; ids are cast to long; an empty
table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from lexloom.llm import store, token_counts

BUCKETS, BUDGET, CELL_ROWS = 8, 16_384, 8192
#: Fixed value: the special string of the vocabulary.
SPECIALS = ("<|endoftext|>",)


def word_count(text_col: str = "text"):
    """The length that ``pack`` counts if none is given: words between white space."""
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _layer(least: np.ndarray, total: np.ndarray, longest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each j the least ``least[i] + longest[j] * (documents in i+1..j)`` over i < j, and its i.

    The best i never falls as j rises, so the j halfway between two that are known looks only
    between their i; all j of a depth are done together.
    """
    size = longest.size
    best, where = np.full(size, np.inf), np.full(size, -1, np.int64)
    spans = np.array([[1, size - 1, 0, size - 1]] if size > 1 else [], np.int64)  # first and last j, least and largest i
    while spans.size:
        low, high, from_i, to_i = spans.T
        j = (low + high) // 2
        ends = np.minimum(to_i, j - 1)
        widths = ends - from_i + 1
        starts = np.concatenate([[0], np.cumsum(widths)[:-1]])
        i = np.arange(widths.sum()) - np.repeat(starts - from_i, widths)
        cost = least[i] + np.repeat(longest[j], widths) * (np.repeat(total[j + 1], widths) - total[i + 1])
        best[j] = np.minimum.reduceat(cost, starts)
        hit = np.flatnonzero(cost == np.repeat(best[j], widths))
        where[j] = i[hit[np.searchsorted(hit, starts)]]
        halves = np.concatenate([np.column_stack([low, j - 1, from_i, where[j]]), np.column_stack([j + 1, high, where[j], to_i])])
        spans = halves[halves[:, 0] <= halves[:, 1]]
    return best, where


def boundaries(counts: np.ndarray, longest: np.ndarray, buckets: int) -> list[int]:
    """Indices of the last bin of each bucket, least padded length in all; bins in order of length."""
    size = counts.size
    if not size:
        return []
    total = np.concatenate([[0], np.cumsum(counts.astype(np.float64))])
    lengths = longest.astype(np.float64)
    least, steps = total[1:] * lengths, []
    for _ in range(min(buckets, size) - 1):
        best, where = _layer(least, total, lengths)
        where[best >= least] = -1
        least = np.minimum(best, least)
        steps.append(where)
    chosen, j = [size - 1], size - 1
    for where in reversed(steps):
        if where[j] >= 0:
            j = int(where[j])
            chosen.append(j)
    return chosen[::-1]


def pack(docs: DataFrame, length=None, buckets: int = BUCKETS, budget: int = BUDGET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, bucket, padded_tokens, batch_id and batch_place of every row of ``docs``."""
    length = word_count(text_col) if length is None else length
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(length.cast("long"), F.lit(0)).alias("length"))
    rows = store.materialise(rows.withColumn("row", F.monotonically_increasing_id()), "lengths")
    bins = rows.groupBy(F.least("length", F.lit(budget + 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    over = sum(r["n"] for r in bins if r["bin"] > budget)
    own = [r for r in bins if r["bin"] <= budget]
    counts, longest = np.array([r["n"] for r in own], np.int64), np.array([r["bin"] for r in own], np.int64)
    last = boundaries(counts, longest, buckets)
    bounds = [int(longest[j]) for j in last] or [0]
    held = [*(np.add.reduceat(counts, [0, *[j + 1 for j in last[:-1]]]) if last else [0]), over]
    cells = [max(1, math.ceil(int(n) / CELL_ROWS)) for n in held]
    each = [*[budget // max(1, b) for b in bounds], 1]
    pick = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("bucket") + 1)
    inside = sum((F.when(F.col("length") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    bucket = F.when(F.col("length") > budget, len(bounds)).otherwise(inside)
    dealt = rows.withColumn("bucket", bucket).withColumn("cell", F.pmod(F.xxhash64("row"), pick(cells)))
    place = F.row_number().over(Window.partitionBy("bucket", "cell").orderBy(F.desc("length"), "doc_id", "row")) - 1
    placed = dealt.withColumn("place", place)
    padded = F.when(F.col("length") > budget, F.col("length")).otherwise(pick([*bounds, 0]).cast("long"))
    return placed.select(
        "doc_id", F.col("length").alias("n_tokens"), F.col("bucket").cast("int"), padded.alias("padded_tokens"),
        F.concat_ws("-", "bucket", "cell", F.floor(F.col("place") / pick(each))).alias("batch_id"),
        F.pmod("place", pick(each)).cast("int").alias("batch_place"))


def pack_tokens(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``pack`` by the tokens that ``op8_token_counts`` counts: the same vocabulary, as ranks."""
    import public_tokenizers

    counted = token_counts.token_totals(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, SPECIALS, id_col, text_col)
    return pack(counted, F.col("n_tokens"), buckets, budget)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
