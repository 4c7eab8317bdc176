"""Line dedup: lines that many documents share stay in one of them.

One pass hashes the keys of every line and counts, by partial aggregation, the documents that
hold each.  Keys of enough documents go into a sharded minimal perfect hash (``index.py``) whose
arrays hold a fingerprint, the count and the largest holder; leaving out keys of fewer documents
changes nothing, as the fingerprint of a key that is absent does not match.  A second pass over
the documents probes those arrays, each shard once a task.  No line is shuffled twice and no
document at all, so neither a hot line nor a hot source meets in one task.

Defined results: a null or empty text is one empty line; texts of any length are split whole; each
row counts as one document, also when its id is repeated, and all rows of the largest id keep the
line; rows with a null id come below all ids; ids are cast to long; an empty table gives an empty
table; columns named like the added ones are replaced, all others pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lexloom.llm import store, text as tx
from lexloom.llm.index import LineIndex, mapped, probed

MIN_CHARS, MIN_DOCS = 20, 3
ADDED = ("n_lines", "n_dropped")


def _emit(batches, min_chars: int):
    for batch in store.blocks(batches, "text"):
        digests, ids = [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            own = {tx.digest(key.encode("utf-8", "surrogatepass").lower()) for line in (text or "").split("\n") if len(key := line.strip(tx.WHITE)) >= min_chars}
            digests += own
            ids += [tx.NO_ID if doc_id is None else doc_id] * len(own)
        low, high = tx.key_arrays(digests)
        yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), pa.array(ids, pa.int64())], ["lo", "hi", "doc_id"])


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(lo, hi) of every key of ``min_chars`` code points, the documents that hold it, the largest."""
    rows = mapped(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), _emit, "lo long, hi long, doc_id long", min_chars)
    return rows.groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("holder"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
    return LineIndex.build(line_counts(docs, id_col, text_col, min_chars).where(F.col("n") >= min_docs), "lines")


def _look(batch, text_col: str, min_chars: int):
    """The batch, (lines and eligible lines of each text, places of the latter), digests of the latter."""
    digests, totals, sizes, places = [], [], [], []
    for text in batch.column(text_col).to_pylist():
        own = (text or "").split("\n")
        at = [i for i, line in enumerate(own) if len(line) >= min_chars and len(line.strip(tx.WHITE)) >= min_chars]
        digests += [tx.digest(tx.line_key(own[i])) for i in at]
        totals.append(len(own))
        sizes.append(len(at))
        places += at
    return batch, (np.array(totals, np.int64), np.array(sizes, np.int64), np.array(places, np.int64)), digests


def _judge(batch, remembered, counts, holders, id_col: str, text_col: str):
    totals, sizes, places = remembered
    ids = batch.column(id_col).fill_null(tx.NO_ID).to_numpy()
    gone = (counts > 0) & (holders != np.repeat(ids, sizes))
    row = np.repeat(np.arange(sizes.size), sizes)
    dropped = np.bincount(row[gone], minlength=sizes.size)
    texts = batch.column(text_col)
    if dropped.any():
        texts, starts = texts.to_pylist(), np.concatenate([[0], np.cumsum(sizes)])
        for i in np.flatnonzero(dropped).tolist():
            held = slice(starts[i], starts[i + 1])
            out = set(places[held][gone[held]].tolist())
            texts[i] = "\n".join(line for j, line in enumerate(texts[i].split("\n")) if j not in out)
        texts = pa.array(texts, pa.string())
    columns = [texts if name == text_col else batch.column(name) for name in batch.schema.names]
    return pa.RecordBatch.from_arrays([*columns, pa.array(totals), pa.array(dropped.astype(np.int64))], [*batch.schema.names, *ADDED])


def _probe(batches, index: LineIndex, id_col: str, text_col: str, min_chars: int):
    return probed(batches, index, text_col, lambda b: _look(b, text_col, min_chars), lambda *x: _judge(*x, id_col, text_col))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with shared lines dropped from its text, n_lines before and n_dropped."""
    index = build_index(docs, id_col, text_col, min_chars, min_docs)
    kept = store.without(docs, *ADDED)
    kept = kept.withColumn(id_col, F.col(id_col).cast("long"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in kept.schema] + [T.StructField(x, T.LongType()) for x in ADDED])
    return mapped(kept, _probe, schema, index, id_col, text_col, min_chars)


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT doc_id, i, line,
        translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.i, k.line, (s.key IS NOT NULL AND k.doc_id <> s.holder) AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
