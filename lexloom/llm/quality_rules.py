"""Quality rules: repetition within a document, and lines that a host repeats across documents.

Across documents, one pass hashes the normalised lines of every document together with its host
and counts the documents of each.  A line is above the limit of its host if more documents hold it
than ``SHARE`` of the host's, ``MIN_DOCS`` at least and ``MOST_DOCS`` at most, so a line in more than
``MOST_DOCS`` documents goes at any size of a host.  A line that only copies of one text hold is the
text's own and no boilerplate: exact copies are another operator's business, and none of them would
be left.  The lines that could be above a limit (and the hosts, under an empty line) go into the
sharded index of ``index.py``, which a second pass over the documents probes, each shard once a task:
neither documents nor lines are joined, so a hot host does not meet in one task.  Lines above the
limit are removed; a document that loses more than ``DEPLETED`` of its words is rejected.

Defined results: a null or empty text has no words and fails the base rules; texts of any length are
judged whole; a null host is a host of its own; each row is a document and judged alone, repeated
rows alike; a count just at a limit is not above it; an empty table gives an empty table; columns
named like the added ones are replaced, all others pass through.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lexloom.llm import store, text as tx
from lexloom.llm.index import LineIndex, mapped, probed

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MOST_REPEATED = 50, 50
#: The method's own: a line's share of its host's documents above which it is removed, between two
#: numbers of documents; the share of its words above which a document is depleted.
SHARE, MIN_DOCS, MOST_DOCS, DEPLETED = 0.05, 20, 1000, 0.5

ADDED = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "removed_lines": "long", "removed_words": "long", "kept": "boolean", "cleaned": "string"}


def _key(host: str | None, line: str) -> bytes:
    where = b"\x00" if host is None else b"\x01" + host.encode("utf-8", "surrogatepass")
    return tx.digest(where + b"\x00" + b" ".join(tx.words_of(line)).lower())


def _emit(batches):
    for batch in store.blocks(batches, "text"):
        digests, documents = [], []
        for host, text in zip(batch.column("host").to_pylist(), batch.column("text").to_pylist(), strict=True):
            own = {_key(host, line) for line in (text or "").split("\n")} | {_key(host, "")}
            digests += own
            documents += [xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) - (1 << 63)] * len(own)
        low, high = tx.key_arrays(digests)
        yield pa.RecordBatch.from_arrays([pa.array(low.view("int64")), pa.array(high.view("int64")), pa.array(documents, pa.int64())], ["lo", "hi", "document"])


def frequent_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS) -> LineIndex:
    """An index of the host lines in more than ``min_docs`` documents of two texts or more, with their number."""
    rows = mapped(docs.select(F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text")), _emit, "lo long, hi long, document long")
    counts = rows.groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.min("document").alias("a"), F.max("document").alias("b"))
    return LineIndex.build(counts.where((F.col("n") > min_docs) & (F.col("a") < F.col("b"))).select("lo", "hi", "n"), "host-lines")


def repeated_words(words: list[bytes]) -> int:
    """Words inside some window of three that the text holds twice or more."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    counts, marked = Counter(grams), bytearray(len(words))
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            marked[i : i + 3] = b"\x01\x01\x01"
    return sum(marked)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = tx.words_of(text)
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if line in seen:
            repeated += 1
        elif line.strip(tx.WHITE):
            seen.add(line)
    return len(words), len(text) - sum(map(text.count, tx.WHITE)), sum(map(text.count, SYMBOLS)), repeated, repeated_words(words)


def _look(batch, host_col: str, text_col: str, held: list[str]):
    """The columns to hold, (base counts, lines of each text, their words), digests of host and lines."""
    texts = [x or "" for x in batch.column(text_col).to_pylist()]
    hosts = [None if x is None else str(x) for x in batch.column(host_col).to_pylist()]
    digests, base, sizes, words = [], [], [], []
    for host, text in zip(hosts, texts, strict=True):
        own = text.split("\n")
        digests.append(_key(host, ""))
        digests += [_key(host, line) for line in own]
        base.append(base_counts(text))
        sizes.append(len(own))
        words += [len(tx.words_of(line)) for line in own]
    return batch.select(held), (np.array(base, np.int64).reshape(-1, 5), np.array(sizes, np.int64), np.array(words, np.int64)), digests


def _verdict(batch, remembered, counts, holders, text_col: str, names: list[str], added: list[str], share: float, min_docs: int, most_docs: int, depleted: float):
    base, sizes, words = remembered
    heads = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1].astype(np.int64)
    lines = np.ones(counts.size, bool)
    lines[heads] = False
    limit = np.minimum(np.maximum(share * counts[heads], min_docs), most_docs)
    row = np.repeat(np.arange(sizes.size), sizes)
    gone = (counts[lines] > limit[row]) & (words > 0)
    removed = np.bincount(row[gone], minlength=sizes.size)
    lost = np.bincount(row[gone], words[gone], sizes.size).astype(np.int64)
    failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MOST_REPEATED * base[:, 0])
    found = dict(zip(ADDED, [*base.T, failed, removed, lost, ~failed & (lost <= depleted * base[:, 0])], strict=False))
    columns = [pa.array(found[x]) for x in added if x != "cleaned"]
    if "cleaned" in added:
        texts, starts = batch.column(text_col).fill_null(""), np.concatenate([[0], np.cumsum(sizes)])
        if removed.any():
            texts = texts.to_pylist()
            for i in np.flatnonzero(removed).tolist():
                out = gone[starts[i] : starts[i + 1]]
                texts[i] = "\n".join(line for line, x in zip(texts[i].split("\n"), out.tolist(), strict=True) if not x)
            texts = pa.array(texts, pa.string())
        columns.append(texts)
    return pa.RecordBatch.from_arrays([*[batch.column(x) for x in names], *columns], [*names, *added])


def _judge(batches, index: LineIndex, host_col: str, text_col: str, names: list[str], added: list[str], *limits):
    held = list(dict.fromkeys([*names, *[text_col] * ("cleaned" in added)]))
    return probed(batches, index, text_col, lambda b: _look(b, host_col, text_col, held), lambda *x: _verdict(*x, text_col, names, added, *limits))


def judged(docs: DataFrame, host_col: str = "source", text_col: str = "text", share: float = SHARE, min_docs: int = MIN_DOCS, most_docs: int = MOST_DOCS, depleted: float = DEPLETED, texts: bool = True) -> DataFrame:
    """``docs`` with the counts, the verdict, and under ``cleaned`` the text without removed lines.

    Without ``texts`` neither text comes back from the Python workers.
    """
    index = frequent_lines(docs, host_col, text_col, min_docs)
    kept = store.without(docs, *ADDED)
    names = [f.name for f in kept.schema if texts or f.name != text_col]
    added = {k: v for k, v in ADDED.items() if texts or k != "cleaned"}
    schema = T.StructType([T.StructField(x, kept.schema[x].dataType, True) for x in names] + [T.StructField(k, T._parse_datatype_string(v)) for k, v in added.items()])
    return mapped(kept, _judge, schema, index, host_col, text_col, names, list(added), share, min_docs, most_docs, depleted)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return judged(docs, texts=False).drop("source")
