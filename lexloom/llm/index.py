"""A sharded minimal perfect hash over 128-bit keys, with arrays for the values.

The keys are split over shards by hash; a shard holds the bit levels of its hash function (some
four bits a key) and, at the slot of each key, a 64-bit fingerprint, a 32-bit count that stops at
its largest value, and where they are asked for the 64-bit largest holder: 12 or 20 bytes a key.
An absent key passes for present once in 1.8e19 probes.  A shard has about ``SHARD_KEYS`` keys
whatever the corpus, some 5 MB.

Documents are probed by ``probed``: a task first passes over its documents, keeps their batches
compressed and the hashes of their lines, then opens each shard that it needs once, in turn, and at
last passes over its documents again with what was found.  It holds about what its split takes in
Parquet, 16 bytes a line, and ``KEPT_SHARDS`` shards; a split beyond ``HELD_BYTES`` is done in
several such rounds.
"""

from __future__ import annotations

import ctypes
import itertools
import math
from collections import OrderedDict
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.ipc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import store, text as tx

SHARD_KEYS = 1 << 18
#: Bits per pending key of a level; two leave about six keys in ten placed by each level.
GAMMA = 2.0
KEPT_SHARDS = 4
#: Compressed batches and line hashes that a task holds before it probes.
HELD_BYTES = 128 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit moves about half of the output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xCA5A826395121157)
    x ^= x >> np.uint64(32)
    return x


def _places(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return mixed(low ^ mixed(high + salt)) % np.uint64(size)


class PerfectHash:
    """Level by level, keys alone at their bit take it; the others go to the next level.

    The slot of a key is the number of set bits before its own, so slots fill 0..n-1.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.starts = np.concatenate([[0], np.cumsum(sizes // 64)]).astype(np.int64)

    @classmethod
    def over(cls, low: np.ndarray, high: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while low.size:
            if len(sizes) > 200:
                raise ValueError("keys are repeated")
            size = 64 * max(1, math.ceil(GAMMA * low.size / 64))
            at = _places(low, high, len(sizes), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = ~alone[at]
            low, high = low[left], high[left]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64))

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot or -1 for what is no key."""
        out = np.full(low.size, -1, np.int64)
        todo = np.arange(low.size)
        for level, size in enumerate(self.sizes):
            if not todo.size:
                break
            at = _places(low[todo], high[todo], level, int(size)).astype(np.int64)
            word = self.words[self.starts[level] + (at >> 6)]
            bit = (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (self.before[self.starts[level] + (at >> 6)] + below)[hit]
            todo = todo[~hit]
        return out


SHARD_SCHEMA = "shard int, sizes binary, words binary, marks binary, counts binary, holders binary"


def _shard_rows(keys: pd.DataFrame) -> pd.DataFrame:
    low, high = keys["lo"].to_numpy(np.int64).view(np.uint64), keys["hi"].to_numpy(np.int64).view(np.uint64)
    found = PerfectHash.over(low, high)
    at = found.slots(low, high)
    marks, counts = np.empty(at.size, np.uint64), np.empty(at.size, np.uint32)
    marks[at], counts[at] = high, np.minimum(keys["n"].to_numpy(np.int64), (1 << 32) - 1).astype(np.uint32)
    holders = np.empty(at.size if "holder" in keys else 0, np.int64)
    if holders.size:
        holders[at] = keys["holder"].to_numpy(np.int64)
    arrays = (found.sizes, found.words, marks, counts, holders)
    return pd.DataFrame([[int(keys["shard"].iloc[0]), *(x.tobytes() for x in arrays)]], columns=[x.split()[0] for x in SHARD_SCHEMA.split(", ")])


class LineIndex:
    """Where the shards are; workers open them with ``find``."""

    def __init__(self, path: str, shards: int):
        self.path, self.shards = path, shards

    @classmethod
    def build(cls, keys: DataFrame, label: str) -> LineIndex:
        """``keys``: distinct (lo, hi) with n, and with holder if that is to be found too; all long."""
        spark = keys.sparkSession
        store.importable(spark)
        keys = store.materialise(keys, f"{label}-keys")
        shards = max(1, math.ceil(keys.count() / SHARD_KEYS))
        rows = keys.withColumn("shard", F.pmod("lo", F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(_shard_rows, SHARD_SCHEMA)
        return cls(store.write_shared(rows, f"{label}-index", "shard"), shards)

    def find(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and holder of each key; a count of 0 where the index lacks it. Opens a shard once."""
        counts, holders = np.zeros(low.size, np.uint32), np.zeros(low.size, np.int64)
        shard_of = np.mod(low.view(np.int64), self.shards)
        order = np.argsort(shard_of, kind="stable")
        found, starts = np.unique(shard_of[order], return_index=True)
        for shard, own in zip(found.tolist(), np.split(order, starts[1:]), strict=False):
            arrays = _shard(self.path, shard)
            if arrays is None:
                continue
            hashed, marks, n, holder = arrays
            at = hashed.slots(low[own], high[own])
            same = (at >= 0) & (marks[np.maximum(at, 0)] == high[own])
            counts[own[same]] = n[at[same]]
            if holder.size:
                holders[own[same]] = holder[at[same]]
        return counts, holders


_COMPRESSED = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 1))


def _folded(batch: pa.RecordBatch) -> pa.Buffer:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_COMPRESSED) as out:
        out.write_batch(batch)
    return sink.getvalue()


def _unfolded(data: pa.Buffer) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


def probed(batches, index: LineIndex, text_col: str, look, judge):
    """Two passes over a task's batches with one walk over the index between them.

    ``look(batch)`` gives (the batch to hold, what to remember, line digests); ``judge(batch,
    remembered, counts, holders)`` gives the batch that leaves the task.
    """
    held, size = [], 0
    for batch in itertools.chain(store.blocks(batches, text_col), [None]):
        if batch is not None:
            kept, remembered, digests = look(batch)
            low, high = tx.key_arrays(digests)
            held.append((_folded(kept), remembered, low, high))
            size += held[-1][0].size + 2 * low.nbytes
        if held and (batch is None or size > HELD_BYTES):
            counts, holders = index.find(np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held]))
            at = 0
            for data, remembered, low, _ in held:
                own = slice(at, at := at + low.size)
                yield judge(_unfolded(data), remembered, counts[own], holders[own])
            held, size = [], 0


_open: OrderedDict = OrderedDict()


def _shard(path: str, shard: int):
    """The arrays of a shard, the last few of which a worker keeps."""
    if (path, shard) not in _open:
        fs, _ = store.file_system(path)
        files = store.data_files(f"{path}/shard={shard}")
        arrays = None
        if files:
            row = pq.ParquetFile(fs.open_input_file(files[0])).read().to_pylist()[0]
            get = lambda name, kind: np.frombuffer(row[name], kind)
            arrays = PerfectHash(get("sizes", np.int64), get("words", np.uint64)), get("marks", np.uint64), get("counts", np.uint32), get("holders", np.int64)
        _open[path, shard] = arrays
        while len(_open) > KEPT_SHARDS:
            _open.popitem(last=False)
    _open.move_to_end((path, shard))
    return _open[path, shard]


BATCH_BYTES, BATCH_KEY = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def mapped(df: DataFrame, function, schema, *args) -> DataFrame:
    """``mapInArrow`` with a function of a module and its settings.

    Long texts make batches of many rows large, on the JVM's side outside its heap, so the
    session's bound on the bytes of a batch is lowered to ``BATCH_BYTES`` where it is higher.
    A plan reads the setting when it runs, which may be after this call, so it stays lowered.
    """
    spark = df.sparkSession
    store.importable(spark)
    bound = spark.conf.get(BATCH_KEY).rstrip("bB")
    if not bound.isdigit() or not 0 < int(bound) <= BATCH_BYTES:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    return df.mapInArrow(partial(_call, function, args), schema)


def _call(function, args, batches):
    try:
        yield from function(batches, *args)
    finally:
        _give_back()


def _give_back() -> None:
    """A worker that waits for its next task keeps no free memory."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


_libc = ctypes.CDLL(None)
