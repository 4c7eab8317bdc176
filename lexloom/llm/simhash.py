"""SimHash near-dedup by tiled exact comparison.

A document's fingerprint takes the majority of each bit over the hashes of its word shingles.
Equal fingerprints collapse to one row first, so copies cost nothing further.  The distinct
fingerprints are sorted by the population counts of their four 16-bit quarters and cut into
tiles; the differences of those counts add up to at most the Hamming distance, so a pair of tiles
whose boxes of counts lie further apart than the radius holds no link and is skipped.  All other
pairs are compared in full with exclusive-or and bit counts.  Links of a tile are reduced to a
spanning forest before they leave the task, so a dense ball of near copies gives as many rows as
it has members and not their square.

Work is quadratic in the number of distinct fingerprints, less the skipped pairs; that is the
price of exactness, and it is spread over tasks evenly as every tile has about the same size.

Defined results: a null, empty or blank text has fingerprint zero and links like any other; texts
of fewer words than a shingle hash their whole word sequence; repeated rows share a component;
rows with a null id link like any other and get their component, whose name is the smallest id
among its rows and null only if every one is; ids are cast to long, so a text that is no number
fails; a very long text is hashed whole, in blocks of 8,192 shingles; an empty table gives an empty
table; further columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import store, text as tx
from lexloom.llm.components import named_components
from lexloom.llm.index import mapped

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE = 2048
#: Bytes of tiles that a worker keeps open.
KEPT_BYTES = 64 << 20
_BITS = np.arange(64, dtype=np.uint64)


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of all word shingles of a text in a row, repeated ones too."""
    words = tx.words_of((text or "")) if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words).lower()
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([hashed(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    view = memoryview(joined)
    count = len(words) - shingle + 1
    return np.fromiter((hashed(view[a:b], SEED) for a, b in zip(starts[:count].tolist(), ends[shingle - 1 :].tolist(), strict=True)), np.uint64, count)


def majority(h: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    if h.size < 2:
        return int(h[0]) if h.size else 0
    ones = np.zeros(64, np.int64)
    for at in range(0, h.size, 8192):
        ones += np.unpackbits(h[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.bitwise_or.reduce(np.where(2 * ones > h.size, np.uint64(1) << _BITS, np.uint64(0))))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, shingle))


def _prints(batches, shingle: int):
    for batch in batches:
        prints = np.array([fingerprint(x, shingle) for x in batch.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long."""
    return mapped(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), _prints, "doc_id long, fp long", shingle)


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view(np.uint16).reshape(-1, 4))


TILE_SCHEMA = "tile long, low binary, high binary, fps binary"


def _tiles(batches, size: int):
    """Sorted rows in, a row for each run of ``size`` out."""
    from pyspark import TaskContext

    number, fps = TaskContext.get().partitionId() << 32, np.zeros(0, np.int64)
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            fps = np.append(fps, batch.column("fp").to_numpy())
        while fps.size >= size or (batch is None and fps.size):
            counts = _quarters(fps[:size].copy())
            cells = (number, counts.min(0).tobytes(), counts.max(0).tobytes(), fps[:size].tobytes())
            yield pa.RecordBatch.from_pydict(dict(zip(("tile", "low", "high", "fps"), [[x] for x in cells], strict=True)))
            number, fps = number + 1, fps[size:]


_tables: dict = {}
_rows: OrderedDict = OrderedDict()


def _boxes(path: str):
    """(file, tile, low, high) arrays over all tiles: 20 bytes a tile."""
    if path not in _tables:
        _tables.clear()
        fs, _ = store.file_system(path)
        files, numbers, tiles, low, high = store.data_files(path), [], [], [], []
        for i, name in enumerate(files):
            got = pq.ParquetFile(fs.open_input_file(name)).read(["tile", "low", "high"])
            numbers += [i] * got.num_rows
            tiles += got.column("tile").to_pylist()
            low += got.column("low").to_pylist()
            high += got.column("high").to_pylist()
        box = lambda x: np.frombuffer(b"".join(x), np.uint8).reshape(-1, 4).astype(np.int16)
        _tables[path] = files, np.array(numbers, np.int64), np.array(tiles, np.int64), box(low), box(high)
    return _tables[path]


def _file(path: str, name: str) -> dict:
    if (path, name) not in _rows:
        fs, _ = store.file_system(path)
        got = pq.ParquetFile(fs.open_input_file(name)).read(["tile", "fps"]).to_pydict()
        _rows[path, name] = {t: np.frombuffer(x, np.uint64) for t, x in zip(got["tile"], got["fps"], strict=True)}
        while len(_rows) > 1 and sum(x.nbytes for f in _rows.values() for x in f.values()) > KEPT_BYTES:
            _rows.popitem(last=False)
    _rows.move_to_end((path, name))
    return _rows[path, name]


def _links(a: np.ndarray, b: np.ndarray, radius: int, step: int = 256):
    """Index pairs within the radius, a block of rows at a time."""
    for at in range(0, a.size, step):
        near = np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius
        if near.any():
            i, j = np.nonzero(near)
            yield i + at, j


class Forest:
    """Which links join what was apart: labels are the smallest index of a tree."""

    def __init__(self, size: int):
        self.label, self.used = np.arange(size), []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            order = np.lexsort((low, high))
            first = order[np.concatenate([[True], np.diff(high[order]) > 0])]
            self.used.append((i[first], j[first]))
            root = np.arange(self.label.size)
            root[high[first]] = low[first]
            while (root != root[root]).any():
                root = root[root]
            self.label = root[self.label]


def _compare(batches, path: str, radius: int):
    for batch in batches:
        for tile in batch.column("tile").to_pylist():
            files, number, tiles, low, high = _boxes(path)
            mine = int(np.flatnonzero(tiles == tile)[0])
            gap = np.maximum(0, np.maximum(low - high[mine], low[mine] - high)).sum(1)
            others = np.flatnonzero((gap <= radius) & (tiles >= tile))
            a = _file(path, files[number[mine]])[tile]
            for other in others[np.lexsort((tiles[others], number[others]))]:
                b = _file(path, files[number[other]])[int(tiles[other])]
                forest = Forest(a.size + b.size)
                for i, j in _links(a, b, radius):
                    forest.add(i, j + a.size)
                if forest.used:
                    both = np.concatenate([a, b]).view(np.int64)
                    out = [both[np.concatenate([x[k] for x in forest.used])] for k in (0, 1)]
                    apart = out[0] != out[1]
                    yield pa.RecordBatch.from_arrays([pa.array(x[apart]) for x in out], ["a", "b"])


def near_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of rows (doc_id, fp).

    The nodes of the graph are the distinct fingerprints, so what links them does not depend on
    ids; a component takes its name from the smallest id of its rows in a last aggregation.
    """
    spark = prints.sparkSession
    prints = store.materialise(prints, "prints")
    groups = store.materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "groups")
    count = groups.count()
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    cell = quarters[0]
    for q in quarters[1:]:
        cell = cell * 17 + q
    parts = max(1, math.ceil(count / (8 * TILE)))
    ordered = groups.withColumn("cell", cell).repartitionByRange(parts, "cell", "fp").sortWithinPartitions("cell", "fp").select("fp")
    path = store.write_shared(mapped(ordered, _tiles, TILE_SCHEMA, TILE), "tiles")
    tiles = spark.read.parquet(path).select("tile")
    spread = max(1, min(tiles.count(), max(3 * spark.sparkContext.defaultParallelism, count // (32 * TILE))))
    edges = mapped(tiles.repartition(spread), _compare, "a long, b long", path, radius)
    named = named_components(groups.select(F.col("fp").alias("node"), "least_id"), edges).select(F.col("node").alias("own"), "component_id")
    out = prints.join(named, prints["fp"] == named["own"])
    return out.select("doc_id", "fp", "component_id")


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_components(fingerprints(docs))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
