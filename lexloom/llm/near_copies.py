"""Near copies by word shingles: SimHash candidates, exact Jaccard on every candidate pair.

Texts with the same set of shingles collapse to one row first.  The others are sorted by the size
of their sets and cut into tiles; a pair of similarity s has sizes whose ratio is s at least, so
tiles of sizes too far apart hold no pair and are skipped.  The rest are compared in full with
exclusive-or and bit counts under ``CANDIDATE_RADIUS``, and each candidate pair that is not joined
yet inside its pair of tiles is verified on the shingles of both texts.  So a dense ball of near
copies takes about as many verifications as it has members, and only verified links leave a task.

Texts move once: tasks pass on one row of each set that they see, a histogram of the sizes on a log
scale (of a few thousand bins at most) says which sizes share a partition, and a partition is written
as it is sorted, its tiles numbered.  A task that compares reads the fingerprints of a file of tiles
together, and the texts of a tile, from its row groups, when a candidate needs them.

At similarity 0.8 the cosine of two sets is 0.89, an expected distance of 9.7 of 64 bits with a
deviation of 2.9; the radius lies more than two deviations above.

Defined results: a null, empty or blank text has no shingle and equals only its like; texts of
fewer words than a shingle have their whole word sequence as the only one; repeated rows share a
component; rows with a null id link like any other, and a component's name is the smallest id among
its rows, null only if every one is; ids are cast to long; texts of any length are compared whole,
one of very many shingles in a tile of its own; an empty table gives an empty table; further columns
are not read, and ``one_of_each`` passes them through.
"""

from __future__ import annotations

import math
import os
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import simhash, store, text as tx
from lexloom.llm.components import named_components
from lexloom.llm.index import mapped
from lexloom.llm.marks import Marks

SHINGLE, SIMILARITY, CANDIDATE_RADIUS = 5, 0.8, 16
#: Texts of a tile, and shingles of a tile unless one text has more.
TILE, TILE_SHINGLES = 2048, 1 << 18
#: Tiles of a partition, about, and bins of sizes for each doubling.
PART_TILES, BINS = 4, 64
#: Bytes of fingerprints that a worker keeps open, and tiles whose texts it keeps.
KEPT_BYTES, KEPT_TEXTS = 32 << 20, 3
#: Bytes of a row group of written tiles.
GROUP_BYTES = 4 << 20
_PRINTS = {"doc_id": "long", "key": "long", "fp": "long", "n": "long", "text": "string", "text_hash": "long"}


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a text, in order."""
    return np.unique(simhash.shingle_hashes(text, shingle))


def _prints(batches, shingle: int, names: list[str]):
    """The columns asked for; with the text, only the first row of each set that the task sees."""
    seen: set[int] = set()
    for batch in store.blocks(batches, "text", 4 << 20):
        texts, keys, prints, sizes = batch.column("text").to_pylist(), [], [], []
        # As Spark's xxhash64 gives it: the seed for null.
        marks = [simhash.SEED if x is None else xxhash.xxh64_intdigest(x, simhash.SEED) for x in texts] if "text_hash" in names else []
        rows = []
        for i, text in enumerate(texts):
            hashes = simhash.shingle_hashes(text, shingle)
            own = np.unique(hashes)
            key = xxhash.xxh64_intdigest(own.tobytes())
            if "text" in names:
                if key in seen:
                    continue
                seen.add(key)
            rows.append(i)
            keys.append(key)
            prints.append(simhash.majority(hashes) if "fp" in names else 0)
            sizes.append(own.size)
        signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        kept = batch if len(rows) == batch.num_rows else batch.take(pa.array(rows, pa.int32()))
        columns = {"doc_id": kept.column("doc_id"), "key": signed(keys), "fp": signed(prints), "n": pa.array(sizes, pa.int64()), "text": kept.column("text"), "text_hash": signed(marks)}
        yield pa.RecordBatch.from_pydict({x: columns[x] for x in names})


TILE_SCHEMA = "tile long, fp long, key long, n long, text string"


def _tiles(batches, size: int, most: int):
    """Rows in order of n, fp and key in, the same with their tile out, one of each key."""
    from pyspark import TaskContext

    number, rows, shingles, last = TaskContext.get().partitionId() << 32, 0, 0, None
    for batch in batches:
        kept, tiles = [], []
        for i, (key, n) in enumerate(zip(batch.column("key").to_pylist(), batch.column("n").to_pylist(), strict=True)):
            if key == last:
                continue
            last = key
            if rows == size or rows and shingles + n > most:
                number, rows, shingles = number + 1, 0, 0
            rows, shingles = rows + 1, shingles + n
            kept.append(i)
            tiles.append(number)
        out = batch.take(pa.array(kept, pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(tiles, pa.int64()), *[out.column(x) for x in ("fp", "key", "n", "text")]], ["tile", "fp", "key", "n", "text"])


class _File:
    """The fingerprints of the tiles of a written file; their texts are read once a candidate needs them."""

    def __init__(self, fs, name: str):
        self.fs, self.name = fs, name
        with fs.open_input_file(name) as file:
            got = pq.ParquetFile(file).read(["tile", "fp", "key", "n"])
        self.tiles, self.fps, self.keys, self.ns = (got.column(x).to_numpy() for x in ("tile", "fp", "key", "n"))
        self.fps = self.fps.view(np.uint64)
        self.nbytes = 32 * self.fps.size

    def texts(self, tile: int) -> pa.Array:
        found = []
        with self.fs.open_input_file(self.name) as opened:
            file = pq.ParquetFile(opened)
            place = file.schema_arrow.get_field_index("tile")
            for group in range(file.num_row_groups):
                range_ = file.metadata.row_group(group).column(place).statistics
                if range_ is None or not range_.has_min_max or range_.min <= tile <= range_.max:
                    got = file.read_row_group(group, ["tile", "text"])
                    found.append(got.filter(pa.compute.equal(got.column("tile"), tile)).column("text"))
        return pa.chunked_array([c for x in found for c in x.chunks], pa.string())


class _Tile:
    """A tile's arrays, and the shingle sets of its texts as far as they were needed."""

    def __init__(self, file: _File, tile: int):
        self.file, self.tile = file, tile
        own = slice(*np.searchsorted(file.tiles, [tile, tile + 1]))
        self.fps, self.keys, self.ns = file.fps[own], file.keys[own], file.ns[own]

    def set_of(self, i: int, shingle: int) -> np.ndarray:
        held = _texts.get((self.file.name, self.tile))
        if held is None:
            held = _texts[self.file.name, self.tile] = self.file.texts(self.tile), {}
            while len(_texts) > KEPT_TEXTS:
                _texts.popitem(last=False)
        _texts.move_to_end((self.file.name, self.tile))
        texts, sets = held
        if i not in sets:
            sets[i] = shingle_set(texts[i].as_py(), shingle)
        return sets[i]


_tables: dict = {}
_files: OrderedDict = OrderedDict()
_texts: OrderedDict = OrderedDict()


def _boxes(path: str, boxes: str):
    """(tile, least, most) arrays and the file of each tile, in order of tiles."""
    if path not in _tables:
        for cache in (_tables, _files, _texts):
            cache.clear()
        fs, _ = store.file_system(path)
        names = {os.path.basename(x): x for x in store.data_files(path)}
        got = store.read_table(boxes).sort_by("tile")
        _tables[path] = fs, [names[x] for x in got.column("file").to_pylist()], *(got.column(x).to_numpy() for x in ("tile", "least", "most"))
    return _tables[path]


def _file(fs, name: str) -> _File:
    if name not in _files:
        _files[name] = _File(fs, name)
        while len(_files) > 2 and sum(x.nbytes for x in _files.values()) > KEPT_BYTES:
            _files.popitem(last=False)
    _files.move_to_end(name)
    return _files[name]


def alike(own: np.ndarray, others: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which of the other sets have a Jaccard similarity of ``similarity`` or more to ``own``; none is empty."""
    sizes = np.array([x.size for x in others])
    joined = np.concatenate(others)
    hit = own[np.minimum(np.searchsorted(own, joined), own.size - 1)] == joined
    shared = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return shared / (own.size + sizes - shared) >= similarity


def _verified(a: _Tile, b: _Tile, shingle: int, similarity: float, radius: int):
    """Links of similar texts between two tiles, as a spanning forest of them."""
    label, links, base = np.arange(a.fps.size + (0 if a is b else b.fps.size)), [], 0 if a is b else a.fps.size
    for rows, found in simhash._links(a.fps, b.fps, radius):
        small, large = np.minimum(a.ns[rows], b.ns[found]), np.maximum(a.ns[rows], b.ns[found])
        fits = (small > 0) & (small >= similarity * large)
        if a is b:
            fits &= rows < found
        rows, found = rows[fits], found[fits]
        cuts = np.flatnonzero(np.diff(rows)) + 1
        for own in np.split(np.arange(rows.size), cuts) if rows.size else []:
            i, rest, take = int(rows[own[0]]), found[own], 1
            while True:
                rest = rest[label[rest + base] != label[i]]
                if not rest.size:
                    break
                tried, rest = rest[:take], rest[take:]
                take *= 4
                good = tried[alike(a.set_of(i, shingle), [b.set_of(int(j), shingle) for j in tried], similarity)]
                for j in good.tolist():
                    if label[j + base] != label[i]:
                        label[label == label[j + base]] = label[i]
                        links.append((i, j))
    return links


def _compare(batches, path: str, boxes: str, shingle: int, similarity: float, radius: int):
    for batch in batches:
        for tile in batch.column("tile").to_pylist():
            fs, files, tiles, least, most = _boxes(path, boxes)
            mine = int(np.searchsorted(tiles, tile))
            a = _Tile(_file(fs, files[mine]), tile)
            for other in np.flatnonzero((tiles >= tile) & (most >= similarity * least[mine]) & (most[mine] >= similarity * least)).tolist():
                b = a if other == mine else _Tile(_file(fs, files[other]), int(tiles[other]))
                links = _verified(a, b, shingle, similarity, radius)
                if links:
                    i, j = np.array(links).T
                    yield pa.RecordBatch.from_arrays([pa.array(a.keys[i]), pa.array(b.keys[j])], ["a", "b"])
    for cache in (_files, _texts):
        cache.clear()


def _parts(sizes: list[tuple[int, int, int]], rows: int, shingles: int) -> tuple[list[tuple[int, int, int]], int]:
    """(bin, first partition, partitions) of each bin of sizes (bin, texts, shingles), and partitions in all.

    Small bins next to each other share a partition; a large one has several.
    """
    out, part, held_rows, held_shingles = [], 0, 0, 0
    for number, texts, total in sorted(sizes):
        needed = max(math.ceil(texts / rows), math.ceil(total / shingles))
        if held_rows and (needed > 1 or held_rows + texts > rows or held_shingles + total > shingles):
            part, held_rows, held_shingles = part + 1, 0, 0
        out.append((number, part, needed))
        held_rows, held_shingles = held_rows + texts, held_shingles + total
        if needed > 1:
            part, held_rows, held_shingles = part + needed, 0, 0
    return out, part + 1


def _components(docs: DataFrame, shingle: int, similarity: float, radius: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, root, component_id) of every row; ``root`` tells components apart where names are null."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = lambda *names: mapped(texts, _prints, ", ".join(f"{x} {_PRINTS[x]}" for x in names), shingle, list(names))
    rows = store.materialise(prints("doc_id", "key", "n", "text_hash"), "near-keys")
    own = rows.groupBy(F.col("key").alias("node")).agg(F.min("doc_id").alias("least_id"))
    bin_of = F.floor(BINS * F.log2(F.greatest("n", F.lit(1)))).cast("int")
    sizes = rows.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)), F.sum("n")).collect()  # BINS for each doubling of a text's length
    placed, parts = _parts([tuple(r) for r in sizes], PART_TILES * TILE, PART_TILES * TILE_SHINGLES)
    table = F.broadcast(spark.createDataFrame(placed, "bin int, first int, parts int"))
    dealt = prints("key", "fp", "n", "text").withColumn("bin", bin_of).join(table, "bin").withColumn("part", F.col("first") + F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    ordered = dealt.repartitionById(parts, "part").sortWithinPartitions("n", "fp", "key").select("fp", "key", "n", "text")
    path = store.fresh_path(spark, "near-tiles")
    written = mapped(ordered, _tiles, TILE_SCHEMA, TILE, TILE_SHINGLES).write
    written.option("parquet.block.size", GROUP_BYTES).option("parquet.page.size.row.check.min", 8).parquet(path)
    found = spark.read.schema(TILE_SCHEMA).parquet(path).select("tile", "n", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"))
    found = found.groupBy("tile", "file").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    boxes = store.write_shared(found, "near-boxes")
    tiles = spark.read.parquet(boxes).select("tile")
    spread = max(1, min(tiles.count(), 8 * spark.sparkContext.defaultParallelism))
    edges = mapped(tiles.repartition(spread), _compare, "a long, b long", path, boxes, shingle, similarity, radius)
    named = named_components(own, edges)
    return rows.join(named, rows["key"] == named["node"]).select("doc_id", "text_hash", "root", "component_id")


def similar_components(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = CANDIDATE_RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id): rows are joined over pairs of texts of ``similarity`` or more."""
    return _components(docs, shingle, similarity, radius, id_col, text_col).select("doc_id", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = CANDIDATE_RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, null ids last.

    Among rows that repeat this id the smallest hash of the text decides, and of rows equal in
    both one stays.
    """
    found = store.materialise(_components(docs, shingle, similarity, radius, id_col, text_col), "near-found")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    picked = found.groupBy("root").agg(F.min(place).alias("first")).select(F.coalesce("first.doc_id", F.lit(tx.NO_ID)).alias("_id"), F.col("first.text_hash").alias("_hash"))
    picked = store.materialise(picked, "near-picked")
    # Most rows stay, and they stay where they are read; those that may go move, and a join decides.
    rows = found.groupBy(F.coalesce("doc_id", F.lit(tx.NO_ID)).alias("_id"), F.col("text_hash").alias("_hash")).agg(F.count(F.lit(1)).alias("times"))
    single = rows.where("times = 1").join(picked, ["_id", "_hash"], "left_anti").select("_id", "_hash").unionByName(rows.where("times > 1").select("_id", "_hash"))
    marked = Marks(single.select(F.xxhash64("_id", "_hash").alias("tag")), "tag")
    keyed = docs.withColumns({"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(tx.NO_ID)), "_hash": F.xxhash64(text_col)})
    tested = marked.tested(keyed.withColumn("_tag", F.xxhash64("_id", "_hash")), "_tag", "_marked")
    moved = tested.where("_marked").join(picked, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return tested.where("NOT _marked").select(docs.columns).unionByName(moved.select(docs.columns))
