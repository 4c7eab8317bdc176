"""A quality classifier over random-indexing word vectors.

Random indexing over the whole corpus: each of ``WORDS`` word slots (words hash to slots) has a
sparse ternary index vector, and its word vector sums the index vectors of the neighbours of its
occurrences.  Every task sums over its own documents and sends a table of fixed size; the tables
are added in a stream, slot range by slot range, so what reaches the driver is ``WORDS`` rows
whatever the corpus.  A document is the weighted mean of its word vectors.  A two-layer network in
numpy is fitted on labelled documents, ``MOST_LABELLED`` at most (those with the smallest hashes
of their ids), and a temperature is fitted on a part of these that the network has not seen.

Labels are learnt only from rows whose crc32(doc_id as text) mod 5 is not 0.  A score sees the
text alone.

Slots bound the memory at any size of the corpus, at the price that words share one: some 28 words at
45 MB of text, and the rare ones blur.  The README gives held-out accuracy at two sizes.

Defined results: null and empty texts share one score, equal texts have equal scores, and texts of any
length are pooled whole; labels that are null or of unknown documents are passed over, and of repeated
ones the largest counts; of the texts that repeat a labelled id, one is learnt from (the smallest by
its features); rows without an id are scored and not held out; ids keep their type; without any label every score is 0.5; an empty table gives an empty table;
columns named like the added ones are replaced, all others pass through.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lexloom.llm import store, text as tx
from lexloom.llm.index import mapped

WORDS, SIZE, NONZERO, REACH = 1 << 14, 48, 4, 2
MOST_LABELLED, HIDDEN, EPOCHS, THRESHOLD = 20_000, 32, 60, 0.3
ADDED = {"held_out": "boolean", "score": "double", "predicted": "int"}
_RANGE = 512


class _Slots(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        found = self[word] = xxhash.xxh32_intdigest(word) % WORDS
        return found


_slots = _Slots()


@functools.cache
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each slot's index vector."""
    random = np.random.default_rng(7)
    places = np.argsort(random.random((WORDS, SIZE)), axis=1)[:, :NONZERO].astype(np.int32)
    return places, random.choice(np.array([-1, 1], np.int8), (WORDS, NONZERO))


def slots_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The word slots of all texts in a row, and where each text begins."""
    words = [tx.words_of(x) if x else [] for x in texts]
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    get = _slots.__getitem__
    return np.fromiter((get(w) for own in words for w in own), np.int32, int(starts[-1])), starts


def _gather(batches):
    places, signs = index_vectors()
    sums, counts = np.zeros(WORDS * SIZE), np.zeros(WORDS, np.int64)
    for batch in store.blocks(batches, "text", 4 << 20):
        slots, starts = slots_of(batch.column("text").to_pylist())
        counts += np.bincount(slots, minlength=WORDS)
        text = np.repeat(np.arange(starts.size - 1), np.diff(starts))
        for reach in range(1, REACH + 1):
            same = text[reach:] == text[:-reach]
            a, b = slots[:-reach][same].astype(np.int64), slots[reach:][same].astype(np.int64)
            for word, neighbour in ((a, b), (b, a)):
                for k in range(NONZERO):
                    sums += np.bincount(word * SIZE + places[neighbour, k], signs[neighbour, k], WORDS * SIZE)
    if counts.any():
        table = np.column_stack([sums.reshape(WORDS, SIZE), counts])
        for at in range(0, WORDS, _RANGE):
            yield pa.RecordBatch.from_arrays([pa.array([at // _RANGE], pa.int32()), pa.array([table[at : at + _RANGE].astype(np.float64).tobytes()], pa.binary())], ["range", "sums"])


def _add(batches):
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, sums in zip(batch.column("range").to_pylist(), batch.column("sums"), strict=True):
            table = np.frombuffer(sums.as_buffer(), np.float64)
            held[number] = held[number] + table if number in held else table.copy()
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["range", "sums"])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The weighted word vector of each slot: unit length times a weight that falls with frequency."""
    schema = "range int, sums binary"
    gathered = mapped(docs.select(F.col(text_col).alias("text")), _gather, schema)
    table = np.zeros((WORDS, SIZE + 1))
    for row in mapped(gathered.repartition(WORDS // _RANGE, "range"), _add, schema).collect():  # WORDS rows in all
        table[row["range"] * _RANGE : (row["range"] + 1) * _RANGE] = np.frombuffer(row["sums"], np.float64).reshape(_RANGE, SIZE + 1)
    vectors, counts = table[:, :SIZE], table[:, SIZE]
    share = counts / max(1.0, counts.sum())
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(length, 1e-9) * (1e-3 / (1e-3 + share))[:, None]).astype(np.float32)


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """Of each text: the mean and spread of its word vectors, how alike words next to each other
    and one apart are, and its length in words on a log scale."""
    slots, starts = slots_of(texts)
    out = np.zeros((len(texts), 2 * SIZE + 3), np.float32)
    sizes = np.diff(starts)
    lengths = np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)
    for i in np.flatnonzero(sizes):
        held = slots[starts[i] : starts[i + 1]]
        own = vectors[held]
        out[i, :SIZE], out[i, SIZE : 2 * SIZE] = own.mean(0), own.std(0)
        unit = own / lengths[held, None]
        for reach in (1, 2):
            if held.size > reach:
                out[i, 2 * SIZE + reach - 1] = np.einsum("ij,ij->", unit[reach:], unit[:-reach]) / (held.size - reach)
    out[:, -1] = np.log1p(sizes)
    return out


class Network:
    """Two layers, fitted by Adam on the log loss; logits are divided by a temperature.

    Features that hardly vary among the fitted documents are left out, and none counts further
    from the middle than ``FAR`` deviations, so a text unlike all of them is not thrown far off.
    """

    FAR = 4.0

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11):
        self.middle, self.scale = x.mean(0), np.where(x.std(0) > 1e-3, x.std(0), np.inf)
        random = np.random.default_rng(seed)
        self.weights = [random.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        z, step = self._near(x), 0
        for _ in range(EPOCHS):
            for rows in np.array_split(random.permutation(len(y)), max(1, len(y) // 64)):
                step += 1
                for w, g, m, v in zip(self.weights, self._slopes(z[rows], y[rows]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= 3e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _near(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.scale, -self.FAR, self.FAR)

    def _slopes(self, z, y):
        a, b, c, d = self.weights
        hidden = np.maximum(z @ a + b, 0)
        error = (1 / (1 + np.exp(-np.clip(hidden @ c + d, -30, 30))) - y) / len(y)
        back = np.outer(error, c) * (hidden > 0)
        return z.T @ back + 1e-4 * a, back.sum(0), hidden.T @ error + 1e-4 * c, np.array([error.sum()])

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.maximum(self._near(x) @ a + b, 0) @ c + d

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss, over a grid of ratios."""
        raw = self.logits(x)
        loss = lambda t: np.mean(np.logaddexp(0, -np.where(y > 0, raw, -raw) / t))
        self.temperature = float(min(np.geomspace(0.25, 16, 121), key=loss))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fold(id_col: str):
    return F.crc32(F.col(id_col).cast("string")) % 5


_POOLED = [T.StructField("label", T.IntegerType()), T.StructField("fold", T.IntegerType()), T.StructField("x", T.BinaryType())]


def _pool(batches, vectors: np.ndarray):
    for batch in store.blocks(batches, "text", 4 << 20):
        x = pooled(batch.column("text").to_pylist(), vectors)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), batch.column("fold"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "label", "fold", "x"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> tuple[np.ndarray, Network | float]:
    """The word vectors, and the network (or the one score that too few labels allow)."""
    vectors = word_vectors(docs, text_col)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
    known = known.withColumn("fold", fold("doc_id").cast("int")).where("fold <> 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "doc_id")  # ``most`` rows of ids
    pooled_rows = mapped(texts.select("doc_id", "label", "fold", "text"), _pool, T.StructType([texts.schema["doc_id"], *_POOLED]), vectors)
    rows = pooled_rows.groupBy("doc_id").agg(*[F.min(x).alias(x) for x in ("label", "fold", "x")]).collect()  # one of each id, so ``most`` at most
    if not rows:
        return vectors, 0.5
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float64).reshape(len(rows), -1)
    y, part = np.array([r["label"] for r in rows], np.float64), np.array([r["fold"] for r in rows])
    train = part != 1
    if len(set(y[train])) < 2:
        return vectors, float(y[train].mean()) if train.any() else 0.5
    network = Network(x[train], y[train])
    if len(set(y[~train])) == 2:
        network.calibrate(x[~train], y[~train])
    return vectors, network


def _score(batches, text_col: str, vectors: np.ndarray, network: Network | float):
    for batch in store.blocks(batches, text_col, 4 << 20):
        texts = batch.column(text_col).to_pylist()
        scores = np.full(len(texts), network) if isinstance(network, float) else network.scores(pooled(texts, vectors).astype(np.float64))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])


def score(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    vectors, network = fit(docs, labels, label_col, id_col, text_col)
    kept = store.without(docs, *ADDED)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in kept.schema] + [T.StructField("score", T.DoubleType())])
    scored = mapped(kept, _score, schema, text_col, vectors, network)
    held_out = F.coalesce(fold(id_col) == 0, F.lit(False))
    return scored.select(*kept.columns, held_out.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op3_quality_model(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text")
