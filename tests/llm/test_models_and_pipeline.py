"""SimHash, packing, the classifier and the pipeline."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from lexloom.llm import components, packing, quality_model, quality_rules, simhash, stages, store
from tests.llm.conftest import DOCS, prose
from tests.llm.test_text_operators import lines_by_hand, rules_by_hand

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def print_by_hand(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components_by_hand(prints, radius=4):
    """{fingerprint: smallest id} by union of all close pairs."""
    own = sorted({fp for _, fp in prints})
    parent = {x: x for x in own}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(own, np.uint64)
    for i, x in enumerate(own):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius):
            a, b = sorted((root(x), root(own[j])))
            parent[b] = a
    least = defaultdict(lambda: None)
    for doc_id, fp in prints:
        r = root(fp)
        if doc_id is not None and (least[r] is None or doc_id < least[r]):
            least[r] = doc_id
    return {x: least[root(x)] for x in own}


def test_fingerprints_by_hand(odd, clashing, none):
    rows = [(r["doc_id"], print_by_hand(r["text"])) for r in odd.collect()]
    want = components_by_hand(rows)
    for docs in (odd, clashing):
        got = simhash.near_components(simhash.fingerprints(docs)).collect()
        unsigned = lambda x: x & (1 << 64) - 1
        assert Counter((r["doc_id"], unsigned(r["fp"]), r["component_id"]) for r in got) == Counter((d, f, want[f]) for d, f in rows)
    assert simhash.near_components(simhash.fingerprints(none)).count() == 0


def test_tiles_lose_no_link(spark, monkeypatch):
    """Chains, a dense ball and noise over many small tiles give the components of all pairs."""
    monkeypatch.setattr(simhash, "TILE", 32)
    random = np.random.default_rng(5)
    noise = random.integers(0, 1 << 63, 400).astype(np.uint64)
    flips = lambda x, n: x ^ np.bitwise_or.reduce(np.uint64(1) << random.choice(64, n, replace=False).astype(np.uint64))
    chain = [noise[0]]
    for _ in range(60):
        chain.append(flips(chain[-1], 3))
    ball = [flips(noise[1], int(k)) for k in random.integers(1, 3, 200)]
    all_prints = np.array([*noise, *chain, *ball], np.uint64)
    rows = [(1000 - i, int(np.uint64(x).astype(np.int64))) for i, x in enumerate(all_prints)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_components(spark.createDataFrame(rows, "doc_id bigint, fp bigint")).collect()}
    want = components_by_hand([(d, int(np.int64(f).astype(np.uint64))) for d, f in rows])
    assert got == {d: want[int(np.int64(f).astype(np.uint64))] for d, f in rows}


def test_null_ids_neither_join_nor_name(spark):
    """Near fingerprints of rows without an id join nothing else and name no component."""
    far = 0x0F0F0F0F0F0F0F0F
    rows = [(5, 0), (None, 1), (None, far), (9, far ^ 1), (None, -1), (None, -2)]
    got = simhash.near_components(spark.createDataFrame(rows, "doc_id bigint, fp bigint")).collect()
    assert {(r["doc_id"], r["fp"], r["component_id"]) for r in got} == {(5, 0, 5), (None, 1, 5), (None, far, 9), (9, far ^ 1, 9), (None, -1, None), (None, -2, None)}


def test_random_fingerprints_with_null_ids_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 64)
    random = np.random.default_rng(12)
    heart = random.integers(0, 1 << 63, 60).astype(np.uint64)
    prints = [int(heart[random.integers(60)] ^ np.bitwise_or.reduce(np.uint64(1) << random.integers(0, 64, int(random.integers(0, 4))).astype(np.uint64), initial=np.uint64(0))) for _ in range(500)]
    rows = [(None if random.random() < 0.2 else int(random.integers(0, 400)), fp) for fp in prints]
    rows += rows[:50]
    signed = [(d, int(np.uint64(f).astype(np.int64))) for d, f in rows]
    got = simhash.near_components(spark.createDataFrame(signed, "doc_id bigint, fp bigint")).collect()
    want = components_by_hand(rows)
    unsigned = lambda x: x & (1 << 64) - 1
    assert Counter((r["doc_id"], unsigned(r["fp"]), r["component_id"]) for r in got) == Counter((d, f, want[f]) for d, f in rows)


def test_near_dedup_leaves_one_row_of_each_component(spark):
    a, b = " ".join(prose(1).split()), " ".join(prose(2).split())
    near = a.split(" ")
    near[60] = "other"
    rows = [(4, a), (4, a), (4, a), (7, " ".join(near)), (None, a), (None, b), (None, b), (8, prose(3)), (4, prose(4))]
    docs = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in rows], DOCS)
    got = [(r["doc_id"], r["text"]) for r in stages.simhash_near_dedup(spark, docs, "").collect()]
    assert Counter(got) == Counter([(4, a), (None, b), (8, prose(3)), (4, prose(4))])


def test_forest_is_small_and_complete():
    a = np.zeros(50, np.uint64)
    forest = simhash.Forest(100)
    for i, j in simhash._links(a, a, 4):
        forest.add(i, j + 50)
    assert sum(x.size for x, _ in forest.used) == 99 and set(forest.label) == {0}


def test_components_of_awkward_graphs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100} and got[301] == got[300] == 300


def test_boundaries_are_optimal():
    random = np.random.default_rng(8)
    for _ in range(40):
        size, buckets = int(random.integers(1, 9)), int(random.integers(1, 5))
        counts, longest = random.integers(1, 20, size), np.sort(random.choice(100, size, replace=False)) + 1

        def padded(last, counts=counts, longest=longest):
            start, total = 0, 0
            for j in last:
                total += counts[start : j + 1].sum() * longest[j]
                start = j + 1
            return total

        from itertools import combinations

        best = min(padded([*inner, size - 1]) for n in range(min(buckets, size)) for inner in combinations(range(size - 1), n))
        got = packing.boundaries(counts, longest, buckets)
        assert got[-1] == size - 1 and len(got) <= buckets and padded(got) == best


def test_layers_are_those_of_all_pairs():
    """With many lengths, long ones too: each step's best against all pairs."""
    random = np.random.default_rng(4)
    for size in (1, 2, 3, 50, 700):
        longest = np.sort(random.choice(16_000, size, replace=False)).astype(np.float64) + 1
        total = np.concatenate([[0], np.cumsum(random.integers(1, 50, size))]).astype(np.float64)
        least = total[1:] * longest
        for _ in range(3):
            best, where = packing._layer(least, total, longest)
            for j in range(1, size):
                cost = least[:j] + longest[j] * (total[j + 1] - total[1 : j + 1])
                assert best[j] == cost.min() == cost[where[j]]
            least = np.minimum(least, best)


def test_long_documents_are_batches_of_their_own(spark):
    from pyspark.sql import functions as F

    lengths = [*range(500, 620), 5000, 16_384, 16_385, 40_000, 40_000]
    rows = [(None, n) for n in lengths]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, n bigint").withColumn("text", F.lit("")), F.col("n")).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(lengths)
    batches = defaultdict(list)
    for r in got:
        batches[r["batch_id"]].append(r)
    for own in batches.values():
        assert len({r["padded_tokens"] for r in own}) == 1 and all(r["n_tokens"] <= r["padded_tokens"] for r in own)
        assert len(own) * own[0]["padded_tokens"] <= packing.BUDGET or len(own) == 1 and own[0]["n_tokens"] == own[0]["padded_tokens"]


def test_rows_without_ids_meet_in_no_one_cell(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "CELL_ROWS", 50)
    got = packing.pack(spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(100).alias("n"), F.lit("").alias("text")), F.col("n")).collect()
    cells = Counter(r["batch_id"].rsplit("-", 1)[0] for r in got)
    assert len(cells) == 40 and max(cells.values()) < 100


def test_packing_holds_every_row_once(spark, odd, clashing, none):
    for docs in (odd, clashing):
        rows = packing.pack(docs, budget=600).collect()
        want = Counter((r["doc_id"], len(re.findall("[^\x20\x09-\x0d]+", r["text"] or ""))) for r in docs.collect())
        assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == want
        batches = defaultdict(list)
        for r in rows:
            assert r["n_tokens"] <= r["padded_tokens"]
            batches[r["batch_id"]].append(r)
        for own in batches.values():
            assert sorted(r["batch_place"] for r in own) == list(range(len(own)))
            assert len(own) == 1 or len(own) * own[0]["padded_tokens"] <= 600
            assert len({r["bucket"] for r in own}) == 1
    assert packing.pack(none).count() == 0


def test_one_bucket_is_dealt_to_cells(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_ROWS", 10)
    docs = spark.range(200).selectExpr("id AS doc_id", "'a b c' AS text")
    rows = packing.pack(docs, budget=12).collect()
    sizes = Counter(r["batch_id"] for r in rows)
    assert len(rows) == 200 and max(sizes.values()) == 4 and len({x.rsplit("-", 1)[0] for x in sizes}) > 10


def labelled(spark, n=600):
    rows, marks = [], []
    for i in range(n):
        good = i % 4 != 0
        rows.append((i, prose(i) if good else " ".join(f"{w}***" for w in prose(i).split()), "en", "s", 1))
        marks.append((i, int(good), 0))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def test_classifier_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    got = quality_model.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 60 and sum(r["predicted"] == r["quality"] for r in got) / len(got) > 0.95


def test_held_out_labels_are_never_learnt(spark):
    docs, labels = labelled(spark, 200)
    lied = labels.withColumn("quality", quality_model.F.expr("CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END"))
    scores = lambda marks: {r["doc_id"]: r["score"] for r in quality_model.score(docs, marks).collect()}
    assert scores(labels) == scores(lied)


def test_classifier_on_awkward_rows(spark, odd, clashing, none):
    _, labels = labelled(spark, 24)
    for docs in (odd, clashing):
        got = quality_model.score(docs, labels).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
        assert len({r["score"] for r in got if not (r["text"] or "").strip()}) == 1
    assert quality_model.score(none, labels).count() == 0
    assert {r["score"] for r in quality_model.score(odd, labels.where("false")).collect()} == {0.5}
    odd_labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (3, 1, 0), (3, 0, 0), (9999, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert quality_model.score(odd, odd_labels).count() == odd.count()


def test_temperature_lowers_the_loss():
    random = np.random.default_rng(1)
    x = random.normal(size=(600, 8))
    y = (x[:, 0] + random.normal(scale=2, size=600) > 0).astype(float)
    network = quality_model.Network(x[:300], y[:300])
    loss = lambda: -np.mean(np.log(np.where(y[300:] > 0, network.scores(x[300:]), 1 - network.scores(x[300:]))))
    before = loss()
    network.calibrate(x[300:], y[300:])
    assert loss() <= before and network.temperature > 1


def test_pipeline_by_hand(spark, tmp_path):
    """Stage by stage: what each is given, and what it must leave, by brute force."""
    docs, labels = labelled(spark, 400)
    shared = "one line that a few of the documents share in full"
    extra = [(500 + i, prose(700 + i) + "\n" + shared, "en", "s", 1) for i in range(4)] + [(600, prose(1), "en", "t", 1), (601, prose(1) + " more", "en", "t", 1), (602, "too short", "en", "t", 1), (603, None, None, None, None)]
    docs.unionByName(spark.createDataFrame(extra, DOCS)).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = held.collect()
        held = store.materialise(stage(spark, held, str(tmp_path)), name)
        after = held.collect()
        seen.append(name)
        ids = sorted((r["doc_id"] for r in after), key=str)
        if name != "packing":
            assert held.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality_classifier":
            scored = quality_model.score(spark.createDataFrame(before, DOCS), labels).where("predicted = 1").collect()
            assert ids == sorted((r["doc_id"] for r in scored), key=str) and 0 < len(after) < len(before)
        elif name == "quality_rules":
            want = rules_by_hand([(r["doc_id"], r["source"], r["text"]) for r in before], quality_rules.SHARE, quality_rules.MIN_DOCS, quality_rules.DEPLETED)
            assert ids == sorted((x[0] for x in want if x[-1]), key=str) and 602 not in ids
        elif name == "line_dedup":
            want = Counter((d, text) for d, _, _, text in lines_by_hand([(r["doc_id"], r["text"]) for r in before]).elements() if text.strip())
            assert Counter((r["doc_id"], r["text"]) for r in after) == want and sum(shared in r["text"] for r in after) == 1
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "simhash_near_dedup":
            prints = [(r["doc_id"], print_by_hand(r["text"])) for r in before]
            want = components_by_hand(prints)
            assert ids == sorted({want[f] for _, f in prints}, key=str)
        else:
            assert ids == sorted((r["doc_id"] for r in before), key=str)
    assert seen == ["quality_classifier", "quality_rules", "line_dedup", "simhash_near_dedup", "packing"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == held.count()


@pytest.mark.parametrize("stage", [f for n, f in corpus_pipeline.STAGES if n != "packing"])
def test_stages_take_empty_tables(spark, none, tmp_path, stage):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert stage(spark, none, str(tmp_path)).count() == 0
    assert stages.packing(spark, none, str(tmp_path)).count() == 0
