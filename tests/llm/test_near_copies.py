"""Near copies of the pipeline: components over 5-word Jaccard similarity of 0.8 and more, by brute force."""

from __future__ import annotations

import random
import re

import pytest

from lexloom.llm import near_copies, stages
from tests.llm.conftest import DOCS, prose
from tests.llm.test_models_and_pipeline import LOWER


def shingles_by_hand(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def components_by_hand(rows, similarity=0.8):
    """The smallest id of each row's component; none where no row of it has an id."""
    sets = [shingles_by_hand(text) for _, text in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or len(a & b) >= similarity * len(a | b):
                root = [root[j] if x == root[i] else x for x in root]
    return [min((d for (d, _), r in zip(rows, root, strict=True) if r == own and d is not None), default=None) for own in root]


def edited(text, places, seed):
    words, own = text.split(" "), random.Random(seed)
    for at in own.sample(range(len(words)), places):
        words[at] = f"edit{own.randint(0, 10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def versions(spark):
    """Near copies of 2 to 4 changed words in 200, chains of them, and texts of a similarity below 0.8."""
    base = [" ".join(prose(900 + i, 200).split()) for i in range(30)]
    texts = [*base, *[edited(base[i % 20], 1 + i % 4, i) for i in range(100)], *[edited(base[20 + i % 10], 9, i) for i in range(20)]]
    chain = base[29]
    for i in range(6):
        chain = edited(chain, 3, 50 + i)
        texts.append(chain)
    return spark.createDataFrame([(1000 - i, x, "en", "s", len(x)) for i, x in enumerate(texts)], DOCS).cache()


@pytest.mark.parametrize("tile", [7, 2048])
def test_components_by_hand(versions, odd, clashing, none, tile, monkeypatch):
    monkeypatch.setattr(near_copies, "TILE", tile)
    for docs in (versions, odd, clashing):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        want = sorted(zip([d for d, _ in rows], components_by_hand(rows), strict=True), key=str)
        assert sorted(((r["doc_id"], r["component_id"]) for r in near_copies.similar_components(docs, radius=64).collect()), key=str) == want
        assert sorted(((r["doc_id"], r["component_id"]) for r in near_copies.similar_components(docs).collect()), key=str) == want
    assert near_copies.similar_components(none).count() == 0


def test_stage_removes_edited_copies_and_keeps_others(spark, versions):
    rows = [(r["doc_id"], r["text"]) for r in versions.collect()]
    got = sorted(r["doc_id"] for r in stages.simhash_near_dedup(spark, versions, "").collect())
    assert got == sorted(set(components_by_hand(rows))) and len(got) < len(rows)


def test_rows_without_an_id_join_nothing_else(spark):
    """Two such texts, near different documents, do not join these."""
    base = [" ".join(prose(950 + i, 200).split()) for i in range(2)]
    docs = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in enumerate(base)] + [(None, edited(x, 1, 3), "en", "s", 1) for x in base], DOCS)
    assert {(r["doc_id"], r["component_id"]) for r in near_copies.similar_components(docs).collect()} == {(0, 0), (1, 1), (None, 0), (None, 1)}
