"""Line dedup, exact dedup, quality rules, license scans against brute force, on awkward rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import exact_dedup, index, license_scan, line_dedup, quality_rules, store, text as tx
from tests.compare import connect, same

SF = "/root/testdata/sf0.01"
WHITE = "[\x20\x09-\x0d]"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return re.sub(f"^{WHITE}+|{WHITE}+$", "", line).translate(LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(("query", "sql"), [(line_dedup.op1_line_dedup, line_dedup.ORACLE_SQL), (exact_dedup.op4_exact_dedup, exact_dedup.ORACLE_SQL)])
def test_oracle(spark, query, sql):
    assert same(query(spark, SF), connect(SF), sql) == 1000


def test_perfect_hash_is_minimal_and_finds_its_keys():
    random = np.random.default_rng(3)
    low, high = (random.integers(0, 1 << 63, 50_000).astype(np.uint64) for _ in range(2))
    hashed = index.PerfectHash.over(low, high)
    assert sorted(hashed.slots(low, high)) == list(range(50_000))
    assert hashed.words.size * 64 < 50_000 * 6
    assert index.PerfectHash.over(low[:0], high[:0]).slots(low[:9], high[:9]).tolist() == [-1] * 9


def test_perfect_hash_with_equal_halves():
    low, high = np.zeros(100, np.uint64), np.arange(100, dtype=np.uint64)
    assert sorted(index.PerfectHash.over(low, high).slots(low, high)) == list(range(100))


def test_index_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(index, "SHARD_KEYS", 50)
    keys = spark.range(1000).select(F.xxhash64("id").alias("lo"), F.xxhash64(F.lit(1), "id").alias("hi"), F.col("id").alias("n"), (F.col("id") * 2).alias("holder"))
    built = index.LineIndex.build(keys, "test")
    assert built.shards == 20
    rows = keys.collect()
    low, high = (np.array([r[x] for r in rows], np.int64).view(np.uint64) for x in ("lo", "hi"))
    counts, holders = built.find(low, high)
    assert counts.tolist() == [r["n"] for r in rows] and holders.tolist() == [r["holder"] for r in rows]
    assert not built.find(low, high + np.uint64(1))[0].any()


def lines_by_hand(rows):
    held = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                held[k].append(tx.NO_ID if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [len(held.get(key(x), [])) >= 3 and max(held[key(x)]) != (tx.NO_ID if doc_id is None else doc_id) for x in lines]
        out.append((doc_id, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return Counter(out)


def test_lines_by_hand(odd, clashing):
    want = lines_by_hand([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert sum(n for _, _, n, _ in want.elements()) > 5
    for docs in (odd, clashing):
        got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in line_dedup.dedup_lines(docs).collect())
        assert got == want


def test_lines_and_rules_over_many_shards(odd, monkeypatch):
    monkeypatch.setattr(index, "SHARD_KEYS", 2)
    assert line_dedup.build_index(odd).shards > 1 and quality_rules.frequent_lines(odd, min_docs=1).shards > 1
    want = lines_by_hand([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in line_dedup.dedup_lines(odd).collect()) == want
    rules = rules_by_hand([(r["doc_id"], r["source"], r["text"]) for r in odd.collect()], 0.1, 1, 0.05)
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed removed_lines removed_words kept".split()
    assert Counter(tuple(r[n] for n in names) for r in quality_rules.judged(odd, share=0.1, min_docs=1, depleted=0.05).collect()) == rules


def test_lines_keep_other_columns(clashing):
    out = line_dedup.dedup_lines(clashing)
    assert {"lang", "source", "kept", "score"} <= set(out.columns) and len(set(out.columns)) == len(out.columns)


def test_exact_by_hand(odd, clashing, none):
    rows = [(r["doc_id"], re.sub(f"{WHITE}+", " ", r["text"] or "")) for r in odd.collect()]
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text].append(doc_id)
    want, stayed = Counter(), set()
    for doc_id, text in rows:
        keep = min((x for x in groups[text] if x is not None), default=None)
        want[doc_id, keep, len(groups[text]), doc_id == keep and text not in stayed, sha(text)] += 1
        stayed |= {text} if doc_id == keep else set()
    for docs in (odd, clashing):
        assert Counter(map(tuple, exact_dedup.exact_groups(docs).collect())) == want
    assert exact_dedup.exact_groups(none).count() == 0


def test_exact_stays_on_the_jvm(odd):
    plan = exact_dedup.exact_groups(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_tables(none):
    assert line_dedup.dedup_lines(none).count() == 0
    assert quality_rules.judged(none).count() == 0
    assert license_scan.scan(none).count() == 0


def base_by_hand(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    marked = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


def rules_by_hand(rows, share, min_docs, depleted, most_docs=quality_rules.MOST_DOCS):
    norm = lambda x: " ".join(re.findall("[^\x20\x09-\x0d]+", x)).translate(LOWER)
    documents, held = Counter(), defaultdict(list)
    for _, host, text in rows:
        documents[host] += 1
        for line in {norm(x) for x in (text or "").split("\n")}:
            held[host, line].append(text or "")
    out = Counter()
    for doc_id, host, text in rows:
        base = base_by_hand(text)
        limit = min(max(min_docs, share * documents[host]), most_docs)
        gone = [x for x in (text or "").split("\n") if norm(x) and len(held[host, norm(x)]) > limit and len(set(held[host, norm(x)])) > 1]
        lost = sum(len(norm(x).split(" ")) for x in gone)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        out[doc_id, *base, failed, len(gone), lost, not failed and lost <= depleted * base[0]] += 1
    return out


def test_rules_by_hand(odd, clashing):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in odd.collect()]
    want = rules_by_hand(rows, 0.1, 1, 0.05)
    assert any(x[-3] for x in want) and len({x[-1] for x in want}) == 2
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed removed_lines removed_words kept".split()
    for docs in (odd, clashing):
        got = quality_rules.judged(docs, share=0.1, min_docs=1, depleted=0.05)
        assert Counter(tuple(r[n] for n in names) for r in got.collect()) == want
        assert got.where("removed_lines = 0 AND cleaned <> coalesce(text, '')").count() == 0


def test_boilerplate_goes_and_depleted_documents_are_rejected(spark):
    from tests.llm.conftest import prose

    line = "the same line on every page of this host and nowhere else at all"
    rows = [(i, "h", prose(i) + "\n" + line) for i in range(30)] + [(30, "h", "\n".join([line + "  "] * 4 + ["a few words"])), (31, "g", prose(99) + "\n" + line)]
    got = {r["doc_id"]: r for r in quality_rules.judged(spark.createDataFrame(rows, "doc_id bigint, source string, text string")).collect()}
    assert all(got[i]["kept"] and got[i]["removed_lines"] == 1 and line not in got[i]["cleaned"] for i in range(30))
    assert not got[30]["kept"] and got[30]["removed_lines"] == 4
    assert got[31]["removed_lines"] == 0


def licenses_by_hand(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    hits = [(i, label) for phrase, label in license_scan.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_licenses_by_hand(odd, clashing):
    want = Counter((r["doc_id"], *licenses_by_hand(r["text"])) for r in odd.collect())
    assert any(x[2] for x in want)
    for docs in (odd, clashing):
        got = license_scan.scan(docs).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
        assert all(set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)


def test_changed_license_texts_are_found(spark):
    mit = next(text for text, label in license_scan.TEMPLATES if label == "mit" and len(text) > 100)
    changed = mit.replace("any person obtaining", "any natural person who is obtaining").replace("free of charge", "free of any charge")
    rows = [(1, "before " + mit + " after"), (2, changed), (3, "permission is hereby granted to walk the dog")]
    got = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1]["labels"] == "mit" and got[1]["score"] == 1
    assert got[2]["labels"] == "mit" and 0.8 <= got[2]["score"] < 1
    assert got[3]["labels"] == ""


def test_copies_are_no_boilerplate_and_large_hosts_have_a_limit(spark):
    from tests.llm.conftest import prose

    menu = "a menu line that stands under many pages here"
    rows = [(i, "h", prose(7)) for i in range(60)] + [(100 + i, "h", prose(100 + i) + ("\n" + menu) * (i < 12)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    for settings, removed in (({"most_docs": 10, "min_docs": 5}, 12), ({"most_docs": 12, "min_docs": 5, "share": 1.0}, 0)):
        got = quality_rules.judged(docs, **settings).collect()
        assert all(r["kept"] for r in got)
        assert sum(r["removed_lines"] for r in got) == removed
        assert all(r["removed_lines"] == 0 for r in got if r["doc_id"] < 100)


def test_a_task_opens_each_shard_once(spark, monkeypatch, tmp_path):
    """200 shards, 40 blocks of documents: one opening for each shard that is asked for."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(index, "SHARD_KEYS", 25)
    texts = ["\n".join(f"line number {i + k} of the shared ones" for k in range(50)) for i in range(0, 5000, 25)]
    docs = spark.createDataFrame([(3 * i + k, x) for i, x in enumerate(texts) for k in range(2)], "doc_id bigint, text string")
    found = line_dedup.build_index(docs, min_docs=2)
    assert found.shards >= 200
    opened, real = Counter(), store.data_files
    monkeypatch.setattr(store, "data_files", lambda uri: opened.update([uri]) or real(uri))
    monkeypatch.setattr(index.store, "blocks", lambda batches, column: (b.slice(i, 10) for b in batches for i in range(0, b.num_rows, 10)))
    rows = docs.collect()
    batch = pa.RecordBatch.from_pydict({"doc_id": [r["doc_id"] for r in rows], "text": [r["text"] for r in rows]})
    out = pa.Table.from_batches(line_dedup._probe([batch], found, "doc_id", "text", 20)).to_pydict()
    assert len(opened) >= 200 and set(opened.values()) == {1}
    assert sum(out["n_dropped"]) == sum(out["n_lines"]) - len({x for t in texts for x in t.split("\n")})
    monkeypatch.setattr(index, "HELD_BYTES", 1 << 12)
    again = pa.Table.from_batches(line_dedup._probe([batch], found, "doc_id", "text", 20)).to_pydict()
    assert again == out and np.all(np.array(again["n_lines"]) == 50)


def chain_by_hand(hits, size, window):
    """The most template words under a chain of hits, by trying all of them."""
    rows = sorted((d + q, q) for d, q in hits)
    best = 0
    for chosen in range(1, 1 << len(rows)):
        own = [x for i, x in enumerate(rows) if chosen >> i & 1]
        if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(own, own[1:])):
            best = max(best, len({q + k for _, q in own for k in range(window)}))
    return best


def test_chains_by_hand():
    import random

    choose = random.Random(3)
    for _ in range(150):
        size, window = 14, 3
        hits = list({(choose.randint(0, 6), choose.randint(0, size - window)) for _ in range(choose.randint(1, 9))})
        assert license_scan.chained(hits, size, window) == chain_by_hand(hits, size, window)


def test_order_counts_in_a_span():
    forwards, backwards = license_scan.Spans(20, 4), license_scan.Spans(20, 12)
    for diagonal, places in ((8, range(10, 18)), (9, range(0, 3))):
        forwards.add(diagonal, sum(1 << q for q in places))
    assert forwards.cover == 0.75  # words 0 to 4, then words 10 to 19
    for diagonal, places in ((0, range(10, 18)), (12, range(0, 8))):
        backwards.add(diagonal, sum(1 << q for q in places))
    assert backwards.cover == 0.5  # either half, but not both: the second half comes first


def test_labels_by_hand(spark):
    """Labels and score against a search of all places for each template's best chain."""
    import random

    choose, known = random.Random(9), license_scan.templates(license_scan.TEMPLATES)
    texts = []
    for _ in range(60):
        words = []
        for _ in range(choose.randint(1, 4)):
            own = [w.decode() for w in choose.choice(known)[0]]
            for _ in range(choose.randint(0, 4)):
                at = choose.randrange(len(own))
                own[at : at + choose.randint(0, 1)] = [f"word{choose.randint(0, 99)}"] * choose.randint(0, 2)
            words += own + [f"gap{choose.randint(0, 9)}" for _ in range(choose.randint(12, 30))]
        texts.append(" ".join(words))
    got = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    for i, text in enumerate(texts):
        words, best, labels = license_scan.words_of(text), 0.0, set(filter(None, licenses_by_hand(text)[4].split(",")))
        for own, label, is_base in known:
            window = license_scan._windows(len(own))
            hits = [(p - q, q) for q in range(len(own) - window + 1) for p in range(len(words) - window + 1) if words[p : p + window] == own[q : q + window]]
            if is_base:
                best = max(best, float(label in labels))
                continue
            runs = []
            for d, q in sorted(hits):
                if not runs or d - runs[-1][-1][0] > license_scan.SLACK:
                    runs.append([])
                runs[-1].append((d, q))
            cover = max((license_scan.chained(run, len(own), window) / len(own) for run in runs), default=0.0)
            best = max(best, cover)
            labels |= {label} if cover >= license_scan.COVER else set()
        assert (got[i]["labels"], got[i]["score"]) == (",".join(sorted(labels)), best), text


def test_a_text_of_a_million_hits(spark):
    import time

    parts = ["permission to use copy modify or else", "the mozilla public thing", "cc by"]
    text = " ".join(parts * 110_000)
    began = time.time()
    [row] = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert row["n_base"] == 110_000 and row["first_word"] == 11 and row["last_word"] == row["n_words"] - 2
    assert time.time() - began < 40
