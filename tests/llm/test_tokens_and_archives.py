"""Tokenizers against their libraries, archives as exact round trips."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import byte_bpe, store, token_counts, warc
from tests.compare import connect, same

public = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.01"
ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "é", "日本", "'", "'re", "'s", "1", "23", "!", "…", "<|endoftext|>", " ", " ", "\x1c", "\x85", "𝒳", "the", "ing", "́", "\r\n", "_", "x" * 50, " " * 9, "Ⅷ", "²"]


def strings(seed, count):
    choose = random.Random(seed)
    return ["".join(choose.choice(ALPHABET) for _ in range(choose.randint(0, 25))) for _ in range(count)]


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def test_ids_equal_the_library(library):
    encoder = byte_bpe._encoder(public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)
    for text in [*strings(1, 1500), "z" * 3000, "日" * 2000]:
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


LONG = ["x" + " " * 4000 + "y" * 4000, "  " + "z" * 3000, "\n " + "ภาษาไทย" * 400, "日本語" * 900 + "\t\t \u2003" + "語" * 900, "'" * 2000 + "s", "it's we'll '' 's" * 100, "\n \n" * 700 + "a", "a<|endoftext|>!!<|endoftext|>  <|endoftext|> b"]


@pytest.mark.parametrize("number", range(len(LONG)))
def test_prefixes_of_runs_equal_the_library(tokenizer, number):
    text = LONG[number]
    found = token_counts._counter(public.path("byte_bpe_50k.json"), public.PATTERN).prefixes(text)
    choose = random.Random(6)
    for n in sorted({0, 1, len(text), *range(min(60, len(text))), *(choose.randint(0, len(text)) for _ in range(200))}):
        assert found.at(n) == len(tokenizer.encode(text[:n], add_special_tokens=False).ids), n


def test_megabytes_of_runs_take_seconds():
    import time

    counter = token_counts._counter(public.path("byte_bpe_50k.json"), public.PATTERN)
    for text in (" " * 1_000_000 + "e" * 1_000_000, "ก" * 700_000, "漢字" * 350_000):
        began = time.time()
        assert counter.prefixes(text).total == token_counts.total(text, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
        assert time.time() - began < 20


def test_backtracking_equals_the_merges():
    vocabulary = byte_bpe.rank_file(public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)
    choose = random.Random(2)
    for _ in range(400):
        piece = bytes(choose.choice(b"abcdeinorst\xc3\xa9") for _ in range(choose.randint(1, 40)))
        assert [vocabulary.tokens[i] for i in vocabulary.encode_piece(piece)] == vocabulary.merged(piece)
        assert vocabulary.prefix_counts(piece) == [len(vocabulary.merged(piece[:n])) for n in range(len(piece) + 1)]


def test_other_patterns_are_refused():
    with pytest.raises(ValueError, match="one pattern"):
        byte_bpe.rank_file(public.path("byte_bpe_multi_50k.tiktoken"), r"\w+|\W+")


def test_memos_forget_without_effect(library, monkeypatch):
    encoder = byte_bpe.Encoder(byte_bpe.rank_file(public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN))
    encoder.piece.most = encoder.chunk.most = 3
    for text in strings(4, 200):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_counts_at_every_prefix_equal_the_library(tokenizer):
    counter = token_counts._counter(public.path("byte_bpe_50k.json"), public.PATTERN)
    count = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    for text in strings(3, 300):
        found = counter.prefixes(text)
        assert found.total == count(text)
        if "<|" not in text:
            assert [found.at(n) for n in range(len(text) + 1)] == [count(text[:n]) for n in range(len(text) + 1)]


def test_longest_prefix_within_a_budget():
    counter = token_counts._counter(public.path("byte_bpe_50k.json"), public.PATTERN)
    for text in strings(5, 100):
        found = counter.prefixes(text)
        for budget in (0, 1, 3, 7, 1000):
            n = found.within(budget)
            assert found.at(n) <= budget and (n == len(text) or found.total > budget)


def test_queries_on_awkward_rows(spark, odd, clashing, none, library, tokenizer):
    for docs in (odd, clashing, none):
        rows = docs.select("doc_id", "text").collect()
        got = byte_bpe.round_trip(docs, public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)
        want = sorted((str(r["doc_id"]), len(ids := library.encode_ordinary(r["text"] or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in rows)
        assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
        counts = token_counts.token_counts(docs, public.path("byte_bpe_50k.json"), public.PATTERN).select("doc_id", "n_bytes", "n_tokens", "over_limit")
        want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), n := len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids), n > 1024) for r in rows)
        assert sorted((str(r[0]), *r[1:]) for r in counts.collect()) == want
    files = public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN
    back = byte_bpe.decode(byte_bpe.encode(odd, *files), *files).collect()
    assert sorted(bytes(r["bytes"]) for r in back) == sorted((r["text"] or "").encode() for r in odd.collect())


def test_warc_oracle(spark):
    assert same(warc.op6_warc(spark, SF), connect(SF), warc.ORACLE_SQL) == 250


PAGES = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (7, None, "<p>x</p>"), (3, "http://a/ü\r\nX-Bad: 1", "é\r\n\r\nWARC/1.1\r\n"), (4, "u", None), (5, "u", ""), (6, "v", "<p>y</p>" * 90_000), (None, "w", "<p>x</p>"), (None, None, "alone"), (8, "z", "t"), (8, "z", "t")]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_round_trip(spark, compression):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("record_type", F.lit("mine"))
    path = store.fresh_path(spark, "test-warc")
    warc.write_archives(pages.repartition(3), path, compression=compression)
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], None if r["payload"] is None else bytes(r["payload"])) for r in warc.read_archives(spark, path, verify=True).collect()), key=str)
    heads = {"<p>x</p>": 7, "": 5, "t": 8}
    want, answered = [], set()
    for page_id, _, html in PAGES:
        raw, head = (html or "").encode(), heads.get(html or "", page_id)
        kind = "response" if page_id == head and (page_id, html) not in answered else "revisit"
        answered.add((page_id, html))  # of rows that repeat the largest id one is the response
        want.append((page_id, kind, head if kind == "revisit" else None, len(raw), warc.payload_digest(raw), raw if kind == "response" else None))
    assert got == sorted(want, key=str)
    assert warc.read_archives(spark, path).where("record_type = 'revisit' AND payload_bytes > 5").count() == 3
    assert warc.read_archives(spark, path).where("record_type = 'response'").count() == 6
    assert [r["page_id"] for r in warc.read_archives(spark, path, payload=False).where("target_uri LIKE 'http://a/2%'").collect()] == [2]


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    assert warc.planned(pages, min_bytes=100).where("record_type = 'revisit'").count() == 0


def test_pages_without_copies_are_planned_without_joins(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i}") for i in range(40)], "page_id bigint, url string, html string")
    start = store.mark()
    rows = warc.planned(pages)
    assert [x.rpartition("/")[2].partition("-")[0] for x in store._handed[start:]] == ["pages", "settled"]
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["page_id"], r["record_type"], bytes(r["payload"])) for r in rows.collect()) == [(i, "response", f"page {i}".encode()) for i in range(40)]


def test_copies_that_leave_no_response_in_doubt(spark):
    """No response shares a bit with a revisit here, so no payload moves."""
    pages = spark.createDataFrame([(i, "u", f"page {i % 7}") for i in range(20)] + [(99, None, "other")], "page_id bigint, url string, html string")
    start = store.mark()
    rows = warc.planned(pages)
    assert [x.rpartition("/")[2].partition("-")[0] for x in store._handed[start:]] == ["pages", "settled", "marks", "doubtful"]
    want = [(i, "response", None, f"page {i % 7}".encode()) if i > 12 else (i, "revisit", i % 7 + 14 - 7 * (i % 7 == 6), None) for i in range(20)] + [(99, "response", None, b"other")]
    assert sorted((r["page_id"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"])) for r in rows.collect()) == want


def test_planning_an_archive_needs_no_pandas():
    """The driver keeps a process or two for each step that plans a data source."""
    import subprocess
    import sys

    said = subprocess.run([sys.executable, "-c", "import sys, lexloom.llm.warc; print('pandas' in sys.modules)"], cwd=store._ROOT, capture_output=True, text=True, check=True)
    assert said.stdout.strip() == "False"


def test_no_pages(spark):
    path = store.fresh_path(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


class File:
    """Bytes that count what is read."""

    def __init__(self, data):
        self.data, self.at, self.read_bytes = data, 0, 0

    def size(self):
        return len(self.data)

    def seek(self, at):
        self.at = at

    def tell(self):
        return self.at

    def read(self, n):
        got = self.data[self.at : self.at + n]
        self.at, self.read_bytes = self.at + len(got), self.read_bytes + len(got)
        return got


def test_reader_skips_payloads():
    """A predicate on the header keeps the payload of a record from being read."""
    big = b"x" * 3_000_000
    file = File(b"".join(warc.record(i, "u", big, "D", "response", None) for i in range(3)))
    assert [x["page_id"] for x in warc._Plain(file).heads()] == [0, 1, 2]
    assert file.read_bytes < 300_000


def test_reader_inflates_no_unwanted_payload():
    """The extra field of a gzip member leads to the next one; members without it are inflated."""
    import gzip

    noise = random.Random(1).randbytes(2_000_000)
    records = [warc.record(i, "u", noise, None, "response", None) for i in range(4)]
    data = b"".join(warc.member(x, 4) for x in records)
    assert gzip.decompress(data) == b"".join(records)
    file = File(data)
    reader = warc._Gzip(file)
    assert [x["page_id"] for x in reader.heads()] == [0, 1, 2, 3]
    assert reader.inflated < 20_000 and file.read_bytes < 40_000
    reader = warc._Gzip(File(data))
    assert [reader.payload(x[""]) == noise for x in reader.heads()] == [True] * 4
    mixed = b"".join(gzip.compress(x) if i % 2 else warc.member(x, 4) for i, x in enumerate(records))
    reader = warc._Gzip(File(mixed))
    assert [(x["page_id"], reader.payload(x[""]) == noise) for x in reader.heads()] == [(i, True) for i in range(4)]
    assert [x["page_id"] for x in warc._Gzip(File(mixed)).heads()] == [0, 1, 2, 3]


def test_files_of_lost_tasks_are_passed_over(spark):
    from pathlib import Path

    path = store.fresh_path(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([(1, "u", "one")], "page_id bigint, url string, html string"), path)
    folder = Path(store.file_system(path)[1])
    (folder / "part-lost-00000.warc.gz").write_bytes(warc.member(warc.record(9, "u", b"lost", None, "response", None), 4))
    assert [r["page_id"] for r in warc.read_archives(spark, path).collect()] == [1]
    (folder / "foreign.warc.gz").write_bytes(warc.member(warc.record(10, "u", b"other", None, "response", None), 4))
    assert sorted(r["page_id"] for r in warc.read_archives(spark, path).collect()) == [1, 10]


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    """Where every bit is set all rows move, with the same result."""
    from lexloom.llm import exact_dedup, marks

    rows = [(i, "u", f"page {i % 70}") for i in range(400)] + [(None, "v", "page 3"), (None, None, "none"), (None, None, "none")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    docs = pages.select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    names = ["page_id", "record_type", "refers_to", "payload_bytes"]
    plain = sorted(map(tuple, warc.planned(pages).select(*names).collect()), key=str)
    groups = sorted(map(tuple, exact_dedup.exact_groups(docs).collect()), key=str)
    monkeypatch.setattr(marks, "BITS", 1)
    assert sorted(map(tuple, warc.planned(pages).select(*names).collect()), key=str) == plain
    assert sorted(map(tuple, exact_dedup.exact_groups(docs).collect()), key=str) == groups
    assert sum(r[1] == "response" for r in plain) == 72


def test_one_row_of_a_group_is_kept(spark):
    from lexloom.llm import exact_dedup

    rows = [(4, "a  b"), (4, "a b"), (4, "a\tb"), (9, "a b"), (None, "a b"), (4, "c"), (None, "d"), (None, "d")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 8
    kept = {r["text_sha256"]: 0 for r in got}
    for r in got:
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1} and len(kept) == 3
    assert sorted(r["group_size"] for r in got) == [1, 2, 2, 5, 5, 5, 5, 5]
