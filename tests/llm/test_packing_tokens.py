"""op2 and the pipeline's packing measure texts in tokens."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from lexloom.llm import packing, stages, token_counts
from tests.llm.conftest import DOCS, prose

public = pytest.importorskip("public_tokenizers")


def test_lengths_are_the_library_s_tokens(spark, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want = Counter((r["doc_id"], len(library.encode(r["text"] or "").ids)) for r in odd.collect())
    for rows in (packing.pack_tokens(odd), stages.packing(spark, odd, "")):
        assert Counter((r["doc_id"], r["n_tokens"]) for r in rows.collect()) == want


def test_totals_are_those_of_the_prefixes(odd):
    counter = token_counts._counter(public.path("byte_bpe_50k.json"), public.PATTERN)
    for text in [r["text"] or "" for r in odd.collect()] + ["a  b", " x", "x ", "<|endoftext|><|endoftext|>", "\n \n", "日本" * 500]:
        assert token_counts.total(text, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, packing.SPECIALS) == counter.prefixes(text).total


def test_texts_without_spaces_keep_the_budget(spark, tmp_path):
    texts = [*["日本語" * 2000] * 6, *[prose(i) for i in range(20)]]
    spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in enumerate(texts)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    batches = defaultdict(list)
    for r in packing.op2_packing(spark, str(tmp_path)).collect():
        assert r["n_tokens"] > 100
        batches[r["batch_id"]].append(r)
    assert all(len(own) == 1 or len(own) * own[0]["padded_tokens"] <= packing.BUDGET for own in batches.values())
