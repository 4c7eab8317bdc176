"""Small tables with every awkward row: nulls, empties, ties, repeats, long texts, clashing columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int = 120) -> str:
    random_words = random.Random(seed)
    own = ["".join(random_words.choice(["ba", "ne", "ti", "ro", "su", "ma", "le"]) for _ in range(random_words.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(own[i : i + 12]).capitalize() + "." for i in range(0, words, 12))


SHARED = "This notice stands under many of the pages."
MENU = "short"


def odd_texts() -> list[str | None]:
    base = prose(1)
    return [
        base, base, base.replace("\n", " \t\n"), base.replace("ba", "Ba", 1), prose(2) + "\n" + SHARED, prose(3) + "\n  " + SHARED.upper() + "\t", SHARED + "\n" + SHARED + "\n" + prose(4),
        None, "", " \n\t ", "x", "a b c", prose(5, 4000), "é日本 " * 60, "All rights reserved. CC-BY; general\npublic licence, General Public License!", "<|endoftext|> and  two   spaces \n\n end ", MENU, MENU, MENU,
        " ".join(["same words"] * 90), "# $ % & | < > *" * 40,
    ]


@pytest.fixture(scope="session")
def odd(spark):
    texts = odd_texts()
    rows = [(i, x, "en", f"s{i % 2}" if i % 5 else None, None if x is None else len(x)) for i, x in enumerate(texts)]
    rows += [(rows[4][0], *rows[4][1:]), (None, texts[4], "en", "s0", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).cache()


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns named like those that operators add."""
    added = "n_lines n_dropped held_out score predicted kept cleaned n_words fp component_id group_size batch_id".split()
    return odd.withColumns({x: F.lit("mine") for x in added})


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
