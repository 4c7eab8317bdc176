"""probe_sequence looks as far as the numbers go."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexloom.plans.catalogue import QUERIES
from lexloom.plans import sources  # noqa: F401 - it registers the query


def hits_by_hand(numbers):
    hits, n, misses = 0, 1, 0
    while misses < 3:
        misses = 0 if n in numbers else misses + 1
        hits += n in numbers
        n += 1
    return hits


@pytest.mark.parametrize("numbers", [[*range(1, 1800), *range(1803, 2500)], [*range(1, 1800), *range(1802, 2500), 2503], [4, 5], [3, 6, 9, 13], []])
def test_probing_ends_at_three_misses_only(spark, tmp_path, numbers):
    spark.createDataFrame([(n,) for n in numbers], "p_partkey bigint").withColumn("p_size", F.lit(1)).write.parquet(f"{tmp_path}/part.parquet")
    assert QUERIES["probe_sequence"](spark, str(tmp_path)).first()["hits"] == hits_by_hand(set(numbers))
