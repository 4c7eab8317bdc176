"""What the commands of a workspace leave in its folder."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexloom.plans.layouts import documents
from lexloom.sources import layouts
from lexloom.sources.layout_table import LAYOUTS
from lexloom.workspace import Workspace

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def work(spark, tmp_path):
    return Workspace(spark, f"file://{tmp_path}/work", "fr", chunk_events=4)


def docs(spark, below: int):
    return documents(spark, SMALL, "fr").where(F.col("norm").cast("long") < below)


def files(tmp_path, table: str):
    return sorted(tmp_path.glob(f"work/{table}/**/*.parquet"))


def test_small_chunks_share_a_file(spark, work, tmp_path):
    work.bootstrap(docs(spark, 8), "2024-01-01")
    work.bootstrap(docs(spark, 9), "2024-01-02")
    rows = work.events().orderBy("n").select("n", "chunk").collect()
    assert [tuple(r) for r in rows] == [(n, (n - 1) // 4) for n in range(1, 46)]
    assert len(files(tmp_path, "events")) == 2  # one for each commit; not one for each of 12 chunks


def test_another_log_is_given_each_chunk_before_this_one_has_it(spark, work):
    work.fetch(docs(spark, 3), "2024-01-01")
    given = []

    def write(rows, number):
        given.append((number, [r["n"] for r in rows.orderBy("n").collect()], work.events().count()))
        if number == 2:
            raise OSError("the other log is gone")

    with pytest.raises(OSError):
        work.commit(write=write)
    assert given == [(0, [1, 2, 3, 4], 0), (1, [5, 6, 7, 8], 4), (2, [9, 10, 11, 12], 8)]
    assert sorted(r["n"] for r in work.commit().collect()) == list(range(9, 16))
    assert work.events().select("norm", "src", "day").distinct().count() == work.events().count() == 15


def test_reprocess_leaves_other_keys_alone(spark, work, tmp_path):
    work.bootstrap(docs(spark, 8), "2024-01-01")
    before = {x: x.stat().st_ino for name in ("documents", "units", "files") for x in files(tmp_path, name)}
    changed = docs(spark, 8).where("norm = '3'").withColumn("content", F.encode(F.replace(F.decode("content", "UTF-8"), F.lit(" as changed by "), F.lit(" as corrected by ")), "UTF-8"))
    work.fetch(changed, "2024-01-02", force=True)
    work.fetch(docs(spark, 12).where("norm = '11'"), "2024-01-02")  # not committed yet
    assert work.reprocess(["3"]) == 1
    log = work.events()
    assert log.count() == 40 and log.where("n > 40").select("norm", "src").collect() == [("3", "JORF3")]
    assert work.commit().select("norm").distinct().collect() == [("11",)]
    assert work.files().where("norm = '3'").first()["text"].count(" as corrected by ") == 1
    kept = [x for x in before if x.exists() and x.stat().st_ino == before[x]]
    assert len(before) - len(kept) <= 6  # the buckets of two norms in three tables


def test_what_a_second_source_says_is_replaced_and_kept_apart(spark, work):
    work.bootstrap(docs(spark, 6), "2024-01-01")
    own = sorted(map(tuple, work.units().collect()))
    assert work.revised(docs(spark, 4), "fr") == 20
    assert work.revised(docs(spark, 2), "fr") == 0
    units = work.units().withColumn("_second", F.startswith("src", F.lit("revised-")))
    assert sorted(map(tuple, units.where("NOT _second").drop("_second").collect())) == own
    assert {r["norm"]: r["count"] for r in units.where("_second").groupBy("norm").count().collect()} == dict.fromkeys("0123", 5)


def test_days_that_come_again_are_kept():
    layouts.day.cache_clear()
    text = '<x><elements><article id="A1" debut="1990-02-01"><contenu><p>a</p></contenu></article><article id="A2" debut="1990-02-01"><contenu><p>b</p></contenu></article></elements></x>'
    units = layouts.document(LAYOUTS["fr"], text)[1]
    assert [(u.unit, u.eff, u.paras) for u in units] == [("A1", "1990-02-01", ["a"]), ("A2", "1990-02-01", ["b"])]
    assert layouts.day.cache_info().hits >= 3


def test_the_first_alternative_that_has_a_value_counts():
    root = layouts.tree("<r><a n=' '/><a/><b n='1'/><b n='2'/><c>t</c></r>", "xml")[0]
    assert layouts.values(root, "a@n | b@n") == ["1", "2"] and layouts.first(root, "a@n | b@n") == "1"
    assert layouts.first(root, "d | a | c") == "t" and layouts.first(root, ".") == "t" and layouts.first(root, "") is None and layouts.first(root, "d@n") is None
