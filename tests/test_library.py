"""Functions, graph walks, sources and sinks on small inputs."""

from __future__ import annotations

import gzip
import io
import tarfile
import urllib.error
from datetime import date

import pytest
from pyspark.sql import functions as F

from lexloom.functions import dates as d, markup, nested as n, text as t
from lexloom.operators import enrich, graph, reconcile, sequence
from lexloom.sources import archives, catalogue, registry, sinks
from lexloom.streaming import daily


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("column", "want"), [
    (lambda: t.clean(F.lit(" a\x07b c​ ")), "ab c"),
    (lambda: t.squeeze_lines(F.lit("a  b\n| x   y |")), "a b\n| x   y |"),
    (lambda: t.yaml_quoted(F.lit('a "b"\\\n')), '"a \\"b\\"\\\\\\n"'),
    (lambda: t.title(F.lit("Law. . ")), "Law"),
    (lambda: t.escape_numbering(F.lit("12. text 3. more")), "12\\. text 3. more"),
    (lambda: t.wrapped(F.lit(" x "), "**"), " **x** "),
    (lambda: t.normalised(F.lit("2024-01-02T03:04:05")), "2024-01-02"),
    (lambda: t.safe_id(F.lit("a:b/c d")), "a-b-cd"),
    (lambda: t.slug(F.lit("Ley nº 5, Año")), "ley-n-5-ano"),
    (lambda: t.html_to_text(F.lit("<p>a&amp;b</p><script>x</script><p>c</p>")), "a&b\nc"),
    (lambda: t.raised(F.lit("12")), "¹²"),
    (lambda: t.raised(F.lit("ab")), "^(ab)"),
    (lambda: t.repaired(F.lit("Ã©tÃ©")), "été"),
    (lambda: n.sha_bucket(F.lit("a")), "86"),
    (lambda: n.blob_hash(F.lit("")), "e69de29bb2d1d6434b8b29ae775ad8c2e48c5391"),
    (lambda: n.path_of("{a}/{b}.md", a=F.lit("x"), b=F.lit("y")), "x/y.md"),
])
def test_text(spark, column, want):
    assert one(spark, column()) == want


@pytest.mark.parametrize(("column", "want"), [
    (lambda: d.compact(F.lit("20240229")), date(2024, 2, 29)), (lambda: d.compact(F.lit("99999999")), None), (lambda: d.compact(F.lit("22000101")), None),
    (lambda: d.iso_strict(F.lit("2024-01-02x")), None), (lambda: d.iso_prefix(F.lit("2024-01-02T00")), date(2024, 1, 2)),
    (lambda: d.spelled(F.lit("3 de mayo de 1998"), "es"), date(1998, 5, 3)), (lambda: d.spelled(F.lit("1er août 2001"), "fr"), date(2001, 8, 1)), (lambda: d.spelled(F.lit("kein Datum"), "de"), None),
    (lambda: d.from_number(F.lit(20240131)), date(2024, 1, 31)), (lambda: d.clamped(F.lit("1900-01-01").cast("date")), date(1970, 1, 2)),
    (lambda: d.previous_scheduled(F.lit("2024-01-15").cast("date")), date(2024, 1, 12)), (lambda: d.made(F.lit(2023), F.lit(2), F.lit(30)), None),
])
def test_dates(spark, column, want):
    assert one(spark, column()) == want


def test_empty_span_has_no_days(spark):
    assert one(spark, d.working_days(F.lit("2024-01-02").cast("date"), F.lit("2024-01-01").cast("date"))) == []


def test_path_with_separator_is_refused(spark):
    with pytest.raises(Exception, match="cannot be part of a path"):
        one(spark, n.path_of("{a}.md", a=F.lit("x/y")))


def test_blocks_and_tables():
    got = markup.blocks_of("<h1>A</h1><p>b <b>c</b><br>d</p><script>no</script>")
    assert [(kind, text) for kind, _, text in got] == [("h1", "A"), ("p", "b **c**\nd")]
    reader = markup._Tables()
    reader.feed('<table><tr><td rowspan="2">x</td><td>1|2</td></tr><tr><td>3</td></tr></table>')
    assert markup.grid_of(reader.tables[0]) == "|  |  |\n| --- | --- |\n| x | 1\\|2 |\n| x | 3 |"
    reader = markup._Tables()
    reader.feed('<table><thead><tr><th colspan="2">h</th></tr></thead><tr><td>a</td></tr></table>')
    assert markup.grid_of(reader.tables[0]) == "| h | h |\n| --- | --- |\n| a |  |"


def test_named_columns_span():
    reader = markup._Tables("row", ("entry",))
    reader.feed('<table><tgroup><colspec colname="a"><colspec colname="b"><tbody><row><entry namest="a" nameend="b">x</entry></row><row><entry morerows="1">y</entry><entry>1</entry></row><row><entry>2</entry></row></tbody></tgroup></table>')
    assert markup.grid_of(reader.tables[0]).split("\n")[2:] == ["| x | x |", "| y | 1 |", "| y | 2 |"]


def test_every_source_has_a_known_signal(spark):
    rows = spark.createDataFrame([(1, date(2024, 1, 1), "a"), (2, date(2024, 1, 2), "b")], "key bigint, day date, digest string")
    before = spark.createDataFrame([(1, "a")], "key bigint, digest string")
    got = {s: sorted(r["key"] for r in registry.changed(s, rows, before, "2024-01-01").collect()) for s in {x.signal for x in registry.SOURCES}}
    assert got == {"exact": [1], "cumulative": [1], "snapshot": [2], "probe": [2], "none": []}
    assert len({x.code for x in registry.SOURCES}) == 33


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 4)], "src bigint, dst bigint")
    seeds = spark.createDataFrame([(1,), (4,)], "node bigint")
    assert {(r["seed"], r["node"], r["depth"]) for r in graph.closure(edges, seeds).collect()} == {(1, 1, 0), (1, 2, 1), (1, 3, 2), (4, 4, 0)}


def test_chain_ends(spark):
    links = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (8, 9), (9, 8)], "node bigint, before bigint")
    assert {(r["node"], r["first"], r["steps"]) for r in graph.chain_ends(links).collect()} == {(2, 1, 1), (3, 1, 2), (4, 1, 3)}


def test_cover_is_greedy(spark):
    members = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "3"), ("b", "3"), ("b", "4"), ("c", "4")], "set string, item string")
    assert graph.greedy_cover(members) == [("a", 3), ("b", 1)]


def test_multiset_keeps_surplus(spark):
    want = spark.createDataFrame([("k", 1), ("k", 2), ("k", 3), ("j", 4)], "key string, seq int")
    have = spark.createDataFrame([("k", 9), ("x", 9)], "key string, seq int")
    assert {r["seq"] for r in reconcile.multiset_new(want, have, ["key"], ["seq"]).collect()} == {2, 3, 4}


def test_clash_names(spark):
    rows = spark.createDataFrame([("n", "a", 1, date(2020, 1, 1)), ("n", "b", 2, date(2021, 2, 3)), ("n", "c", 3, date(2022, 1, 1)), ("n", "a", 4, date(2020, 1, 1))], "name string, owner string, at int, day date")
    got = {r["owner"]: r["stored_as"] for r in reconcile.clash_names(rows, "name", "owner", "at", F.col("day")).collect()}
    assert got["a"] == "n" and got["b"] == "n-20210203" and got["c"].startswith("n-") and len(got["c"]) == 10


def test_ranges_with_borders(spark):
    rows = spark.createDataFrame([(5,), (10,), (15,), (99,)], "v bigint")
    ranges = spark.createDataFrame([(5, 10, "a"), (10, 30, "b")], "low bigint, high bigint, name string")
    assert {(r["v"], r["name"]) for r in enrich.in_ranges(rows, ranges, "v", "low", "high", 10).collect()} == {(5, "a"), (10, "a"), (10, "b"), (15, "b")}


def test_compression_keeps_nulls_apart(spark):
    rows = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, "a"), (1, 4, "a"), (1, 5, None)], "k int, n int, v string")
    assert sorted(r["n"] for r in sequence.compress(rows, ["k"], ["n"], "v").collect()) == [1, 3, 5]


def test_catalogue_pushdown_leaves_pages_out():
    reader = catalogue.CatalogueReader({"total": "1000", "pagesize": "100", "pagespertask": "1"})
    assert len(reader.partitions()) == 10
    list(reader.pushFilters([catalogue.GreaterThan(("id",), 750)]))
    assert [p.first for p in reader.partitions()] == [7, 8, 9]


def test_members_of_archives():
    assert list(archives.Members.func().eval(archives.zipped({"a": b"1", "d/b": b"2"}))) == [("a", b"1", None), ("d/b", b"2", None)]
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as archive:
        info = tarfile.TarInfo("x")
        info.size = 3
        archive.addfile(info, io.BytesIO(b"abc"))
    assert list(archives.Members.func().eval(out.getvalue())) == [("x", b"abc", None)]
    assert archives.unzipped_text(gzip.compress("é".encode())) == "é"


def test_sink_takes_a_key_once(spark):
    batch = spark.createDataFrame([(1, date(2024, 1, 1), "a"), (1, date(2024, 1, 1), "a"), (1, date(2024, 1, 2), "b"), (2, date(2024, 1, 2), "c")], "k bigint, day date, v string")
    sink = daily.Sink(spark, batch.schema, ["k", "day"], "test-sink", "day")
    sink.write(batch, 0)
    sink.write(batch, 0)
    sink.write(batch.withColumn("k", F.col("k") + 1), 1)
    assert sorted((r["k"], r["day"].day) for r in sink.read().collect()) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 2)]


def test_report_keeps_its_day(spark):
    same = sinks.keeping_day(F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit("new"), F.lit("old"))
    assert one(spark, same) == "old"


def test_chains_and_closures_of_any_length(spark):
    links = spark.range(2, 301).select(F.col("id").alias("node"), (F.col("id") - 1).alias("before"))
    got = {r["node"]: (r["first"], r["steps"]) for r in graph.chain_ends(links).collect()}
    assert got == {n: (1, n - 1) for n in range(2, 301)}
    edges = spark.range(1, 40).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = graph.closure(edges, spark.createDataFrame([(1,)], "node bigint"))
    assert found.agg(F.max("depth")).first()[0] == 39


def test_cover_of_many_sets(spark):
    members = spark.range(0, 25).select(F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("set"), F.col("id").alias("item"))
    assert len(graph.greedy_cover(members)) == 25


def test_wide_spans_are_whole():
    reader = markup._Tables()
    reader.feed('<table><tr><td colspan="1500">x</td></tr><tr><td>y</td></tr></table>')
    assert markup.grid_of(reader.tables[0]).split("\n")[2].count("x") == 1500


def test_broken_documents_leave_a_row(spark):
    from lexloom.sources import archives

    rows = list(markup.VersionedBlocks.func().eval("<doc><block id='a'><version src='1'><p>one</p></version></block><block id='b'><version src='2'><p>two</version>"))
    assert [(r[0], r[2], r[5]) for r in rows] == [("a", "1", "one"), ("b", "2", "two")] and all("xml" in r[-1] for r in rows)
    assert [r[-1] for r in markup.VersionedBlocks.func().eval("")] and next(iter(markup.VersionedBlocks.func().eval("<doc/>")))[-1] == "no blocks"
    whole = archives.zipped({"a.txt": b"one" * 50, "b.txt": b"two" * 50})
    at = whole.index(b"b.txt") + 5
    broken = whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1 :]
    got = list(archives.Members.func().eval(broken))
    assert got[0] == ("a.txt", b"one" * 50, None) and got[1][0] == "b.txt" and got[1][1] is None and got[1][2]
    assert [x[2] is not None for x in archives.Members.func().eval(b"nothing")] == [True]
