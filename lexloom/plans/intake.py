"""Named queries on ways of listing, large XML files and PDF documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date, timedelta
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import functions as F

from lexloom import views
from lexloom.plans.catalogue import query
from lexloom.session import importable, scratch
from lexloom.sources import connector, http, paging, pdf, streams

_TOTAL, _SIZE = 3000, 70
_SINCE = date(2020, 1, 1)


def _feed(url: str) -> str:
    at = int(url.rpartition("=")[2])
    entries = "".join(f"<entry><id>{i}</id></entry>" for i in range(at, min(at + _SIZE, _TOTAL + 1)))
    more = f'<link rel="next" href="http://feed/?from={at + _SIZE}"/>' if at + _SIZE <= _TOTAL else ""
    return f"<feed>{entries}{more}</feed>"


def _shifting(at: int, size: int) -> list[int]:
    """Each request finds one row more at the front, so pages repeat the end of the page before."""
    shift = at // size
    return [i for i in range(at - shift + 1, at - shift + size + 1) if i <= _TOTAL]


def _newest_first(page: int) -> tuple[int, list[tuple[int, date]]]:
    first = (page - 1) * _SIZE
    return page, [(i, date(2020, 1, 1) + timedelta(days=_TOTAL - i)) for i in range(first + 1, first + _SIZE + 1)]


#: Each way of listing, over a made-up source of the numbers 1 to 3000.
_WALKS = {
    "offsets": lambda: paging.offsets(_shifting, _SIZE),
    "after": lambda: paging.after(lambda last, n: list(range((last or 0) + 1, min((last or 0) + n, _TOTAL) + 1)), _SIZE, lambda r: r),
    "whole_groups": lambda: (i for g in paging.whole_groups(lambda k, n: [i for i in range(((k or 0) * 4) or 1, _TOTAL + 1)][:n], _SIZE, lambda i: i // 4) for i in g),
    "numbered": lambda: paging.numbered(lambda p: list(range(max(1, (p - 1) * 50), min(p * 50, _TOTAL) + 1)) or [1], without_new=5),
    "counted": lambda: paging.counted(lambda at, n: (_TOTAL, list(range(at + 1, min(at + n, _TOTAL) + 1))), _SIZE),
    "listings": lambda: (i for _, _, i in paging.listings(lambda kind, year: range(1 + kind + 3 * (year - 2000), _TOTAL + 1, 60), range(3), range(2000, 2020))),
    "back_to": lambda: (i for i, _ in paging.back_to(_newest_first, _SINCE, lambda r: r[1])),
    "feed": lambda: (int(x.text()) for x in paging.feed(_feed, "http://feed/?from=1")),
    "halved": lambda: http.halved(list(range(1, _TOTAL + 1)), lambda keys: keys[:64], 64),
}


def _walk(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for kind in batch.column("kind").to_pylist():
            found = list(_WALKS[kind]())
            yield pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(found), pa.string()), "id": pa.array(found, pa.int64())})


@query("paging_walks", " UNION ALL ".join(f"SELECT '{kind}' AS kind, i AS id FROM range(1, {_TOTAL + 1}) t(i)" for kind in _WALKS))
def paging_walks(spark, sf_dir):
    """The same source through each way of listing it, a task each: every row once."""
    importable(spark)
    return spark.createDataFrame([(x,) for x in _WALKS], "kind string").repartition(len(_WALKS), "kind").mapInArrow(_walk, "kind string, id long")


def _probe(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ask = {n: has for n, has in zip(batch.column("id").to_pylist(), batch.column("there").to_pylist(), strict=True)}
        found = [n for n in ask if ask[n]]
        yield pa.RecordBatch.from_pydict({"id": pa.array(found, pa.int64())})


@query("parallel_probing", "SELECT i AS id FROM range((SELECT min(p_partkey) FROM part), (SELECT max(p_partkey) + 1 FROM part)) t(i) WHERE i IN (SELECT p_partkey FROM part WHERE p_size % 4 <> 1)")
def parallel_probing(spark, sf_dir):
    """Every number of a range is asked for, a run of numbers in each task."""
    importable(spark)
    part = views.table(spark, sf_dir, "part")
    low, high = part.agg(F.min("p_partkey"), F.max("p_partkey")).first()
    held = part.where("p_size % 4 <> 1").select(F.col("p_partkey").alias("id"), F.lit(True).alias("there"))
    asked = spark.range(low, high + 1).join(held, "id", "left").select("id", F.coalesce("there", F.lit(False)).alias("there"))
    return asked.mapInArrow(_probe, "id long")


@query("xml_records", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS type, p_name AS affected, strftime(DATE '1990-01-01' + p_size, '%Y-%m-%d') AS in_force FROM part")
def xml_records(spark, sf_dir):
    """A file of effects for each size, read record by record."""
    importable(spark)
    part = views.table(spark, sf_dir, "part")
    record = F.concat(F.lit('<Effect Id="'), "p_partkey", F.lit('" Type="'), "p_type", F.lit('"><ukm:AffectedTitle>'), "p_name", F.lit('</ukm:AffectedTitle><ukm:InForce Date="'), F.date_format(F.expr("date_add(DATE '1990-01-01', p_size)"), "yyyy-MM-dd"), F.lit('"/></Effect>'))
    files = part.groupBy(F.expr("p_partkey div 500").alias("file")).agg(F.concat(F.lit('<Effects xmlns:ukm="u">'), F.array_join(F.collect_list(record), ""), F.lit("</Effects>")).alias("xml"))
    spark.udtf.register("xml_records", streams.XmlRecords)
    files.select(F.encode("xml", "UTF-8").alias("content")).createOrReplaceTempView("lexloom_effects")
    return spark.sql("SELECT r.record['Id'] AS id, r.record['Type'] AS type, r.record['AffectedTitle'] AS affected, r.record['InForce@Date'] AS in_force FROM lexloom_effects, LATERAL xml_records(content, 'Effect') r")


def _pdf(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files = []
        for number, name, kind, brand in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            title = [(72 + 60 * i, 700 + i % 2, 14, w) for i, w in enumerate(name.split(" "))]
            files.append(pdf.written([[(72, 760, 10, f"Part {number}"), *title], [(72, 700, 10, kind), (300, 700.5, 10, brand)]]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(files, pa.binary())], ["id", "content"])


@query("pdf_lines", "SELECT p_partkey AS id, 1 AS page, 10.0::DOUBLE AS size, 'Part ' || p_partkey AS line FROM part UNION ALL SELECT p_partkey, 1, 14.0, p_name FROM part UNION ALL SELECT p_partkey, 2, 10.0, p_type || ' ' || p_brand FROM part")
def pdf_lines(spark, sf_dir):
    """Lines of PDF documents: words whose baselines lie within two points, from left to right."""
    importable(spark)
    part = views.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    spark.udtf.register("pdf_words", pdf.PdfWords)
    part.mapInArrow(_pdf, "id long, content binary").createOrReplaceTempView("lexloom_pdfs")
    words = spark.sql("SELECT d.id, w.* FROM lexloom_pdfs d, LATERAL pdf_words(d.content) w")
    row = F.round(F.col("y") / 4).alias("row")
    lines = words.groupBy("id", "page", row).agg(F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("x", "text"))).alias("words"))
    return lines.select("id", "page", "size", F.array_join(F.transform("words", lambda w: w["text"]), " ").alias("line"))


def _store(path: str, batches) -> Iterator[pa.RecordBatch]:
    fs, root = pafs.LocalFileSystem() if path.startswith("file:") or "://" not in path else pafs.FileSystem.from_uri(path)[0], re.sub(r"^file:/+", "/", path)
    for batch in batches:
        for key, name in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            fs.create_dir(f"{root}/n{key}", recursive=True)
            for day, text in (("2001-01-01", f"{name} as enacted"), ("2005-06-01", f"{name} as amended")):
                with fs.open_output_stream(f"{root}/n{key}/{day}.txt") as out:
                    out.write(text.encode())
        yield pa.RecordBatch.from_pydict({"key": batch.column(0)})


@query("connector_documents", "SELECT 'n' || n_nationkey AS norm, n_name || ' as enacted' AS before, n_name || ' as amended' AS now, CASE WHEN n_nationkey IN (3, 7) THEN n_name || ' as amended' END AS picked FROM nation")
def connector_documents(spark, sf_dir):
    """Texts by key from a folder of versions: as they stood on a day, as they are now, and of two keys alone."""
    connector.register(spark)
    path = scratch(spark, "folder")
    views.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long"), "n_name").mapInArrow(partial(_store, path), "key long").count()
    load = lambda **how: spark.read.format("documents").options(path=path, keyspertask=4, **how).load().select("norm", F.decode("content", "UTF-8").alias("text"))
    then, now = load(asof="2003-01-01").withColumnRenamed("text", "before"), load().withColumnRenamed("text", "now")
    picked = load(day="2005-06-01").where("norm IN ('n3', 'n7')").withColumnRenamed("text", "picked")
    return then.join(now, "norm").join(picked, "norm", "left")
