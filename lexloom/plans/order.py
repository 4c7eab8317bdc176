"""Named queries that order, cut, chunk and sample."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.plans.catalogue import query
from lexloom.session import materialise
from lexloom.views import iso, with_views


def numbered(rows, *order):
    """Global row numbers (n, from 1) without one task sorting everything.

    Rows are cut into ranges of the order, as many as there are shuffle partitions and about as
    large as each other, and written with their range; each range is numbered on its own, and what
    lies before a range is a running sum over one row a range.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(rows.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.withColumn("_before", F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))).select("_range", F.coalesce("_before", F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("_local", local).join(F.broadcast(before), "_range").withColumn("n", F.col("_before") + F.col("_local")).drop("_range", "_local", "_before")


def _orders(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("norm"), "o_totalprice")


_N = "n AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS n FROM orders)"


@query("global_order", f"WITH {_N} SELECT id, CAST(day AS VARCHAR) AS day, n FROM n")
def global_order(spark, sf_dir):
    return numbered(_orders(spark, sf_dir), "day", "id").select("id", iso("day").alias("day"), "n")


@query("chunk_ids", f"WITH {_N} SELECT (n - 1) // 2500 AS chunk, count(*) AS n_events, CAST(min(id) AS BIGINT) AS least_id FROM n GROUP BY 1")
def chunk_ids(spark, sf_dir):
    rows = numbered(_orders(spark, sf_dir), "day", "id")
    return rows.groupBy(F.expr("(n - 1) div 2500").alias("chunk")).agg(F.count(F.lit(1)).alias("n_events"), F.min("id").alias("least_id"))


@query("slice_boundaries", f"WITH {_N} SELECT id, n FROM n WHERE n % 700 = 0 UNION SELECT id, n FROM n WHERE n = (SELECT max(n) FROM n)")
def slice_boundaries(spark, sf_dir):
    rows = numbered(_orders(spark, sf_dir), "day", "id")
    last = rows.agg(F.max("n").alias("last"))
    return rows.join(F.broadcast(last), F.lit(True)).where("n % 700 = 0 OR n = last").select("id", "n")


@query("pinned_order", """SELECT n_nationkey, row_number() OVER (ORDER BY n_name <> 'SPAIN' AND n_regionkey <> 3, n_name) AS place FROM nation""")
def pinned_order(spark, sf_dir):
    pin = (F.col("n_name") != "SPAIN") & (F.col("n_regionkey") != 3)
    return views.table(spark, sf_dir, "nation").select("n_nationkey", F.row_number().over(Window.orderBy(pin, "n_name")).cast("bigint").alias("place"))


@query("nulls_last_order", f"""{with_views('ver')} SELECT norm, block, src, row_number() OVER (PARTITION BY norm ORDER BY eff ASC NULLS LAST, src, block) AS place FROM ver""")
def nulls_last_order(spark, sf_dir):
    order = Window.partitionBy("norm").orderBy(F.asc_nulls_last("eff"), "src", "block")
    return views.versions(spark, sf_dir).select("norm", "block", "src", F.row_number().over(order).cast("bigint").alias("place"))


@query("numeric_else_text_order", """WITH k AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS key FROM part)
SELECT key, row_number() OVER (ORDER BY TRY_CAST(key AS INT) IS NULL, TRY_CAST(key AS INT), key) AS place FROM k""")
def numeric_else_text_order(spark, sf_dir):
    key = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    number = F.col("key").try_cast("int")
    distinct = views.table(spark, sf_dir, "part").select(key.alias("key")).distinct()
    return numbered(distinct, F.asc_nulls_last(number), "key").select("key", F.col("n").alias("place"))


@query("offset_limit", "SELECT p_partkey AS id, p_name AS name FROM part ORDER BY p_partkey LIMIT 50 OFFSET 100")
def offset_limit(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")).orderBy("id").offset(100).limit(50)


@query("topk_with_more", """WITH r AS (SELECT l_suppkey AS key, l_partkey AS item, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS k, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem)
SELECT key, string_agg(CAST(item AS VARCHAR), ', ' ORDER BY k) || CASE WHEN any_value(n) > 5 THEN ' and ' || (any_value(n) - 5) || ' more' ELSE '' END AS shown FROM r WHERE k <= 5 GROUP BY key""")
def topk_with_more(spark, sf_dir):
    order = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")
    line = views.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_extendedprice", "l_orderkey", "l_linenumber")
    top = line.withColumn("k", F.row_number().over(order)).where("k <= 5").groupBy(F.col("l_suppkey").alias("key")).agg(F.array_sort(F.collect_list(F.struct("k", "l_partkey"))).alias("items"))
    counts = line.groupBy(F.col("l_suppkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    items = F.array_join(F.transform("items", lambda x: x["l_partkey"].cast("string")), ", ")
    more = F.when(F.col("n") > 5, F.concat(F.lit(" and "), (F.col("n") - 5).cast("string"), F.lit(" more"))).otherwise("")
    return top.join(counts, "key").select("key", F.concat(items, more).alias("shown"))


@query("systematic_sample", "WITH n AS (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents) SELECT doc_id FROM n WHERE (n - 1) % 7 = 0")
def systematic_sample(spark, sf_dir):
    """Every seventh of each language: places come from one global numbering, so no language meets in one task."""
    rows = numbered(views.table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id")
    first = rows.groupBy("lang").agg(F.min("n").alias("first"))
    return rows.join(first, "lang").where("(n - first) % 7 = 0").select("doc_id")


@query("stratified_round_robin", """WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('s' || doc_id), doc_id) AS k FROM documents WHERE doc_id > 4),
p AS (SELECT doc_id, lang, 0 AS k FROM documents WHERE doc_id <= 4)
SELECT doc_id FROM (SELECT doc_id FROM r ORDER BY k, lang LIMIT 60) UNION ALL SELECT doc_id FROM p""")
def stratified_round_robin(spark, sf_dir):
    """One of each stratum in turn, in an order that a seed fixes; pinned rows always."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.md5(F.concat(F.lit("s"), "doc_id").cast("binary")), "doc_id")
    sample = docs.where("doc_id > 4").withColumn("k", F.row_number().over(order)).where("k <= 60").orderBy("k", "lang").limit(60)
    return sample.select("doc_id").unionAll(docs.where("doc_id <= 4").select("doc_id"))


@query("most_recent_kept", f"""{with_views('ver')} SELECT norm, block, src FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY pub DESC, src DESC, block) AS k FROM ver) WHERE k <= 3""")
def most_recent_kept(spark, sf_dir):
    order = Window.partitionBy("norm").orderBy(F.desc("pub"), F.desc("src"), "block")
    return views.versions(spark, sf_dir).withColumn("k", F.row_number().over(order)).where("k <= 3").select("norm", "block", "src")


@query("abbreviated_list", f"""{with_views('ver')},
b AS (SELECT norm, list_sort(list(DISTINCT block)) AS bs FROM ver GROUP BY norm)
SELECT norm, CASE WHEN len(bs) = 1 THEN 'art. ' || bs[1] WHEN len(bs) <= 4 THEN 'arts. ' || array_to_string(bs, ', ') ELSE 'arts. ' || array_to_string(bs[1:3], ', ') || ' and ' || (len(bs) - 3) || ' more' END AS label FROM b""")
def abbreviated_list(spark, sf_dir):
    blocks = views.versions(spark, sf_dir).groupBy("norm").agg(F.transform(F.array_sort(F.collect_set("block")), lambda x: x.cast("string")).alias("bs"))
    n = F.size("bs")
    label = (F.when(n == 1, F.concat(F.lit("art. "), F.element_at("bs", 1))).when(n <= 4, F.concat(F.lit("arts. "), F.array_join("bs", ", ")))
             .otherwise(F.concat(F.lit("arts. "), F.array_join(F.slice("bs", 1, 3), ", "), F.lit(" and "), (n - 3).cast("string"), F.lit(" more"))))
    return blocks.select("norm", label.alias("label"))
