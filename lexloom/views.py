"""The test tables read as versioned documents.

A *norm* is a document, a *block* one of its units, a *version* a dated text of a block, an
*event* a point in time at which a norm changed.  Each view has its Spark plan and, in ``SQL``,
the same rows for DuckDB, to be put into a WITH clause.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FAR = "2001-06-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(column: Column | str) -> Column:
    """A date as text, so that results compare alike in any engine."""
    return F.date_format(column, "yyyy-MM-dd")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """norm, block, src, pub, eff, txt, qty, superseded, expiry: a bitemporal chain for each block.

    A line of an order is a version of a block: the order publishes it, the shipping date is when
    it takes effect, and open lines have no effective date.  The act ``src`` that brings a version
    is told by order, supplier and quantity.
    """
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = line.select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").join(
        order.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    norm, block = F.col("l_partkey"), F.col("l_linenumber")
    return joined.select(
        norm.alias("norm"), block.alias("block"), (F.col("l_orderkey") * 1_000_000 + F.col("l_suppkey") % 10_000 * 100 + F.col("l_quantity").cast("int")).alias("src"), F.to_date("o_orderdate").alias("pub"),
        F.when(F.col("l_linestatus") != "O", F.to_date("l_shipdate")).alias("eff"), F.col("l_returnflag").alias("txt"),
        F.col("l_quantity").cast("int").alias("qty"), (F.col("l_tax") > 0.07).alias("superseded"),
        F.when((norm + block) % 7 == 0, F.date_add(F.lit("1997-01-01").cast("date"), (norm % 700).cast("int"))).alias("expiry"))


def norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("norm"), F.col("p_name").alias("title"), F.col("p_type").alias("rank"), F.col("p_brand").alias("department"), F.col("p_size").alias("size"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """norm, id, day, kind, value: the change log, an event row each."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("norm"), F.col("event_id").alias("id"), F.to_date("ts").alias("day"), F.col("event_type").alias("kind"), "value", "props")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """norm, snap, block, txt: every order of a customer restates the customer's blocks.

    The order's rank by date numbers the snapshots; its line numbers are the blocks.
    """
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return (line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("norm"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("snap"), F.col("l_linenumber").alias("block"), F.concat("l_returnflag", F.lit("-"), F.col("l_linestatus")).alias("txt")))


SQL = {
    "ver": """ver AS (
  SELECT l_partkey AS norm, l_linenumber AS block, l_orderkey * 1000000 + l_suppkey % 10000 * 100 + CAST(l_quantity AS INT) AS src, CAST(o_orderdate AS DATE) AS pub,
         CASE WHEN l_linestatus <> 'O' THEN CAST(l_shipdate AS DATE) END AS eff, l_returnflag AS txt,
         CAST(l_quantity AS INT) AS qty, l_tax > 0.07 AS superseded,
         CASE WHEN (l_partkey + l_linenumber) % 7 = 0 THEN DATE '1997-01-01' + CAST(l_partkey % 700 AS INT) END AS expiry
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "norm": "norm AS (SELECT p_partkey AS norm, p_name AS title, p_type AS rank, p_brand AS department, p_size AS size FROM part)",
    "log": "log AS (SELECT user_id AS norm, event_id AS id, CAST(ts AS DATE) AS day, event_type AS kind, value, props FROM events)",
    "snap": """snap AS (
  SELECT o_custkey AS norm, CAST(o_orderdate AS DATE) AS day, o_orderkey AS snap, l_linenumber AS block, l_returnflag || '-' || l_linestatus AS txt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
}


def with_views(*names: str) -> str:
    return "WITH " + ", ".join(SQL[n] for n in names)
