"""Named queries that iterate: closures, chains, covers, folds."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.operators import graph as g
from lexloom.plans.catalogue import query
from lexloom.session import importable
from lexloom.views import with_views


def _edges(spark, sf_dir):
    key = F.col("p_partkey")
    return views.table(spark, sf_dir, "part").where("p_partkey > 1").select(key.alias("src"), F.expr("p_partkey div 2").alias("dst"))


@query("closure", """WITH RECURSIVE c(seed, node, depth) AS (SELECT p_partkey, p_partkey, 0 FROM part UNION SELECT c.seed, c.node // 2, c.depth + 1 FROM c JOIN part ON p_partkey = c.node WHERE c.node > 1) SELECT seed, CAST(node AS BIGINT) AS node, depth FROM c""")
def closure(spark, sf_dir):
    seeds = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"))
    return g.closure(_edges(spark, sf_dir), seeds)


@query("chain_walk", """WITH RECURSIVE l AS (SELECT o_orderkey AS node, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders),
c(node, first, steps) AS (SELECT node, before, 1::BIGINT FROM l WHERE before IS NOT NULL UNION ALL SELECT c.node, l.before, c.steps + 1 FROM c JOIN l ON c.first = l.node WHERE l.before IS NOT NULL)
SELECT node, arg_max(first, steps) AS first, max(steps) AS steps FROM c GROUP BY node""")
def chain_walk(spark, sf_dir):
    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    links = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node"), before.alias("before")).where("before IS NOT NULL")
    return g.chain_ends(links)


@query("crawl", """WITH RECURSIVE c(node, depth) AS (SELECT 1::BIGINT, 0 UNION ALL SELECT p_partkey, c.depth + 1 FROM c JOIN part ON p_partkey // 2 = c.node AND p_partkey > 1) SELECT node, depth FROM c""")
def crawl(spark, sf_dir):
    """Breadth first from the root of a navigation tree."""
    down = _edges(spark, sf_dir).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    seeds = views.table(spark, sf_dir, "part").where("p_partkey = 1").select(F.col("p_partkey").alias("node"))
    return g.closure(down, seeds).select("node", "depth")


@query("reverse_edges", """SELECT coalesce(a.k, b.k) AS act, coalesce(a.n, 0) AS amends, coalesce(b.n, 0) AS amended_by FROM (SELECT l_suppkey AS k, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1) a FULL JOIN (SELECT l_partkey AS k, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) b ON a.k = b.k""")
def reverse_edges(spark, sf_dir):
    """In and out degree of every act from one list of end points."""
    pairs = views.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    ends = pairs.select(F.inline(F.array(F.struct(F.col("l_suppkey").alias("act"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("l_partkey").alias("act"), F.lit(0).alias("o"), F.lit(1).alias("i")))))
    return ends.groupBy("act").agg(F.sum("o").alias("amends"), F.sum("i").alias("amended_by"))


@query("set_cover")
def set_cover(spark, sf_dir):
    """Suppliers that together deliver every brand and size, widest first."""
    line = views.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    part = views.table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("/", "p_brand", "p_size").alias("item"))
    members = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").cast("string").alias("set"), "item")
    chosen = g.greedy_cover(members)
    return spark.createDataFrame([(i, *x) for i, x in enumerate(chosen)], "place int, set string, adds bigint")


@query("until_dry", """WITH w AS (SELECT DISTINCT doc_id % 97 AS round, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents),
f AS (SELECT word, min(round) AS round FROM w GROUP BY word), n AS (SELECT r.round, count(f.word) AS new FROM (SELECT DISTINCT round FROM w) r LEFT JOIN f ON f.round = r.round GROUP BY r.round),
i AS (SELECT round, new, sum(CAST(new > 0 AS INT)) OVER (ORDER BY round) AS island FROM n), d AS (SELECT round, new, sum(CAST(new = 0 AS INT)) OVER (PARTITION BY island ORDER BY round) AS dry FROM i)
SELECT round, new FROM d WHERE round <= coalesce((SELECT min(round) FROM d WHERE dry >= 10), 97)""")
def until_dry(spark, sf_dir):
    """Sample rounds of the words of whole texts until ten in a row bring no new one; a round is a class of documents."""
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), 0)
    words = views.table(spark, sf_dir, "documents").select((F.col("doc_id") % 97).alias("round"), F.explode(F.array_distinct(found)).alias("word"))
    first = words.groupBy("word").agg(F.min("round").alias("round"))
    rounds = words.select("round").distinct().join(first.groupBy("round").agg(F.count(F.lit(1)).alias("new")), "round", "left").select("round", F.coalesce("new", F.lit(0)).alias("new"))
    order = Window.orderBy("round")  # at most 97 rounds
    island = F.sum((F.col("new") > 0).cast("int")).over(order)
    runs = rounds.withColumn("island", island).withColumn("dry", F.sum((F.col("new") == 0).cast("int")).over(Window.partitionBy("island").orderBy("round").rowsBetween(Window.unboundedPreceding, 0)))
    stop = F.min(F.when(F.col("dry") >= 10, F.col("round"))).over(Window.partitionBy(F.lit(1)))
    return runs.withColumn("stop", stop).where("stop IS NULL OR round <= stop").select("round", "new")


_FOLD = f"""{with_views('ver')},
l AS (SELECT norm, block, txt, qty, row_number() OVER (PARTITION BY norm, block ORDER BY pub DESC, src DESC) AS k FROM ver),
s AS (SELECT norm, block, txt, qty FROM l WHERE k = 1 AND txt <> 'R'), n AS (SELECT DISTINCT norm FROM ver)
SELECT n.norm, count(s.block) AS n_live, md5(coalesce(string_agg(s.block || '=' || s.qty, ';' ORDER BY s.block), '')) AS content FROM n LEFT JOIN s ON n.norm = s.norm GROUP BY n.norm"""


@query("reconstruct_as_versions", _FOLD)
def reconstruct_as_versions(spark, sf_dir):
    """Substitutions, insertions and repeals as versions: the last operation on a block decides, no fold needed."""
    last = views.versions(spark, sf_dir).groupBy("norm", "block").agg(F.max_by(F.struct("txt", "qty"), F.struct("pub", "src")).alias("op"))
    live = F.array_sort(F.collect_list(F.when(F.col("op.txt") != "R", F.struct("block", F.col("op.qty").alias("qty")))))
    text = F.array_join(F.transform("live", lambda x: F.concat_ws("=", x["block"], x["qty"])), ";")
    return last.groupBy("norm").agg(live.alias("live")).select("norm", F.size("live").cast("bigint").alias("n_live"), F.md5(text).alias("content"))


def _fold(ops: pd.DataFrame) -> pd.DataFrame:
    state: dict[int, int] = {}
    for op in ops.sort_values(["pub", "src"]).itertuples():
        if op.txt == "R":
            state.pop(op.block, None)
        else:
            state[op.block] = op.qty
    text = ";".join(f"{b}={q}" for b, q in sorted(state.items()))
    return pd.DataFrame([[ops["norm"].iloc[0], len(state), hashlib.md5(text.encode()).hexdigest()]], columns=["norm", "n_live", "content"])


@query("reconstruct_fold", _FOLD)
def reconstruct_fold(spark, sf_dir):
    """The same by folding each norm's operations in order, for operations that depend on the state."""
    importable(spark)
    ops = views.versions(spark, sf_dir).select("norm", "block", "pub", "src", "txt", "qty")
    return ops.groupBy("norm").applyInPandas(_fold, "norm long, n_live long, content string")


@query("register_timeline", """WITH r AS (SELECT o_custkey AS norm, o_orderkey AS act, CAST(o_orderdate AS DATE) AS day, min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS first FROM orders)
SELECT norm, CAST(day AS VARCHAR) AS day, min(act) AS act, count(*) AS n FROM r WHERE day > first GROUP BY norm, day""")
def register_timeline(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("norm"), F.col("o_orderkey").alias("act"), F.to_date("o_orderdate").alias("day"))
    later = rows.withColumn("first", F.min("day").over(Window.partitionBy("norm"))).where("day > first")
    return later.groupBy("norm", "day").agg(F.min("act").alias("act"), F.count(F.lit(1)).alias("n")).withColumn("day", views.iso("day"))


@query("reform_source_priority", f"""{with_views('ver')},
s AS (SELECT norm, string_agg(CAST(src AS VARCHAR), ',' ORDER BY src) FILTER (WHERE qty > 47) AS register, string_agg(CAST(src AS VARCHAR), ',' ORDER BY src) FILTER (WHERE superseded) AS rebuilt, string_agg(CAST(src AS VARCHAR), ',' ORDER BY src) AS generic FROM ver GROUP BY norm)
SELECT norm, coalesce(register, rebuilt, generic) AS reforms, CASE WHEN register IS NOT NULL THEN 'register' WHEN rebuilt IS NOT NULL THEN 'rebuilt' ELSE 'generic' END AS origin FROM s""")
def reform_source_priority(spark, sf_dir):
    """The best source of a norm's timeline that has any event."""
    def of(test=None):
        acts = F.array_sort(F.collect_list(F.when(test, F.col("src")) if test is not None else F.col("src")))
        return F.when(F.size(acts) > 0, F.array_join(F.transform(acts, lambda x: x.cast("string")), ","))

    rows = views.versions(spark, sf_dir).groupBy("norm").agg(of(F.col("qty") > 47).alias("register"), of(F.col("superseded")).alias("rebuilt"), of().alias("generic"))
    origin = F.when(F.col("register").isNotNull(), "register").when(F.col("rebuilt").isNotNull(), "rebuilt").otherwise("generic")
    return rows.select("norm", F.coalesce("register", "rebuilt", "generic").alias("reforms"), origin.alias("origin"))


@query("tree_flatten", """SELECT r_name || '>' || n_name AS path, 2 AS depth, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_name) AS pos FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 1, row_number() OVER (ORDER BY r_name) FROM region""")
def tree_flatten(spark, sf_dir):
    """Sections and their parts as rows of path, depth and place."""
    region, nation = views.table(spark, sf_dir, "region"), views.table(spark, sf_dir, "nation")
    tops = region.select(F.col("r_name").alias("path"), F.lit(1).alias("depth"), F.row_number().over(Window.orderBy("r_name")).cast("bigint").alias("pos"))
    leaves = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    place = F.row_number().over(Window.partitionBy("r_regionkey").orderBy("n_name")).cast("bigint")
    return leaves.select(F.concat_ws(">", "r_name", "n_name").alias("path"), F.lit(2).alias("depth"), place.alias("pos")).unionByName(tops)
