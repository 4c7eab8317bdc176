"""Named queries that aggregate: picks, folds, quality measures, censuses."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.plans.catalogue import query
from lexloom.plans.order import numbered
from lexloom.views import iso, with_views


@query("argmax_tuple", """SELECT l_partkey AS norm, (max((l_orderkey % 100) * 10000000 + l_orderkey)) % 10000000 AS last_amender FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1""")
def argmax_tuple(spark, sf_dir):
    """The act with the largest (year, number), of some kinds only."""
    line = views.table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin("A", "R"))
    return line.groupBy(F.col("l_partkey").alias("norm")).agg(F.max_by("l_orderkey", F.struct(F.col("l_orderkey") % 100, "l_orderkey")).alias("last_amender"))


@query("argmax_length", """SELECT lang, source, arg_max(doc_id, n_chars * 1000000000 - doc_id) AS fullest FROM documents GROUP BY ALL""")
def argmax_length(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("fullest"))


@query("group_latest", f"""{with_views('ver')} SELECT norm, block, any_value(src) AS canonical FROM (SELECT *, row_number() OVER (PARTITION BY norm, block ORDER BY coalesce(eff, DATE '1900-01-01') DESC, src) AS k FROM ver) WHERE k = 1 GROUP BY norm, block""")
def group_latest(spark, sf_dir):
    order = F.struct(F.coalesce("eff", F.lit("1900-01-01").cast("date")), -F.col("src"))
    return views.versions(spark, sf_dir).groupBy("norm", "block").agg(F.max_by("src", order).alias("canonical"))


@query("rank_preferred_pick", """WITH r AS (SELECT o_custkey AS k, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE left(o_orderpriority, 1) WHEN '3' THEN 0 WHEN '1' THEN 1 ELSE 2 END, o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT k, o_orderkey AS picked, n - 1 AS alternatives FROM r WHERE i = 1""")
def rank_preferred_pick(spark, sf_dir):
    """The best format by a fixed preference, with the number of others."""
    kind = F.left("o_orderpriority", F.lit(1))
    rank = F.when(kind == "3", 0).when(kind == "1", 1).otherwise(2)
    return views.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min_by("o_orderkey", F.struct(rank, "o_orderkey")).alias("picked"), (F.count(F.lit(1)) - 1).alias("alternatives"))


@query("amender_minimum", """WITH m AS (SELECT l_partkey AS k, l_suppkey AS amender, min(l_orderkey) AS first FROM lineitem GROUP BY 1, 2) SELECT k, arg_max(amender, first * 100000 + amender) AS latest, count(*) AS n FROM m GROUP BY 1""")
def amender_minimum(spark, sf_dir):
    first = views.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("k"), F.col("l_suppkey").alias("amender")).agg(F.min("l_orderkey").alias("first"))
    return first.groupBy("k").agg(F.max_by("amender", F.struct("first", "amender")).alias("latest"), F.count(F.lit(1)).alias("n"))


@query("distinct_lists", """SELECT o_custkey AS k, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY 1""")
def distinct_lists(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"), F.size(F.collect_set("o_orderpriority")).cast("bigint").alias("priorities"))


@query("first_per_date", f"""{with_views('log')} SELECT norm, CAST(day AS VARCHAR) AS day, min(id) AS first, count(*) AS n FROM log GROUP BY norm, day""")
def first_per_date(spark, sf_dir):
    return views.log(spark, sf_dir).groupBy("norm", "day").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).withColumn("day", iso("day"))


@query("first_wins_map", f"""{with_views('log')} SELECT norm, kind, arg_min(value, id) AS value FROM log GROUP BY norm, kind""")
def first_wins_map(spark, sf_dir):
    return views.log(spark, sf_dir).groupBy("norm", "kind").agg(F.min_by("value", "id").alias("value"))


@query("newest_and_oldest", f"""{with_views('log')} SELECT norm, CAST(min(day) AS VARCHAR) AS oldest, CAST(max(day) AS VARCHAR) AS newest, max(day) FILTER (WHERE kind = 'purchase')::VARCHAR AS head FROM log GROUP BY norm""")
def newest_and_oldest(spark, sf_dir):
    return views.log(spark, sf_dir).groupBy("norm").agg(iso(F.min("day")).alias("oldest"), iso(F.max("day")).alias("newest"), iso(F.max(F.when(F.col("kind") == "purchase", F.col("day")))).alias("head"))


@query("status_fold", f"""{with_views('ver')}
SELECT norm, CASE WHEN bool_or(txt = 'R' AND eff <= DATE '1996-06-30') THEN 'repealed' WHEN bool_or(txt = 'A' AND coalesce(eff, pub) <= DATE '1996-06-30') THEN 'partially_repealed' ELSE 'in_force' END AS status FROM ver GROUP BY norm""")
def status_fold(spark, sf_dir):
    day = F.lit("1996-06-30").cast("date")
    whole, part = F.bool_or((F.col("txt") == "R") & (F.col("eff") <= day)), F.bool_or((F.col("txt") == "A") & (F.coalesce("eff", "pub") <= day))
    return views.versions(spark, sf_dir).groupBy("norm").agg(F.when(whole, "repealed").when(part, "partially_repealed").otherwise("in_force").alias("status"))


@query("status_flags", """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN 'annulled' WHEN o_orderstatus = 'F' THEN 'repealed' WHEN o_orderpriority LIKE '1%' THEN 'partially_repealed' ELSE 'in_force' END AS status FROM orders""")
def status_flags(spark, sf_dir):
    gone = F.col("o_orderstatus") == "F"
    status = F.when(gone & (F.col("o_totalprice") > 300000), "annulled").when(gone, "repealed").when(F.col("o_orderpriority").startswith("1"), "partially_repealed").otherwise("in_force")
    return views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), status.alias("status"))


@query("structure_counts", """WITH l AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, CASE WHEN lang <> 'de' THEN count(*) FILTER (WHERE length(line) < 60) END AS headings, CASE WHEN lang <> 'de' THEN count(*) FILTER (WHERE length(line) < 60 AND regexp_matches(line, '^[A-Z][a-z]+ ')) END AS articles FROM l GROUP BY doc_id, lang""")
def structure_counts(spark, sf_dir):
    """Headings and articles; null where a jurisdiction has no pattern to measure by.  No explode: counted inside the row."""
    lines = F.split("text", "\n", -1)
    heading = lambda x: F.length(x) < 60
    measured = lambda n: F.when(F.col("lang") != "de", n.cast("bigint"))
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", measured(F.size(F.filter(lines, heading))).alias("headings"),
        measured(F.size(F.filter(lines, lambda x: heading(x) & x.rlike("^[A-Z][a-z]+ ")))).alias("articles"))


@query("jaccard_similarity", """WITH w AS (SELECT doc_id, list_distinct(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS ws, lag(list_distinct(list_filter(string_split(lower(text), ' '), lambda x: x <> ''))) OVER (PARTITION BY source ORDER BY doc_id) AS vs FROM documents),
j AS (SELECT doc_id, len(list_intersect(ws, vs)) / (len(ws) + len(vs) - len(list_intersect(ws, vs))) AS j FROM w WHERE vs IS NOT NULL)
SELECT doc_id, round(j, 6) AS similarity, CASE WHEN 1 - j <= 0.05 THEN 'clean' WHEN 1 - j <= 0.30 THEN 'partial' ELSE 'bootstrap_only' END AS quality FROM j""")
def jaccard_similarity(spark, sf_dir):
    """Word-set similarity of a text with the one before it, and the class of its drift."""
    words = F.array_distinct(F.filter(F.split(F.lower("text"), " ", -1), lambda x: x != ""))
    sets = views.table(spark, sf_dir, "documents").select("doc_id", words.alias("ws"))
    pairs = _before(spark, sf_dir)
    rows = sets.join(pairs, "doc_id").join(sets.select(F.col("doc_id").alias("before"), F.col("ws").alias("vs")), "before")
    shared = F.size(F.array_intersect("ws", "vs"))
    j = shared / (F.size("ws") + F.size("vs") - shared)
    quality = F.when(1 - F.col("j") <= 0.05, "clean").when(1 - F.col("j") <= 0.30, "partial").otherwise("bootstrap_only")
    return rows.select("doc_id", j.alias("j")).select("doc_id", F.round("j", 6).alias("similarity"), quality.alias("quality"))


def _before(spark, sf_dir):
    """(doc_id, before): each document and the one before it in its source, by numbers given in ranges.

    Only ids are ordered, and no task holds a whole source; texts join by id.
    """
    ids = numbered(views.table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id")
    last = ids.select(F.col("source").alias("of"), (F.col("n") + 1).alias("n"), F.col("doc_id").alias("before"))
    return ids.join(last, "n").where("source = of").select("doc_id", "before")


@query("sequence_similarity")
def sequence_similarity(spark, sf_dir):
    """Longest-matching-blocks ratio of a text's lines with the one before it in its source.

    Matching blocks have no relational form; pairs are lined up by id and scored in Arrow batches.
    """
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    pairs = docs.join(_before(spark, sf_dir), "doc_id").join(docs.select(F.col("doc_id").alias("before"), F.col("text").alias("old")), "before")

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, x.split("\n"), y.split("\n"), autojunk=False).ratio() for x, y in zip(a, b, strict=True)])

    return pairs.select("doc_id", F.round(ratio("old", "text"), 6).alias("ratio"))


_DEFECTS = {"tabs": "contains(text, chr(9))", "double_space": "contains(text, '  ')", "pipes": "contains(text, ' | ')", "tags": "contains(text, '<')", "long_line": "length(text) > 4000"}
_FLAGS = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in _DEFECTS.items())


@query("defect_flags", f"SELECT doc_id, concat_ws(',', {_FLAGS}) AS defects FROM documents")
def defect_flags(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").select("doc_id", F.expr(f"concat_ws(',', {_FLAGS})").alias("defects"))


@query("defect_histogram", f"""WITH d AS (SELECT lang, concat_ws(',', {_FLAGS}) AS defects FROM documents), x AS (SELECT lang, unnest(string_split(defects, ',')) AS defect FROM d WHERE defects <> '')
SELECT x.lang, defect, count(*) AS n, round(100.0 * any_value(c.clean) / any_value(c.n), 4) AS clean_percent
FROM x JOIN (SELECT lang, count(*) AS n, count(*) FILTER (WHERE defects = '') AS clean FROM d GROUP BY lang) c ON x.lang = c.lang GROUP BY x.lang, defect""")
def defect_histogram(spark, sf_dir):
    flags = F.expr(f"array_compact(array({_FLAGS}))")
    docs = views.table(spark, sf_dir, "documents").select("lang", flags.alias("defects"))
    clean = docs.groupBy("lang").agg(F.round(100.0 * F.count_if(F.size("defects") == 0) / F.count(F.lit(1)), 4).alias("clean_percent"))
    counts = docs.select("lang", F.explode("defects").alias("defect")).groupBy("lang", "defect").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(clean, "lang").select("lang", "defect", "n", "clean_percent")


_CONSTRUCTS = {"lines": r"\n", "numbers": "[0-9]+", "sentences": "[.] ", "quotes": '"'}
_KEPT = "CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN replace(text, '. ', ' ') WHEN 2 THEN regexp_replace(text, '[0-9]+', '#'{g}) ELSE left(text, CAST({left} AS INT)) END"


@query("fidelity_report", f"""WITH d AS (SELECT doc_id, lang, text, {_KEPT.format(g=", 'g'", left="length(text) * 0.8")} AS shown FROM documents WHERE text <> ''),
s AS (SELECT lang, {", ".join(f"len(regexp_extract_all(text, '{p}')) AS {n}_a, len(regexp_extract_all(shown, '{p}')) AS {n}_b" for n, p in _CONSTRUCTS.items())}, length(shown) / length(text) AS kept FROM d),
c AS (SELECT lang, concat_ws(',', {", ".join(f"CASE WHEN {n}_b < {n}_a THEN '{n}' END" for n in _CONSTRUCTS)}) AS lost, CASE WHEN kept >= 0.95 THEN 'whole' WHEN kept >= 0.7 THEN 'partial' ELSE 'poor' END AS size FROM s)
SELECT lang, size, lost, count(*) AS n FROM c GROUP BY ALL""")
def fidelity_report(spark, sf_dir):
    """What a rendering lost of its source: constructs by their counts, and the class of what is left."""
    whole = _KEPT.format(g="", left="round(length(text) * 0.8)")  # Spark's cast cuts the fraction off, DuckDB's rounds
    docs = views.table(spark, sf_dir, "documents").where("text <> ''").select("lang", "text", F.expr(whole).alias("shown"))
    lost = F.concat_ws(",", *[F.when(F.regexp_count("shown", F.lit(p)) < F.regexp_count("text", F.lit(p)), n) for n, p in _CONSTRUCTS.items()])
    kept = F.length("shown") / F.length("text")
    size = F.when(kept >= 0.95, "whole").when(kept >= 0.7, "partial").otherwise("poor")
    return docs.select("lang", size.alias("size"), lost.alias("lost")).groupBy("lang", "size", "lost").agg(F.count(F.lit(1)).alias("n"))


@query("thesaurus_gap", """WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS term FROM benchmark), w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{4,}'))) AS term FROM documents WHERE lang = 'en')
SELECT w.term, count(*) AS n FROM w LEFT JOIN t ON w.term = t.term WHERE t.term IS NULL GROUP BY w.term HAVING count(*) >= 3""")
def thesaurus_gap(spark, sf_dir):
    """Terms of the documents that a thesaurus lacks, with the documents that use each."""
    terms = lambda rows: rows.select("*", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), 0))).alias("term"))
    used = terms(views.table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", "text")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    return used.join(terms(views.table(spark, sf_dir, "benchmark").select("text")).select("term").distinct(), "term", "left_anti")


@query("empty_articles", """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
g AS (SELECT doc_id, i, length(line) < 30 AS heading, lead(length(line) < 30) OVER (PARTITION BY doc_id ORDER BY i) AS next_heading FROM l)
SELECT doc_id, count(*) FILTER (WHERE heading) AS articles, count(*) FILTER (WHERE heading AND coalesce(next_heading, true)) AS empty FROM g GROUP BY doc_id""")
def empty_articles(spark, sf_dir):
    """Headings followed at once by another heading or the end, found inside each row's array of lines."""
    heads = F.transform(F.split("text", "\n", -1), lambda x: F.length(x) < 30)
    pairs = F.zip_with("heads", F.concat(F.slice(F.col("heads"), F.lit(2), F.size("heads")), F.array(F.lit(True))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rows = views.table(spark, sf_dir, "documents").select("doc_id", heads.alias("heads"))
    return rows.select("doc_id", F.size(F.filter("heads", lambda x: x)).cast("bigint").alias("articles"), F.size(F.filter(pairs, lambda p: p["a"] & p["b"])).cast("bigint").alias("empty"))


@query("commit_date_anomalies", """WITH c AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT count(*) FILTER (WHERE d < DATE '1995-02-01' AND o_orderkey % 2 = 0) AS epoch, count(*) FILTER (WHERE d > DATE '2001-06-30' AND year(d) > 2001) AS far_future, count(*) FILTER (WHERE d > DATE '2001-06-30' AND year(d) <= 2001) AS near_future FROM c""")
def commit_date_anomalies(spark, sf_dir):
    day = F.to_date("o_orderdate")
    late = day > F.lit("2001-06-30").cast("date")
    return views.table(spark, sf_dir, "orders").agg(
        F.count_if((day < F.lit("1995-02-01").cast("date")) & (F.col("o_orderkey") % 2 == 0)).alias("epoch"), F.count_if(late & (F.year(day) > 2001)).alias("far_future"), F.count_if(late & (F.year(day) <= 2001)).alias("near_future"))


@query("census_type_state_decade", """SELECT o_orderstatus AS state, substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 3) || '0s' AS decade, CASE WHEN contains(o_orderpriority, 'URGENT') THEN 'urgent' WHEN contains(o_orderpriority, 'HIGH') THEN 'high' ELSE 'routine' END AS class, count(*) AS n, count(DISTINCT o_custkey) AS acts FROM orders GROUP BY ALL""")
def census_type_state_decade(spark, sf_dir):
    word = F.when(F.contains("o_orderpriority", F.lit("URGENT")), "urgent").when(F.contains("o_orderpriority", F.lit("HIGH")), "high").otherwise("routine")
    decade = F.concat(F.substring(iso("o_orderdate"), 1, 3), F.lit("0s"))
    return views.table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("state"), decade.alias("decade"), word.alias("class")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("acts"))


@query("latency_percentiles", """SELECT event_type AS level, count(*) AS n, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(avg(value), 6) AS mean, max(value) AS worst FROM events GROUP BY 1""")
def latency_percentiles(spark, sf_dir):
    p = F.percentile("value", F.array(F.lit(0.5), F.lit(0.95)))
    rows = views.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("level")).agg(F.count(F.lit(1)).alias("n"), p.alias("p"), F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("worst"))
    return rows.select("level", "n", F.round(F.col("p")[0], 6).alias("p50"), F.round(F.col("p")[1], 6).alias("p95"), "mean", "worst")


@query("dominant_value", """WITH c AS (SELECT l_partkey AS k, CAST(l_quantity AS INT) AS size, count(*) AS n FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, size) AS i FROM c) SELECT k, size, n FROM r WHERE i = 1""")
def dominant_value(spark, sf_dir):
    """The most frequent value, the smallest of equals, in two combining aggregations."""
    counts = views.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("k"), F.col("l_quantity").cast("int").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("k").agg(F.max_by(F.struct("size", "n"), F.struct("n", -F.col("size"))).alias("best")).select("k", "best.size", "best.n")


@query("repeated_headers", """WITH l AS (SELECT source, doc_id, unnest(string_split(text, chr(10))[1:3]) AS line FROM documents)
SELECT source, md5(line) AS header, count(DISTINCT doc_id) AS pages FROM l WHERE line <> '' GROUP BY source, line HAVING count(DISTINCT doc_id) > 1""")
def repeated_headers(spark, sf_dir):
    """Lines at the top of more than one page."""
    top = F.array_distinct(F.slice(F.split("text", "\n", -1), 1, 3))
    lines = views.table(spark, sf_dir, "documents").select("source", F.explode(top).alias("line")).where("line <> ''")
    return lines.groupBy("source", "line").agg(F.count(F.lit(1)).alias("pages")).where("pages > 1").select("source", F.md5("line").alias("header"), "pages")


@query("source_consistency", f"""{with_views('ver')} SELECT norm, count(DISTINCT txt) AS states, CASE WHEN count(DISTINCT txt) > 1 THEN 'conflict' ELSE min(txt) END AS state FROM ver GROUP BY norm""")
def source_consistency(spark, sf_dir):
    states = F.collect_set("txt")
    return views.versions(spark, sf_dir).groupBy("norm").agg(F.size(states).cast("bigint").alias("states"), F.when(F.size(states) > 1, "conflict").otherwise(F.min("txt")).alias("state"))


@query("ordered_notes", f"""{with_views('log')}, f AS (SELECT norm, kind, min(id) AS first FROM log GROUP BY norm, kind) SELECT norm, string_agg(kind, '; ' ORDER BY first) AS notes FROM f GROUP BY norm""")
def ordered_notes(spark, sf_dir):
    """Distinct notes in the order in which they first came."""
    first = views.log(spark, sf_dir).groupBy("norm", "kind").agg(F.min("id").alias("first"))
    notes = F.array_sort(F.collect_list(F.struct("first", "kind")))
    return first.groupBy("norm").agg(F.array_join(F.transform(notes, lambda x: x["kind"]), "; ").alias("notes"))


@query("run_counters", """SELECT CAST(ts AS DATE)::VARCHAR AS day, count(*) AS processed, count(*) FILTER (WHERE event_type = 'error') AS failed, round(sum(value), 4) AS total, round(count(*) / 24.0, 6) AS per_hour FROM events GROUP BY 1""")
def run_counters(spark, sf_dir):
    return views.table(spark, sf_dir, "events").groupBy(iso("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(F.col("event_type") == "error").alias("failed"), F.round(F.sum("value"), 4).alias("total"), F.round(F.count(F.lit(1)) / 24.0, 6).alias("per_hour"))


@query("country_summary", """SELECT r_name AS country, count(*) AS law_count, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS ranks FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def country_summary(spark, sf_dir):
    customer = views.table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))  # shrinks before the dimensions join
    nation, region = views.table(spark, sf_dir, "nation"), views.table(spark, sf_dir, "region")
    places = F.broadcast(nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")))
    joined = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy(F.col("r_name").alias("country")).agg(F.sum("n").alias("law_count"), F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("ranks"))


@query("status_counts", """SELECT n_name AS country, count(*) AS norms, count(*) FILTER (WHERE c_acctbal < 0) AS in_arrears, CAST(round(sum(c_acctbal)) AS BIGINT) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def status_counts(spark, sf_dir):
    counts = views.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("norms"), F.count_if(F.col("c_acctbal") < 0).alias("in_arrears"), F.round(F.sum("c_acctbal")).cast("bigint").alias("total"))
    return counts.join(F.broadcast(views.table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("country"), "norms", "in_arrears", "total")


@query("exclusion_tranche", """SELECT lang AS reason, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE n_chars < 1500 GROUP BY 1""")
def exclusion_tranche(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").where("n_chars < 1500").groupBy(F.col("lang").alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
