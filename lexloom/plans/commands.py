"""Named queries behind the user-facing commands: health, history, coverage, event log."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.plans.catalogue import query
from lexloom.views import iso, with_views


@query("health_report", """SELECT 'duplicate texts' AS check_name, 'warn' AS severity, (SELECT count(*) FROM (SELECT md5(text) FROM documents GROUP BY 1 HAVING count(*) > 1)) AS n
UNION ALL SELECT 'orders without customer', 'error', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'norms without versions', 'warn', (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem))
UNION ALL SELECT 'future events', 'error', (SELECT count(*) FROM events WHERE ts > TIMESTAMP '2024-01-30')""")
def health_report(spark, sf_dir):
    """A row for each check; checks run side by side in one plan."""
    t = lambda name: views.table(spark, sf_dir, name)
    row = lambda rows, name, severity: rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "n")
    copies = t("documents").groupBy(F.md5("text").alias("h")).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    lost = t("orders").select(F.col("o_custkey").alias("k")).join(t("customer").select(F.col("c_custkey").alias("k")), "k", "left_anti")
    bare = t("part").select(F.col("p_partkey").alias("k")).join(t("lineitem").select(F.col("l_partkey").alias("k")), "k", "left_anti")
    future = t("events").where("ts > TIMESTAMP_NTZ '2024-01-30 00:00:00'")
    checks = [row(copies, "duplicate texts", "warn"), row(lost, "orders without customer", "error"), row(bare, "norms without versions", "warn"), row(future, "future events", "error")]
    out = checks[0]
    for check in checks[1:]:
        out = out.unionAll(check)
    return out


@query("law_history", f"""{with_views('ver')} SELECT src, CAST(pub AS VARCHAR) AS pub, norm, CASE WHEN norm = 42 THEN 'own' ELSE 'reverse' END AS side FROM ver WHERE norm = 42 OR src IN (SELECT src FROM ver WHERE norm = 42)""")
def law_history(spark, sf_dir):
    """The log of one norm and what its acts changed elsewhere; the predicate reaches the scan of the lines."""
    v = views.versions(spark, sf_dir)
    acts = v.where("norm = 42").select("src").distinct()
    side = F.when(F.col("norm") == 42, "own").otherwise("reverse")
    return v.join(acts, "src", "left_semi").select("src", iso("pub").alias("pub"), "norm", side.alias("side"))


@query("coverage_report", """WITH d AS (SELECT p_partkey AS id, CASE WHEN p_size > 45 THEN 'timeout' WHEN p_size > 40 THEN 'no text' END AS reason FROM part), p AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_quantity > 47)
SELECT d.id, coalesce(d.reason, 'not fetched') AS reason, d.reason IS NOT DISTINCT FROM 'timeout' AS transient FROM d LEFT JOIN p ON d.id = p.id WHERE p.id IS NULL""")
def coverage_report(spark, sf_dir):
    """What was discovered and is not published, with the reason a failure left."""
    reason = F.when(F.col("p_size") > 45, "timeout").when(F.col("p_size") > 40, "no text")
    found = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), reason.alias("why"))
    published = views.table(spark, sf_dir, "lineitem").where("l_quantity > 47").select(F.col("l_partkey").alias("id"))
    return found.join(published, "id", "left_anti").select("id", F.coalesce("why", F.lit("not fetched")).alias("reason"), F.col("why").eqNullSafe("timeout").alias("transient"))


@query("event_log", f"""{with_views('ver')},
e AS (SELECT norm, pub, src, count(*) AS n FROM ver GROUP BY norm, pub, src)
SELECT norm, src, CAST(greatest(pub, DATE '1970-01-02') AS VARCHAR) AS author_date, CASE WHEN row_number() OVER (PARTITION BY norm ORDER BY pub, src) = 1 THEN 'bootstrap' ELSE 'reform' END AS kind, '[reform] ' || norm || ' (' || n || ')' AS subject FROM e""")
def event_log(spark, sf_dir):
    """One event for each norm and act, in the order of the norm's history."""
    events = views.versions(spark, sf_dir).groupBy("norm", "pub", "src").agg(F.count(F.lit(1)).alias("n"))
    first = F.row_number().over(Window.partitionBy("norm").orderBy("pub", "src")) == 1
    return events.select(
        "norm", "src", iso(F.greatest("pub", F.lit("1970-01-02").cast("date"))).alias("author_date"), F.when(first, "bootstrap").otherwise("reform").alias("kind"),
        F.concat(F.lit("[reform] "), F.col("norm").cast("string"), F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("subject"))


@query("message_rewrite", f"""{with_views('log')} SELECT id, replace('kind: ' || kind, 'kind: error', 'kind: failure') AS message FROM log""")
def message_rewrite(spark, sf_dir):
    message = F.concat(F.lit("kind: "), "kind")
    return views.log(spark, sf_dir).select("id", F.replace(message, F.lit("kind: error"), F.lit("kind: failure")).alias("message"))


@query("reprocess_scope", f"""{with_views('ver')} SELECT norm, block, src, CASE WHEN norm IN (3, 5, 8) THEN 'rewritten' ELSE 'kept' END AS outcome FROM ver""")
def reprocess_scope(spark, sf_dir):
    """Only the named keys are written anew."""
    return views.versions(spark, sf_dir).select("norm", "block", "src", F.when(F.col("norm").isin(3, 5, 8), "rewritten").otherwise("kept").alias("outcome"))


@query("sample_rendering", f"""{with_views('ver')}, l AS (SELECT norm, block, txt, row_number() OVER (PARTITION BY norm, block ORDER BY coalesce(eff, pub) DESC, pub DESC, src) AS k FROM ver)
SELECT norm, string_agg(block || '. ' || txt, chr(10) ORDER BY block) AS text FROM l WHERE k = 1 GROUP BY norm""")
def sample_rendering(spark, sf_dir):
    from lexloom.operators.temporal import latest

    chosen = latest(views.versions(spark, sf_dir), ("norm", "block"), ("txt",))
    lines = F.array_sort(F.collect_list(F.struct("block", "txt")))
    return chosen.groupBy("norm").agg(F.array_join(F.transform(lines, lambda x: F.concat(x["block"].cast("string"), F.lit(". "), x["txt"])), "\n").alias("text"))


@query("dimension_policy", """SELECT n_nationkey AS source, CASE n_nationkey % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'cumulative' WHEN 2 THEN 'snapshot' WHEN 3 THEN 'probe' ELSE 'none' END AS signal, n_nationkey % 5 <> 4 AS has_daily FROM nation""")
def dimension_policy(spark, sf_dir):
    """How each source tells what changed: a policy table, not branches in code."""
    signals = F.array(*[F.lit(x) for x in ("exact", "cumulative", "snapshot", "probe", "none")])
    kind = F.element_at(signals, F.col("n_nationkey") % 5 + 1)
    return views.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source"), kind.alias("signal"), (kind != "none").alias("has_daily"))
