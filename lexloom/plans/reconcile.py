"""Named queries that reconcile sources with what is published."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.operators import reconcile as r
from lexloom.plans.catalogue import query
from lexloom.views import iso, with_views


@query("multiset_new_events", f"""{with_views('log')},
e AS (SELECT norm, kind, id, row_number() OVER (PARTITION BY norm, kind ORDER BY day, id) AS k FROM log),
p AS (SELECT norm, kind, count(*) AS have FROM log WHERE id % 3 = 0 GROUP BY norm, kind)
SELECT e.norm, e.kind, e.id FROM e LEFT JOIN p ON e.norm = p.norm AND e.kind = p.kind WHERE e.k > coalesce(p.have, 0)""")
def multiset_new_events(spark, sf_dir):
    log = views.log(spark, sf_dir)
    return r.multiset_new(log, log.where("id % 3 = 0"), ["norm", "kind"], ["day", "id"]).select("norm", "kind", "id")


@query("counted_difference", f"""{with_views('log')} SELECT norm, kind FROM log EXCEPT ALL SELECT norm, kind FROM log WHERE id % 3 = 0""")
def counted_difference(spark, sf_dir):
    log = views.log(spark, sf_dir)
    return log.select("norm", "kind").exceptAll(log.where("id % 3 = 0").select("norm", "kind"))


@query("disjoint_guard", """SELECT count(*) AS shared FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def disjoint_guard(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    side = lambda status: orders.where(F.col("o_orderstatus") == status).select("o_custkey")
    return side("F").intersect(side("P")).agg(F.count(F.lit(1)).alias("shared"))


@query("discovered_minus_published", """SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'de')""")
def discovered_minus_published(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = views.table(spark, sf_dir, "labels").select("doc_id")
    return docs.select("doc_id").join(labels, "doc_id", "left_anti").join(docs.where("lang = 'de'").select("doc_id"), "doc_id", "left_anti")


@query("two_way_missing", """SELECT c_custkey AS id, 'no file' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT DISTINCT o_custkey, 'no data' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)""")
def two_way_missing(spark, sf_dir):
    customer = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey")
    orders = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")).distinct()
    no_file = customer.join(orders, "id", "left_anti").select("id", F.lit("no file").alias("side"))
    no_data = orders.join(customer.where("c_nationkey < 20"), "id", "left_anti").select("id", F.lit("no data").alias("side"))
    return no_file.unionByName(no_data)


@query("updated_and_published", """SELECT p_partkey AS id FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 48)""")
def updated_and_published(spark, sf_dir):
    queued = views.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity > 48").select(F.col("l_partkey").alias("id"))
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")).join(queued, "id", "left_semi")


@query("reference_integrity", """WITH refs AS (SELECT 'amends' AS field, o_custkey AS target FROM orders UNION ALL SELECT 'last_amendment', o_custkey * 2 FROM orders),
j AS (SELECT field, target, c.c_custkey IS NULL AS missing FROM refs LEFT JOIN customer c ON refs.target = c.c_custkey)
SELECT field, count(*) AS refs, count(*) FILTER (WHERE missing) AS missing, round(count(*) FILTER (WHERE missing) / count(*), 6) AS rate,
  CASE WHEN count(*) FILTER (WHERE missing) = 0 THEN 'ok' WHEN field = 'amends' OR count(*) FILTER (WHERE missing) / count(*) > 0.5 THEN 'error' ELSE 'warn' END AS severity
FROM j GROUP BY field""")
def reference_integrity(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    refs = orders.select(F.lit("amends").alias("field"), F.col("o_custkey").alias("target")).unionAll(orders.select(F.lit("last_amendment"), F.col("o_custkey") * 2))
    known = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("target"), F.lit(True).alias("known"))
    missing = F.count_if(F.col("known").isNull())
    counted = refs.join(known, "target", "left").groupBy("field").agg(F.count(F.lit(1)).alias("refs"), missing.alias("missing"))
    rate = F.col("missing") / F.col("refs")
    severity = F.when(F.col("missing") == 0, "ok").when((F.col("field") == "amends") | (rate > 0.5), "error").otherwise("warn")
    return counted.select("field", "refs", "missing", F.round(rate, 6).alias("rate"), severity.alias("severity"))


@query("value_join_unpublished", """WITH v AS (SELECT page_id, unnest(regexp_extract_all(lower(html), '[a-z]{9,}')) AS w FROM pages),
p AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{9,}')) AS w FROM documents)
SELECT page_id, count(*) AS n_values, count(*) FILTER (WHERE p.w IS NULL) AS unpublished FROM v LEFT JOIN p ON v.w = p.w GROUP BY page_id""")
def value_join_unpublished(spark, sf_dir):
    """Values of a source, whatever field they stand in, that nothing published holds."""
    values = lambda text: F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{9,}"), 0)).alias("w")
    stated = views.table(spark, sf_dir, "pages").select("page_id", values("html"))
    held = views.table(spark, sf_dir, "documents").select(values("text")).distinct().withColumn("held", F.lit(True))
    return stated.join(held, "w", "left").groupBy("page_id").agg(F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("held").isNull()).alias("unpublished"))


@query("lost_fields", """WITH f AS (SELECT event_type AS field, value < 95 AS dropped FROM events UNION ALL SELECT 'props', value < 2 FROM events)
SELECT field, count(*) AS seen, count(*) FILTER (WHERE dropped) AS dropped FROM f GROUP BY field
HAVING count(*) FILTER (WHERE dropped) / count(*) > 0.6 AND count(*) / (SELECT count(*) FROM events) >= 0.01""")
def lost_fields(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    fields = events.select(F.col("event_type").alias("field"), (F.col("value") < 95).alias("lost")).unionAll(events.select(F.lit("props"), F.col("value") < 2))
    total = events.agg(F.count(F.lit(1)).alias("total"))
    counted = fields.groupBy("field").agg(F.count(F.lit(1)).alias("seen"), F.count_if("lost").alias("dropped"))
    return counted.join(F.broadcast(total), F.lit(True)).where("dropped / seen > 0.6 AND seen / total >= 0.01").select("field", "seen", "dropped")


@query("coverage_counters", """WITH d AS (SELECT p_partkey AS id, p_size AS gaps FROM part), p AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_quantity > 49)
SELECT (SELECT count(*) FROM d) AS discovered, (SELECT count(*) FROM p) AS published, (SELECT count(*) FROM d WHERE id NOT IN (SELECT id FROM p)) AS excluded,
  (SELECT CAST(sum(greatest(gaps - 40, 0)) AS BIGINT) FROM d WHERE id IN (SELECT id FROM p)) AS gap_items, (SELECT count(*) FROM d WHERE gaps > 40 AND id IN (SELECT id FROM p)) AS norms_with_gaps""")
def coverage_counters(spark, sf_dir):
    found = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.greatest(F.col("p_size") - 40, F.lit(0)).alias("gaps"))
    published = views.table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("id")).distinct().withColumn("out", F.lit(True))
    joined = found.join(published, "id", "left")
    out = F.col("out").isNotNull()
    return joined.agg(
        F.count(F.lit(1)).alias("discovered"), F.count_if(out).alias("published"), F.count_if(~out).alias("excluded"),
        F.sum(F.when(out, F.col("gaps"))).alias("gap_items"), F.count_if(out & (F.col("gaps") > 0)).alias("norms_with_gaps"))


@query("coverage_delta", """WITH b AS (SELECT doc_id, n_chars // 1000 AS gaps FROM documents WHERE doc_id % 10 <> 0), a AS (SELECT doc_id, n_chars // 900 AS gaps FROM documents WHERE doc_id % 10 <> 1)
SELECT count(a.doc_id) - count(b.doc_id) AS published, CAST(sum(coalesce(a.gaps, 0) - coalesce(b.gaps, 0)) AS BIGINT) AS items,
  count(*) FILTER (WHERE a.gaps > 0) - count(*) FILTER (WHERE b.gaps > 0) AS norms FROM a FULL JOIN b ON a.doc_id = b.doc_id""")
def coverage_delta(spark, sf_dir):
    """Counters from signed rows: what is new counts up, what it replaces counts down; no join."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    signed = docs.where("doc_id % 10 <> 1").selectExpr("1 AS sign", "n_chars div 900 AS gaps").unionByName(docs.where("doc_id % 10 <> 0").selectExpr("-1 AS sign", "n_chars div 1000 AS gaps"))
    return signed.agg(F.sum("sign").alias("published"), F.sum(F.col("sign") * F.col("gaps")).alias("items"), F.sum(F.when(F.col("gaps") > 0, F.col("sign")).otherwise(0)).alias("norms"))


@query("key_clash_disambiguate", """WITH o AS (SELECT o_custkey AS name, o_orderpriority AS owner, min(o_orderkey) AS first, min(CAST(o_orderdate AS DATE)) AS day FROM orders GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY first, owner) AS k FROM o)
SELECT name, owner, CASE k WHEN 1 THEN CAST(name AS VARCHAR) WHEN 2 THEN name || '-' || strftime(day, '%Y%m%d') ELSE name || '-' || left(sha1(owner), 8) END AS stored_as FROM k""")
def key_clash_disambiguate(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("name"), F.col("o_orderpriority").alias("owner"), "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return r.clash_names(rows, "name", "owner", "o_orderkey", F.col("day"))


@query("duplicate_keys", """SELECT md5(text) AS key, count(*) AS n, min(doc_id) AS first_owner, max(doc_id) AS last_owner FROM documents GROUP BY 1 HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    """Keys with more than one owner: how many, the first and the last; no list of owners meets in a row."""
    grouped = views.table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_owner"), F.max("doc_id").alias("last_owner"))
    return grouped.where("n > 1")


@query("act_identity_guard", """WITH s AS (SELECT o_custkey AS key, o_orderkey, CAST(o_orderdate AS DATE) AS pub, CAST(o_totalprice AS BIGINT) // 1000 AS content FROM orders),
l AS (SELECT *, lag(pub) OVER w AS old_pub, lag(content) OVER w AS old FROM s WINDOW w AS (PARTITION BY key ORDER BY o_orderkey))
SELECT o_orderkey AS id, CASE WHEN old IS NULL THEN 'write' WHEN old = content THEN 'unchanged' WHEN old_pub <> pub AND key % 4 <> 0 THEN 'refused' ELSE 'write' END AS outcome FROM l""")
def act_identity_guard(spark, sf_dir):
    """Same content is left alone; another publication date under the same key is another act, but where dates are versioned."""
    chain = Window.partitionBy("key").orderBy("o_orderkey")
    content = F.expr("CAST(round(o_totalprice, 0) AS BIGINT) div 1000")
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey", F.to_date("o_orderdate").alias("pub"), content.alias("content"))
    rows = rows.withColumns({"old_pub": F.lag("pub").over(chain), "old": F.lag("content").over(chain)})
    outcome = F.when(F.col("old").isNull(), "write").when(F.col("old") == F.col("content"), "unchanged").when((F.col("old_pub") != F.col("pub")) & (F.col("key") % 4 != 0), "refused").otherwise("write")
    return rows.select(F.col("o_orderkey").alias("id"), outcome.alias("outcome"))


@query("cdc_content", """WITH n AS (SELECT doc_id, md5(text) AS h FROM documents), o AS (SELECT doc_id, md5(CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 13 <> 0)
SELECT n.doc_id, CASE WHEN o.doc_id IS NULL THEN 'added' ELSE 'changed' END AS change FROM n LEFT JOIN o ON n.doc_id = o.doc_id WHERE o.doc_id IS NULL OR n.h <> o.h""")
def cdc_content(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    old = docs.where("doc_id % 13 <> 0").select("doc_id", F.md5(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("h"))
    return r.changed(docs.select("doc_id", F.md5("text").alias("h")), old, ["doc_id"], "h")


@query("cdc_digest", """WITH n AS (SELECT page_id, sha256(regexp_replace(html, '<title>[^<]*</title>', '')) AS h FROM pages),
o AS (SELECT page_id, sha256(regexp_replace(CASE WHEN page_id % 3 = 0 THEN replace(html, '<title>', '<title>New ') WHEN page_id % 5 = 0 THEN html || ' ' ELSE html END, '<title>[^<]*</title>', '')) AS h FROM pages)
SELECT n.page_id, 'changed' AS change FROM n JOIN o ON n.page_id = o.page_id WHERE n.h <> o.h""")
def cdc_digest(spark, sf_dir):
    """Digests without the part of a page that changes each day."""
    digest = lambda html: F.sha2(F.regexp_replace(html, "<title>[^<]*</title>", ""), 256).alias("h")
    pages = views.table(spark, sf_dir, "pages").select("page_id", "html")
    html = F.when(F.col("page_id") % 3 == 0, F.replace("html", F.lit("<title>"), F.lit("<title>New "))).when(F.col("page_id") % 5 == 0, F.concat("html", F.lit(" "))).otherwise(F.col("html"))
    return r.changed(pages.select("page_id", digest("html")), pages.select("page_id", digest(html)), ["page_id"], "h")


@query("cdc_lastmod", f"""{with_views('log')},
o AS (SELECT norm, max(day) AS m FROM log WHERE day < DATE '2024-01-20' GROUP BY norm), n AS (SELECT norm, max(day) AS m FROM log GROUP BY norm)
SELECT n.norm, CASE WHEN o.norm IS NULL THEN 'added' ELSE 'changed' END AS change FROM n LEFT JOIN o ON n.norm = o.norm WHERE (o.norm IS NULL OR o.m <> n.m) AND (SELECT count(*) FROM o) > 0""")
def cdc_lastmod(spark, sf_dir):
    """Changed modification days; without a baseline nothing counts as changed."""
    log = views.log(spark, sf_dir)
    newest = lambda rows: rows.groupBy("norm").agg(F.max("day").alias("m"))
    old = newest(log.where("day < DATE '2024-01-20'"))
    guard = old.limit(1).select(F.lit(True).alias("_any"))  # one row, or none without a baseline
    return r.changed(newest(log), old, ["norm"], "m").join(F.broadcast(guard), F.lit(True), "left_semi")


@query("cdc_cumulative_diff", f"""{with_views('log')} SELECT norm FROM log WHERE day >= DATE '2024-01-15' EXCEPT SELECT norm FROM log WHERE day >= DATE '2024-01-16'""")
def cdc_cumulative_diff(spark, sf_dir):
    log = views.log(spark, sf_dir)
    since = lambda day: log.where(F.col("day") >= F.lit(day).cast("date")).select("norm")
    return since("2024-01-15").subtract(since("2024-01-16"))


@query("daily_attribution", f"""{with_views('log')} SELECT norm, CAST(max(day) AS VARCHAR) AS day, count(*) AS changes FROM log WHERE kind = 'purchase' GROUP BY norm""")
def daily_attribution(spark, sf_dir):
    """A norm that changed on several days is yielded once, on its latest."""
    return views.log(spark, sf_dir).where("kind = 'purchase'").groupBy("norm").agg(iso(F.max("day")).alias("day"), F.count(F.lit(1)).alias("changes"))


@query("surface_union", f"""{with_views('log')},
u AS (SELECT norm, 1 AS priority, id FROM log WHERE kind = 'signup' UNION ALL SELECT norm, 2, id FROM log WHERE kind = 'purchase' UNION ALL SELECT norm, 3, id FROM log)
SELECT norm, priority, id FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY priority, id) AS k FROM u) WHERE k = 1""")
def surface_union(spark, sf_dir):
    """Several lists of keys merged; the first list that has a key wins."""
    log = views.log(spark, sf_dir)
    lists = [log.where("kind = 'signup'"), log.where("kind = 'purchase'"), log]
    parts = [rows.select("norm", F.lit(i).alias("priority"), "id") for i, rows in enumerate(lists, 1)]
    both = parts[0].unionAll(parts[1]).unionAll(parts[2])
    first = both.groupBy("norm").agg(F.min(F.struct("priority", "id")).alias("first"))
    return first.select("norm", "first.priority", "first.id")


@query("recent_days", f"""{with_views('log')}
SELECT DISTINCT CAST(day AS VARCHAR) AS day FROM (SELECT day FROM log WHERE day > DATE '2024-01-25' UNION SELECT unnest(generate_series(DATE '2024-01-22', DATE '2024-01-24', INTERVAL 1 DAY))::DATE)""")
def recent_days(spark, sf_dir):
    days = views.log(spark, sf_dir).where("day > DATE '2024-01-25'").select("day")
    last = spark.range(1).select(F.explode(F.sequence(F.lit("2024-01-22").cast("date"), F.lit("2024-01-24").cast("date"))).alias("day"))
    return days.union(last).distinct().select(iso("day").alias("day"))


@query("marker_algebra", r"""WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '[0-9]+')) AS refs, list_distinct(regexp_extract_all(text, '\(([0-9]+)\)', 1)) AS defs FROM documents)
SELECT doc_id, array_to_string(list_sort(list_filter(refs, lambda x: NOT list_contains(defs, x))), ',') AS undefined FROM t WHERE len(refs) > 0""")
def marker_algebra(spark, sf_dir):
    """References without a definition."""
    rows = views.table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract_all("text", F.lit("[0-9]+"), 0).alias("refs"), F.regexp_extract_all("text", F.lit(r"\(([0-9]+)\)"), 1).alias("defs"))
    return rows.where(F.size("refs") > 0).select("doc_id", F.array_join(F.array_sort(F.array_except("refs", "defs")), ",").alias("undefined"))


@query("failure_ledger", """WITH f AS (SELECT event_id AS id, user_id AS key, event_type = 'error' AS failed, ts FROM events),
l AS (SELECT key, arg_max(failed, (ts, id)) AS failing, count(*) FILTER (WHERE failed) AS failures, bool_or(failed AND id % 2 = 0) AS transient FROM f GROUP BY key)
SELECT key, failures, coalesce(transient, false) AS transient FROM l WHERE failures > 0 AND NOT failing""")
def failure_ledger(spark, sf_dir):
    """Dead letters that a later success has cleared, by key."""
    failed = F.col("event_type") == "error"
    rows = views.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("key")).agg(
        F.max_by(failed, F.struct("ts", "event_id")).alias("failing"), F.count_if(failed).alias("failures"), F.bool_or(failed & (F.col("event_id") % 2 == 0)).alias("transient"))
    return rows.where("failures > 0 AND NOT failing").select("key", "failures", "transient")


@query("exclusion_ledger", """WITH n AS (SELECT doc_id, CASE WHEN n_chars = 0 THEN 'empty' WHEN n_chars / (doc_id % 9 + 1) < 60 AND doc_id % 9 >= 5 THEN 'low density' WHEN lang = 'de' AND doc_id % 2 = 0 THEN 'section' END AS reason FROM documents)
SELECT reason, count(*) AS n, CAST(min(doc_id) AS BIGINT) AS example FROM n WHERE reason IS NOT NULL GROUP BY reason""")
def exclusion_ledger(spark, sf_dir):
    pages = F.col("doc_id") % 9
    reason = F.when(F.col("n_chars") == 0, "empty").when((F.col("n_chars") / (pages + 1) < 60) & (pages >= 5), "low density").when((F.col("lang") == "de") & (F.col("doc_id") % 2 == 0), "section")
    return views.table(spark, sf_dir, "documents").select("doc_id", reason.alias("reason")).where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("example"))
