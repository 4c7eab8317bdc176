"""Named queries on the state of documents at a day and on their timelines."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.operators import temporal as t
from lexloom.plans.catalogue import query
from lexloom.views import iso, with_views

DAY = "1998-06-30"


def _day():
    return F.lit(DAY).cast("date")


_F = "coalesce(eff, pub)"
_RANK = f"row_number() OVER (PARTITION BY norm, block ORDER BY {_F} DESC, pub DESC, src)"


@query("asof_select", f"""{with_views('ver')}
SELECT norm, block, src, CAST(pub AS VARCHAR) AS pub, CAST(eff AS VARCHAR) AS eff, txt
FROM (SELECT *, {_RANK} AS k FROM ver WHERE {_F} <= DATE '{DAY}') WHERE k = 1""")
def asof_select(spark, sf_dir):
    return t.as_of(views.versions(spark, sf_dir), _day()).select("norm", "block", "src", iso("pub").alias("pub"), iso("eff").alias("eff"), "txt")


@query("asof_expiry", f"""{with_views('ver')}
SELECT norm, block, src, txt FROM (SELECT *, {_RANK} AS k FROM ver
  WHERE {_F} <= DATE '{DAY}' AND NOT superseded AND (expiry IS NULL OR expiry > DATE '{DAY}' OR {_F} >= expiry)) WHERE k = 1""")
def asof_expiry(spark, sf_dir):
    return t.as_of_strict(views.versions(spark, sf_dir), _day()).select("norm", "block", "src", "txt")


@query("asof_or_first", f"""{with_views('ver')},
n AS (SELECT norm, src FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY {_F} DESC, pub DESC, src) k FROM ver WHERE {_F} <= DATE '1995-06-30') WHERE k = 1),
e AS (SELECT norm, src FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY {_F}, pub, src) k FROM ver) WHERE k = 1)
SELECT e.norm, coalesce(n.src, e.src) AS src, n.src IS NULL AS fallback FROM e LEFT JOIN n ON e.norm = n.norm""")
def asof_or_first(spark, sf_dir):
    return t.as_of_or_first(views.versions(spark, sf_dir), F.lit("1995-06-30").cast("date"), ("norm",))


@query("asof_fallback_earliest", f"""{with_views('ver')},
n AS (SELECT norm, block, src FROM (SELECT *, {_RANK} AS k FROM ver WHERE {_F} <= DATE '1995-06-30') WHERE k = 1),
e AS (SELECT norm, block, src FROM (SELECT *, row_number() OVER (PARTITION BY norm, block ORDER BY {_F}, pub, src) k FROM ver) WHERE k = 1),
b AS (SELECT e.norm, e.block, coalesce(n.src, e.src) AS src, n.src IS NULL AS fb, count(n.src) OVER (PARTITION BY e.norm) = 0 AS bare
      FROM e LEFT JOIN n ON e.norm = n.norm AND e.block = n.block)
SELECT norm, block, src, bare FROM b WHERE bare OR NOT fb""")
def asof_fallback_earliest(spark, sf_dir):
    return t.fallback_document(views.versions(spark, sf_dir), F.lit("1995-06-30").cast("date"))


@query("asof_exact_override", f"""{with_views('ver')},
ev AS (SELECT DISTINCT norm, src, pub AS day FROM ver),
c AS (SELECT ev.norm, ev.src, ev.day, v.block, v.src AS v_src, v.pub, {_F} AS f,
        (v.src = ev.src AND (v.eff = ev.day OR v.pub = ev.day)) IS TRUE AS own
      FROM ev JOIN ver v ON ev.norm = v.norm WHERE coalesce(v.eff, v.pub) <= ev.day),
r AS (SELECT *, row_number() OVER (PARTITION BY norm, src, day, block ORDER BY own DESC, f DESC, pub DESC, v_src) k FROM c)
SELECT norm, src, CAST(day AS VARCHAR) AS day, block, v_src AS shown, own AS exact FROM r WHERE k = 1""")
def asof_exact_override(spark, sf_dir):
    v = views.versions(spark, sf_dir)
    events = v.select("norm", "src", F.col("pub").alias("day")).distinct()
    return t.exact_override(v, events).withColumn("day", iso("day"))


_HISTORY = f"""{with_views('ver')},
ev AS (SELECT norm, day, row_number() OVER (PARTITION BY norm ORDER BY day) AS seq FROM (SELECT DISTINCT norm, {_F} AS day FROM ver)),
sp AS (SELECT norm, block, txt, qty, {_F} AS starts, lead({_F}) OVER (PARTITION BY norm, block ORDER BY {_F}, pub, src DESC) AS ends FROM ver),
seen AS (SELECT ev.norm, ev.seq, ev.day, sp.block, sp.txt, sp.qty FROM ev JOIN sp ON ev.norm = sp.norm
       WHERE sp.starts <= ev.day AND (sp.ends IS NULL OR ev.day < sp.ends))"""


@query("document_history", f"""{_HISTORY}
SELECT norm, seq, CAST(day AS VARCHAR) AS day, count(*) AS n_blocks, md5(string_agg(block || ':' || txt || ':' || qty, chr(10) ORDER BY block)) AS content
FROM seen GROUP BY norm, seq, day""")
def document_history(spark, sf_dir):
    return t.history(views.versions(spark, sf_dir)).withColumn("day", iso("day"))


@query("last_updated", f"""{with_views('ver')}
SELECT norm, CAST(max({_F}) AS VARCHAR) AS last_updated, bool_or(eff IS NULL) AS undated,
       CASE WHEN bool_or(eff IS NULL) THEN NULL ELSE CAST(max({_F}) AS VARCHAR) END AS stated
FROM (SELECT *, {_RANK} AS k FROM ver WHERE {_F} <= DATE '{DAY}') WHERE k = 1 GROUP BY norm""")
def last_updated(spark, sf_dir):
    chosen = t.as_of(views.versions(spark, sf_dir), _day())
    newest, undated = iso(F.max(t.in_force())), F.bool_or(F.col("eff").isNull())
    return chosen.groupBy("norm").agg(newest.alias("last_updated"), undated.alias("undated"), F.when(~undated, newest).alias("stated"))


@query("last_amendment", f"""{with_views('ver')}
SELECT norm, src, block, last_value(CASE WHEN txt = 'R' THEN src END IGNORE NULLS) OVER
    (PARTITION BY norm ORDER BY src, block ROWS UNBOUNDED PRECEDING) AS last_amendment FROM ver""")
def last_amendment(spark, sf_dir):
    so_far = Window.partitionBy("norm").orderBy("src", "block").rowsBetween(Window.unboundedPreceding, 0)
    amending = F.last(F.when(F.col("txt") == "R", F.col("src")), ignorenulls=True).over(so_far)
    return views.versions(spark, sf_dir).select("norm", "src", "block", amending.alias("last_amendment"))


@query("commit_type", f"""{with_views('log')}
SELECT norm, id, CASE WHEN row_number() OVER (PARTITION BY norm ORDER BY day, id) = 1 THEN 'bootstrap'
  WHEN kind = 'purchase' THEN 'reform' WHEN kind = 'click' THEN 'correction' ELSE 'other' END AS commit_type FROM log""")
def commit_type(spark, sf_dir):
    first = F.row_number().over(Window.partitionBy("norm").orderBy("day", "id")) == 1
    kind = F.when(first, "bootstrap").when(F.col("kind") == "purchase", "reform").when(F.col("kind") == "click", "correction").otherwise("other")
    return views.log(spark, sf_dir).select("norm", "id", kind.alias("commit_type"))


@query("reform_timeline", f"""{with_views('ver')}
SELECT norm, CAST(pub AS VARCHAR) AS pub, src, string_agg(CAST(block AS VARCHAR), ',' ORDER BY block, src) AS blocks, count(*) AS n
FROM ver GROUP BY norm, pub, src""")
def reform_timeline(spark, sf_dir):
    return t.timeline(views.versions(spark, sf_dir), "pub", "src").withColumn("pub", iso("pub"))


@query("staged_timeline", f"""{with_views('ver')},
g AS (SELECT norm, pub, src, eff, string_agg(DISTINCT CAST(block AS VARCHAR), ',' ORDER BY CAST(block AS VARCHAR)) AS blocks, bool_or(superseded) AS noted
      FROM ver GROUP BY norm, pub, src, eff)
SELECT norm, CAST(pub AS VARCHAR) AS pub, src, CAST(eff AS VARCHAR) AS eff, blocks, noted,
  row_number() OVER (PARTITION BY norm ORDER BY greatest(pub, {_F}), pub, src, {_F}) AS seq FROM g""")
def staged_timeline(spark, sf_dir):
    return t.staged_timeline(views.versions(spark, sf_dir)).withColumns({"pub": iso("pub"), "eff": iso("eff")})


@query("timeline_excl_first", f"""{with_views('ver')},
d AS (SELECT norm, block, eff, min(eff) OVER (PARTITION BY norm) AS first FROM ver WHERE eff IS NOT NULL)
SELECT norm, CAST(eff AS VARCHAR) AS day, string_agg(CAST(block AS VARCHAR), ',' ORDER BY block) AS blocks FROM d WHERE eff > first GROUP BY norm, eff""")
def timeline_excl_first(spark, sf_dir):
    dated = views.versions(spark, sf_dir).where("eff IS NOT NULL")
    later = dated.withColumn("first", F.min("eff").over(Window.partitionBy("norm"))).where("eff > first")
    blocks = F.array_join(F.transform(F.array_sort(F.collect_list("block")), lambda x: x.cast("string")), ",")
    return later.groupBy("norm", "eff").agg(blocks.alias("blocks")).select("norm", iso("eff").alias("day"), "blocks")


@query("synthetic_bootstrap", f"""{with_views('norm', 'ver')},
e AS (SELECT norm, min(pub) AS first, count(*) AS n FROM ver WHERE eff IS NOT NULL AND txt = 'R' GROUP BY norm)
SELECT n.norm, coalesce(e.n, 1)::BIGINT AS events, e.norm IS NULL AS synthetic, CAST(coalesce(e.first, DATE '1995-01-01' + CAST(n.size AS INT)) AS VARCHAR) AS first
FROM norm n LEFT JOIN e ON n.norm = e.norm""")
def synthetic_bootstrap(spark, sf_dir):
    norm = views.norms(spark, sf_dir).select("norm", "size")
    events = views.versions(spark, sf_dir).where("eff IS NOT NULL AND txt = 'R'").groupBy("norm").agg(F.min("pub").alias("first"), F.count(F.lit(1)).alias("n"))
    made = F.date_add(F.lit("1995-01-01").cast("date"), F.col("size"))
    return norm.join(events, "norm", "left").select("norm", F.coalesce("n", F.lit(1)).cast("bigint").alias("events"), F.col("n").isNull().alias("synthetic"), iso(F.coalesce("first", made)).alias("first"))


@query("order_date", f"""{with_views('ver')}
SELECT norm, block, src, CAST(greatest(min(pub) OVER (PARTITION BY norm), {_F}) AS VARCHAR) AS order_date,
  CAST(greatest(DATE '{DAY}', {_F}) AS VARCHAR) AS render_date FROM ver""")
def order_date(spark, sf_dir):
    floor = F.min("pub").over(Window.partitionBy("norm"))
    return views.versions(spark, sf_dir).select("norm", "block", "src", iso(F.greatest(floor, t.in_force())).alias("order_date"), iso(F.greatest(_day(), t.in_force())).alias("render_date"))


@query("paragraph_expiry", f"""{with_views('ver')}
SELECT norm, count(*) FILTER (WHERE expiry IS NULL OR DATE '{DAY}' < expiry) AS kept, count(*) AS all_rows FROM ver GROUP BY norm""")
def paragraph_expiry(spark, sf_dir):
    rows = views.versions(spark, sf_dir).groupBy("norm").agg(F.collect_list(F.struct("block", "src", "expiry")).alias("paragraphs"))
    kept = F.filter("paragraphs", lambda p: p["expiry"].isNull() | (_day() < p["expiry"]))
    return rows.select("norm", F.size(kept).cast("bigint").alias("kept"), F.size("paragraphs").cast("bigint").alias("all_rows"))


@query("commencement_visibility", f"""{with_views('ver')},
c AS (SELECT *, max(greatest({_F}, pub)) OVER (PARTITION BY norm, src) AS reached FROM ver)
SELECT norm, src, count(*) FILTER (WHERE pub <= DATE '{DAY}' OR reached < DATE '{DAY}') AS visible, count(*) AS stages FROM c GROUP BY norm, src""")
def commencement_visibility(spark, sf_dir):
    reached = F.max(F.greatest(t.in_force(), "pub")).over(Window.partitionBy("norm", "src"))
    rows = views.versions(spark, sf_dir).withColumn("reached", reached)
    return rows.groupBy("norm", "src").agg(F.count_if((F.col("pub") <= _day()) | (F.col("reached") < _day())).alias("visible"), F.count(F.lit(1)).alias("stages"))


@query("status_at_event", f"""{with_views('ver')},
ev AS (SELECT DISTINCT norm, pub AS day FROM ver),
fx AS (SELECT norm, eff AS day, txt FROM ver WHERE eff IS NOT NULL AND txt IN ('R', 'A'))
SELECT ev.norm, CAST(ev.day AS VARCHAR) AS day, CASE WHEN coalesce(bool_or(fx.txt = 'R' AND fx.day <= ev.day), false) THEN 'repealed'
  WHEN coalesce(bool_or(fx.txt = 'A' AND fx.day <= ev.day), false) THEN 'partially_repealed' ELSE 'in_force' END AS status
FROM ev LEFT JOIN fx ON ev.norm = fx.norm GROUP BY ev.norm, ev.day""")
def status_at_event(spark, sf_dir):
    """Status folds to the first whole or partial repeal, so two dates a norm replace all its effects."""
    v = views.versions(spark, sf_dir)
    first = v.groupBy("norm").agg(F.min(F.when(F.col("txt") == "R", F.col("eff"))).alias("whole"), F.min(F.when(F.col("txt") == "A", F.col("eff"))).alias("part"))
    events = v.select("norm", F.col("pub").alias("day")).distinct()
    status = F.when(F.col("whole") <= F.col("day"), "repealed").when(F.col("part") <= F.col("day"), "partially_repealed").otherwise("in_force")
    return events.join(first, "norm").select("norm", iso("day").alias("day"), status.alias("status"))


@query("future_activation", f"""{with_views('ver')},
f AS (SELECT norm, min(eff) AS activates FROM ver WHERE txt = 'R' AND eff > DATE '{DAY}' AND pub <= DATE '{DAY}' GROUP BY norm),
s AS (SELECT norm, src FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY {_F} DESC, pub DESC, src) k FROM ver WHERE {_F} <= DATE '{DAY}') WHERE k = 1)
SELECT f.norm, CAST(f.activates AS VARCHAR) AS activates, s.src AS prior FROM f JOIN s ON f.norm = s.norm""")
def future_activation(spark, sf_dir):
    v = views.versions(spark, sf_dir)
    coming = v.where((F.col("txt") == "R") & (F.col("eff") > _day()) & (F.col("pub") <= _day())).groupBy("norm").agg(F.min("eff").alias("activates"))
    prior = t.as_of(v, _day(), ("norm",)).select("norm", F.col("src").alias("prior"))
    return coming.join(prior, "norm").select("norm", iso("activates").alias("activates"), "prior")


@query("repeal_in_effect", f"""{with_views('ver')},
o AS (SELECT norm, src, block, {_F} AS day, txt, lag(txt) OVER (PARTITION BY norm ORDER BY {_F}, src, block) AS before FROM ver)
SELECT norm, src, block, CAST(day AS VARCHAR) AS day FROM o WHERE txt = 'R' AND before IS DISTINCT FROM 'R'""")
def repeal_in_effect(spark, sf_dir):
    before = F.lag("txt").over(Window.partitionBy("norm").orderBy(t.in_force(), "src", "block"))
    rows = views.versions(spark, sf_dir).withColumn("before", before)
    return rows.where((F.col("txt") == "R") & ~F.col("before").eqNullSafe("R")).select("norm", "src", "block", iso(t.in_force()).alias("day"))


@query("promotion_keeps_last", f"""{with_views('ver')},
p AS (SELECT norm, src, block, count(*) FILTER (WHERE superseded) OVER (PARTITION BY norm) > 5 AS promoting,
        row_number() OVER (PARTITION BY norm ORDER BY pub DESC, src DESC, block DESC) AS back FROM ver)
SELECT norm, src, block, promoting FROM p WHERE NOT promoting OR back = 1""")
def promotion_keeps_last(spark, sf_dir):
    whole, back = Window.partitionBy("norm"), Window.partitionBy("norm").orderBy(F.desc("pub"), F.desc("src"), F.desc("block"))
    rows = views.versions(spark, sf_dir).select("norm", "src", "block", (F.count_if("superseded").over(whole) > 5).alias("promoting"), F.row_number().over(back).alias("back"))
    return rows.where("NOT promoting OR back = 1").drop("back")


@query("missing_versions", f"""{with_views('ver')},
w AS (SELECT norm, max(eff) AS written FROM ver WHERE txt = 'N' GROUP BY norm)
SELECT v.norm, v.block, v.src, CAST(v.eff AS VARCHAR) AS eff FROM ver v JOIN w ON v.norm = w.norm WHERE w.written < v.eff AND v.eff <= DATE '{views.FAR}'""")
def missing_versions(spark, sf_dir):
    newest = F.max(F.when(F.col("txt") == "N", F.col("eff"))).over(Window.partitionBy("norm"))
    rows = views.versions(spark, sf_dir).withColumn("written", newest)
    return rows.where((F.col("written") < F.col("eff")) & (F.col("eff") <= F.lit(views.FAR).cast("date"))).select("norm", "block", "src", iso("eff").alias("eff"))


@query("equal_cutoff_conflict", f"""{with_views('ver')}
SELECT norm, CAST({_F} AS VARCHAR) AS cutoff, count(*) AS rows_at, count(DISTINCT txt) AS bodies,
  CASE WHEN count(*) = 1 THEN 'single' WHEN count(DISTINCT txt) = 1 THEN 'same body' ELSE 'gap' END AS outcome
FROM ver GROUP BY norm, {_F}""")
def equal_cutoff_conflict(spark, sf_dir):
    grouped = views.versions(spark, sf_dir).groupBy("norm", t.in_force().alias("at")).agg(F.count(F.lit(1)).alias("rows_at"), F.count_distinct("txt").alias("bodies"))
    outcome = F.when(F.col("rows_at") == 1, "single").when(F.col("bodies") == 1, "same body").otherwise("gap")
    return grouped.select("norm", iso("at").alias("cutoff"), "rows_at", "bodies", outcome.alias("outcome"))


@query("pending_status", """SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'P' THEN 'pending' ELSE 'publishable' END AS route,
  CASE o_orderstatus WHEN 'F' THEN 'repealed' WHEN 'O' THEN 'in_force' END AS status FROM orders""")
def pending_status(spark, sf_dir):
    code = F.col("o_orderstatus")
    return views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(code == "P", "pending").otherwise("publishable").alias("route"), F.when(code == "F", "repealed").when(code == "O", "in_force").alias("status"))


@query("supersede_pattern", f"""{with_views('ver')},
w AS (SELECT norm, block, src, eff, pub, lag(eff) OVER c AS before, lead(eff) OVER c AS after, lead(pub) OVER c AS next_pub
      FROM ver WINDOW c AS (PARTITION BY norm, block ORDER BY pub, src))
SELECT norm, block, src FROM w WHERE eff IS NULL AND before IS NOT NULL AND after IS NOT NULL AND next_pub < pub + 400""")
def supersede_pattern(spark, sf_dir):
    chain = Window.partitionBy("norm", "block").orderBy("pub", "src")
    rows = views.versions(spark, sf_dir).withColumns({"before": F.lag("eff").over(chain), "after": F.lead("eff").over(chain), "next_pub": F.lead("pub").over(chain)})
    return rows.where("eff IS NULL AND before IS NOT NULL AND after IS NOT NULL AND next_pub < date_add(pub, 400)").select("norm", "block", "src")


@query("validity_intervals", f"""{with_views('ver')},
sp AS (SELECT norm, block, src, {_F} AS starts, lead({_F}) OVER (PARTITION BY norm, block ORDER BY {_F}, pub, src DESC) AS ends FROM ver)
SELECT norm, block, src, CAST(starts AS VARCHAR) AS starts, CAST(ends AS VARCHAR) AS ends FROM sp WHERE ends IS NULL OR ends > starts""")
def validity_intervals(spark, sf_dir):
    return t.intervals(views.versions(spark, sf_dir)).select("norm", "block", "src", iso("starts").alias("starts"), iso("ends").alias("ends"))
