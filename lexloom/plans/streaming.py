"""Named queries that run streams to their end; each must give what a batch over the same events gives."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.plans.catalogue import query
from lexloom.plans.order import numbered
from lexloom.session import importable, scratch
from lexloom.streaming import daily
from lexloom.views import iso, with_views


def _feed(spark, sf_dir):
    """The change log, a feed file for each ten days, as a stream."""
    importable(spark)
    log = views.log(spark, sf_dir).select("norm", "id", "day", "kind", "value")
    rows = log.withColumn("feed_day", F.expr("day(day) div 10"))
    path = daily.by_day(rows, "feed")
    schema = spark.read.parquet(path).schema
    return daily.feed(spark, path, schema)


@query("stream_daily", f"""{with_views('log')} SELECT CAST(day AS VARCHAR) AS day, kind, count(*) AS n, round(sum(value), 4) AS total FROM log GROUP BY day, kind""")
def stream_daily(spark, sf_dir):
    """Per-day aggregates of a stream: partial sums a micro-batch, added when read."""
    path = scratch(spark, "daily")

    def write(batch, batch_id):
        batch.groupBy("day", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(path)

    daily.run(_feed(spark, sf_dir), write, scratch(spark, "checkpoint"))
    parts = spark.read.parquet(path).dropDuplicates(["batch", "day", "kind"])
    return parts.groupBy("day", "kind").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total")).withColumn("day", iso("day"))


@query("stream_dedup", f"""{with_views('log')} SELECT DISTINCT norm, kind, CAST(day AS VARCHAR) AS day FROM log""")
def stream_dedup(spark, sf_dir):
    """Each key once, with state bounded by a watermark of ten days."""
    stream = _feed(spark, sf_dir).withColumn("at", F.col("day").cast("timestamp")).withWatermark("at", "40 days")
    path = scratch(spark, "dedup")
    unique = stream.dropDuplicatesWithinWatermark(["norm", "kind", "day"])
    daily.run(unique, lambda batch, _: batch.select("norm", "kind", iso("day").alias("day")).write.mode("append").parquet(path), scratch(spark, "checkpoint"))
    return spark.read.parquet(path)


@query("stream_idempotent_sink", f"""{with_views('log')} SELECT count(DISTINCT (norm, kind, day)) AS keys, 0::BIGINT AS second_run FROM log""")
def stream_idempotent_sink(spark, sf_dir):
    """The same feed twice: the second run, from its beginning, adds no row."""
    schema = views.log(spark, sf_dir).select("norm", "kind", "day").schema
    sink = daily.Sink(spark, schema, ["norm", "kind", "day"], "sink", "day")
    stream = _feed(spark, sf_dir)
    daily.run(stream, sink.write, scratch(spark, "checkpoint"))
    first = sink.read().count()
    daily.run(stream, sink.write, scratch(spark, "checkpoint"))
    return sink.read().agg(F.count(F.lit(1)).alias("keys"), (F.count(F.lit(1)) - first).alias("second_run"))


@query("stream_late", f"""{with_views('log')} SELECT norm, id, CAST(day AS VARCHAR) AS day, id % 6 = 0 AS late FROM log WHERE NOT (id % 6 = 0 AND day < DATE '2024-01-21')""")
def stream_late(spark, sf_dir):
    """Events indexed after their day count for their own day if that is within the lookback, and are dropped beyond it."""
    path = scratch(spark, "late")

    def write(batch, _):
        arrived = F.when(F.col("id") % 6 == 0, F.lit("2024-01-31").cast("date")).otherwise(F.col("day"))
        rows = batch.withColumn("arrived", arrived)
        kept = rows.where(F.col("day") >= F.date_sub("arrived", 10))
        kept.select("norm", "id", iso("day").alias("day"), (F.col("arrived") > F.col("day")).alias("late")).write.mode("append").parquet(path)

    daily.run(_feed(spark, sf_dir), write, scratch(spark, "checkpoint"))
    return spark.read.parquet(path)


@query("stream_pending", f"""{with_views('log')},
s AS (SELECT norm, id, kind, day, max(CASE WHEN kind = 'purchase' THEN id END) OVER (PARTITION BY norm) AS cleared FROM log)
SELECT norm, count(*) FILTER (WHERE kind = 'error' AND id > coalesce(cleared, -1)) AS failures, CAST(max(day) AS VARCHAR) AS last_day, count(*) FILTER (WHERE kind = 'error' AND id > coalesce(cleared, -1)) > 0 AS pending FROM s GROUP BY norm""")
def stream_pending(spark, sf_dir):
    """Failures since the last success, in keyed state over micro-batches that come in order of their days."""
    path = scratch(spark, "pending")
    stream = _feed(spark, sf_dir).select("norm", "id", "kind", iso("day").alias("day"))
    daily.run(daily.pending(stream), partial(daily.upsert, path), scratch(spark, "checkpoint"), "update")
    newest = Window.partitionBy("norm").orderBy(F.desc("batch"))
    return spark.read.parquet(path).withColumn("k", F.row_number().over(newest)).where("k = 1").select("norm", "failures", "last_day", "pending")


@query("stream_windows", """SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_windows(spark, sf_dir):
    """Tumbling windows in complete mode; the state holds a row per window and kind."""
    events = views.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.expr("day(ts) div 10").alias("feed_day"), F.to_date("ts").alias("day"))
    path = daily.by_day(events, "windows")
    stream = daily.feed(spark, path, spark.read.parquet(path).schema)
    out = scratch(spark, "windows-out")
    counts = stream.groupBy(F.window("ts", "6 hours").alias("w"), F.col("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    daily.run(counts, lambda batch, _: batch.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "kind", "n").write.mode("overwrite").parquet(out), scratch(spark, "checkpoint"), "complete")
    return spark.read.parquet(out)


@query("resume_after_crash", f"""{with_views('log')}, n AS (SELECT id, row_number() OVER (ORDER BY day, id) AS n FROM log) SELECT (n - 1) // 1000 AS chunk, count(*) AS n_events, min(id) AS least_id FROM n GROUP BY 1""")
def resume_after_crash(spark, sf_dir):
    """A run that stops half-way and is started again writes every chunk once."""
    rows = numbered(views.log(spark, sf_dir).select("id", "day"), "day", "id").withColumn("chunk", F.expr("(n - 1) div 1000"))
    path = scratch(spark, "resume")
    rows.where("chunk < 4").select("id", "chunk").write.parquet(path)  # what the first run got done
    done = spark.read.parquet(path).select("chunk").distinct()
    rows.select("id", "chunk").join(done, "chunk", "left_anti").select("id", "chunk").write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("chunk").agg(F.count(F.lit(1)).alias("n_events"), F.min("id").alias("least_id"))


@query("cursor_advance", f"""{with_views('log')},
d AS (SELECT day, bool_or(value > 190) AS failed FROM log WHERE day <= DATE '2024-01-25' GROUP BY day)
SELECT CAST(max(day) AS VARCHAR) AS cursor, CAST(coalesce((SELECT min(day) FROM d WHERE failed), DATE '2024-01-26') AS VARCHAR) AS next_day FROM d WHERE day < coalesce((SELECT min(day) FROM d WHERE failed), DATE '9999-01-01')""")
def cursor_advance(spark, sf_dir):
    """The cursor moves over days without a failure and never past the first that has one; future days do not count."""
    days = views.log(spark, sf_dir).where("day <= DATE '2024-01-25'").groupBy("day").agg(F.bool_or(F.col("value") > 190).alias("failed"))
    ends = days.agg(F.min(F.when(F.col("failed"), F.col("day"))).alias("first"), F.array_sort(F.collect_list("day")).alias("days"))  # a row for each day of the run
    good = F.filter("days", lambda d: F.col("first").isNull() | (d < F.col("first")))
    return ends.select(iso(F.array_max(good)).alias("cursor"), iso(F.coalesce("first", F.lit("2024-01-26").cast("date"))).alias("next_day"))


@query("log_freshness", f"""{with_views('log')}, n AS (SELECT day, id, kind FROM log ORDER BY id DESC LIMIT 500) SELECT CAST(max(day) AS VARCHAR) AS newest, count(*) AS looked_at FROM n WHERE kind <> 'view' AND day <= DATE '2024-01-30'""")
def log_freshness(spark, sf_dir):
    """The newest day among the last 500 entries of the log, stamped and future ones left out."""
    last = views.log(spark, sf_dir).select("day", "id", "kind").orderBy(F.desc("id")).limit(500)
    return last.where("kind <> 'view' AND day <= DATE '2024-01-30'").agg(iso(F.max("day")).alias("newest"), F.count(F.lit(1)).alias("looked_at"))
