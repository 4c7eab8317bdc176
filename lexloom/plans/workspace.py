"""Named queries that run the commands of a workspace over the documents of a source."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lexloom import views
from lexloom.plans.catalogue import query
from lexloom.plans.layouts import MARKS, documents
from lexloom.session import scratch
from lexloom.streaming import days
from lexloom.views import iso
from lexloom.workspace import Workspace

SOURCE = "fr"
_ID, _DAY, _NEXT = (MARKS[x][1] for x in ("id", "day", "next"))
#: The events that the sample tells for each part.
_EVENTS = f"""e AS (SELECT {_ID} AS norm, src, CAST(day AS DATE) AS day FROM (
  SELECT *, 'S' || p_partkey AS src, {_DAY} AS day FROM part UNION ALL SELECT *, 'A1', {_DAY} FROM part UNION ALL SELECT *, 'A2', {_DAY} FROM part
  UNION ALL SELECT *, 'JORF' || p_partkey, {_NEXT} FROM part UNION ALL SELECT *, 'A2', {_NEXT} FROM part))"""
_LOG = f"""{_EVENTS}, log AS (SELECT row_number() OVER (ORDER BY day, norm, src) AS n, norm, src, day, CASE WHEN row_number() OVER (PARTITION BY norm ORDER BY day, src) = 1 THEN 'bootstrap' ELSE 'reform' END AS kind FROM e)"""


def _workspace(spark, label: str, **how) -> Workspace:
    return Workspace(spark, scratch(spark, label), SOURCE, **how)


@query("command_bootstrap", f"WITH {_LOG} SELECT n, norm, src, CAST(day AS VARCHAR) AS day, kind, (n - 1) // 700 AS chunk FROM log")
def command_bootstrap(spark, sf_dir):
    """Fetch everything and write the log, in chunks of 700 events."""
    work = _workspace(spark, "bootstrap", chunk_events=700)
    work.bootstrap(documents(spark, sf_dir, SOURCE), "2024-01-01")
    return work.events().select("n", "norm", "src", iso("day").alias("day"), "kind", "chunk")


@query("command_commit_again", f"WITH {_EVENTS} SELECT norm, src, CAST(day AS VARCHAR) AS day, count(*) AS n FROM e GROUP BY ALL")
def command_commit_again(spark, sf_dir):
    """Half of the documents, committed up to a day; then the rest; then nothing new: each event is there once."""
    work, docs = _workspace(spark, "again", chunk_events=900), documents(spark, sf_dir, SOURCE)
    work.fetch(docs.where("CAST(norm AS BIGINT) % 2 = 0"), "2024-01-01")
    work.commit(until="1991-12-31")
    work.bootstrap(docs, "2024-01-02")
    if not work.commit().isEmpty() or not work.commit(dry_run=True).isEmpty():
        raise AssertionError("a commit without new documents wrote events")
    return work.events().groupBy("norm", "src", iso("day").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("command_fetch", f"SELECT {_ID} AS norm FROM part WHERE p_partkey % 3 <> 0 ORDER BY norm LIMIT 500 OFFSET 20")
def command_fetch(spark, sf_dir):
    """A slice of the keys; a failed document goes to the ledger and is left out."""
    work = _workspace(spark, "fetch")
    work.fetch(documents(spark, sf_dir, SOURCE).where("CAST(norm AS BIGINT) % 3 <> 0"), "2024-01-01", offset=20, limit=500)
    return work.documents().select("norm")


@query("command_failures", f"SELECT {_ID} AS key, CASE WHEN p_partkey % 10 = 1 THEN 'gone' ELSE 'timeout' END AS reason, p_partkey % 10 <> 1 AS transient FROM part WHERE p_partkey % 5 = 1 AND p_partkey % 4 <> 0")
def command_failures(spark, sf_dir):
    """A run in which a fifth fails; the next one settles a quarter of all, and clears its entries."""
    work, docs = _workspace(spark, "failures"), documents(spark, sf_dir, SOURCE)
    key = F.col("norm").cast("long")
    failed = docs.withColumn("content", F.when(key % 5 != 1, F.col("content"))).withColumn("reason", F.when(key % 10 == 1, "gone").otherwise("timeout")).withColumn("status", F.when(key % 10 == 1, 404))
    work.fetch(failed, "2024-01-01")
    work.fetch(docs.where(key % 4 == 0), "2024-01-02")
    return work.failures.current().select("key", "reason", "transient")


@query("command_reprocess", f"WITH {_EVENTS} SELECT norm, src, CAST(day AS VARCHAR) AS day, norm IN ('3', '5', '8') AND src LIKE 'JORF%' AS rewritten FROM e")
def command_reprocess(spark, sf_dir):
    """Three documents change under the log; reprocessing writes their changed events anew and no other."""
    work, docs = _workspace(spark, "reprocess", chunk_events=600), documents(spark, sf_dir, SOURCE)
    work.bootstrap(docs, "2024-01-01")
    before = work.events().agg(F.max("n")).first()[0]
    changed = docs.where("norm IN ('3', '5', '8')").withColumn("content", F.encode(F.replace(F.decode("content", "UTF-8"), F.lit(" as changed by "), F.lit(" as corrected by ")), "UTF-8"))
    work.fetch(changed, "2024-01-02", force=True)
    work.reprocess(["3", "5", "8"])
    return work.events().select("norm", "src", iso("day").alias("day"), (F.col("n") > before).alias("rewritten"))


@query("command_reforms_diff", f"SELECT src, CAST(CAST(day AS DATE) AS VARCHAR) AS day, unit, before, after FROM (SELECT 'A1' AS src, {_DAY} AS day, 'C1' AS unit, CAST(NULL AS VARCHAR) AS before, {MARKS['one'][1]} AS after, p_partkey FROM part UNION ALL SELECT 'JORF' || p_partkey, {_NEXT}, 'C1', {MARKS['one'][1]}, {MARKS['later'][1]}, p_partkey FROM part UNION ALL SELECT 'A2', {_DAY}, 'C2', NULL, {MARKS['two'][1]}, p_partkey FROM part UNION ALL SELECT 'A2', {_NEXT}, 'C2', {MARKS['two'][1]}, '', p_partkey FROM part UNION ALL SELECT 'S' || p_partkey, {_DAY}, 'S' || p_partkey, NULL, '', p_partkey FROM part) WHERE p_partkey = 42")
def command_reforms_diff(spark, sf_dir):
    """The events of one norm with the texts that they take and bring."""
    work = _workspace(spark, "reforms")
    work.bootstrap(documents(spark, sf_dir, SOURCE), "2024-01-01")
    return work.reforms("42", diff=True).select("src", iso("day").alias("day"), "unit", "before", "after")


@query("command_status", f"WITH {_EVENTS} SELECT 'documents' AS stage, count(*) AS n FROM part UNION ALL SELECT 'units', count(*) FROM part UNION ALL SELECT 'files', count(*) FROM part UNION ALL SELECT 'events', count(*) FROM e")
def command_status(spark, sf_dir):
    work = _workspace(spark, "status")
    work.bootstrap(documents(spark, sf_dir, SOURCE), "2024-01-01")
    return work.status()


@query("command_push", f"WITH {_LOG} SELECT n FROM log WHERE n > 900 AND (n % 450 = 0 OR n = (SELECT max(n) FROM log))")
def command_push(spark, sf_dir):
    """Where the log is pushed, when two slices are published already."""
    work = _workspace(spark, "push", slice_events=450)
    work.bootstrap(documents(spark, sf_dir, SOURCE), "2024-01-01")
    return work.push(published=900)


@query("command_health", f"""WITH k AS (SELECT {_ID} AS key, p_partkey AS p FROM part),
l AS (SELECT 'ERROR' AS severity, 'excluded for a failure that may pass' AS finding, key FROM k WHERE p % 5 = 1 AND p % 10 <> 1 AND p % 3 <> 0 UNION ALL SELECT 'WARN', 'excluded without a reason', 'new-' || key FROM k WHERE p % 50 = 0)
SELECT severity, finding, count(*) AS n, array_to_string(list_sort(list(key))[1:5], ', ') AS examples FROM l GROUP BY severity, finding""")
def command_health(spark, sf_dir):
    """A workspace with failures, exclusions and keys that were never fetched."""
    work, docs = _workspace(spark, "health"), documents(spark, sf_dir, SOURCE)
    key = F.col("norm").cast("long")
    work.fetch(docs.withColumn("content", F.when(key % 5 != 1, F.col("content"))).withColumn("status", F.when(key % 10 == 1, 404)), "2024-01-01")
    work.commit()
    discovered = docs.select(F.col("norm").alias("key")).unionAll(docs.where(key % 50 == 0).select(F.concat(F.lit("new-"), "norm").alias("key")))
    excluded = docs.where((key % 5 == 1) & (key % 3 == 0)).select(F.col("norm").alias("key"), F.lit("out of scope").alias("reason"))
    return work.health(discovered, excluded, "2024-01-10", deep=True)


@query("command_rewrite", f"WITH {_LOG} SELECT n, CASE kind WHEN 'reform' THEN '[change]' ELSE '[bootstrap]' END AS head FROM log")
def command_rewrite(spark, sf_dir):
    """The wording of every message is changed in place; numbers and order stay."""
    work = _workspace(spark, "rewrite", chunk_events=1000)
    work.bootstrap(documents(spark, sf_dir, SOURCE), "2024-01-01")
    work.rewrite_messages(lambda subject: F.regexp_replace(subject, r"^\[reform\]", "[change]"))
    return work.events().select("n", F.regexp_extract("subject", r"^(\[\w+\])", 1).alias("head"))


@query("command_revised", f"""WITH {_EVENTS} SELECT norm, src, CAST(day AS VARCHAR) AS day FROM e UNION ALL SELECT norm, 'revised-' || src, CAST(day AS VARCHAR) FROM e WHERE CAST(norm AS BIGINT) % 5 = 0""")
def command_revised(spark, sf_dir):
    """A second source for a fifth of the norms, and for some that are not here; a second pass adds nothing."""
    work, docs = _workspace(spark, "revised"), documents(spark, sf_dir, SOURCE)
    work.bootstrap(docs, "2024-01-01")
    second = docs.where("CAST(norm AS BIGINT) % 5 = 0").unionAll(docs.where("CAST(norm AS BIGINT) < 9").withColumn("norm", F.concat(F.lit("x"), "norm")))
    work.revised(second, SOURCE)
    if work.revised(second, SOURCE):
        raise AssertionError("a second pass wrote events")
    return work.events().select("norm", "src", iso("day").alias("day"))


@query("command_meta", "SELECT 'first' AS run, 'README.md' AS name UNION ALL SELECT 'first', 'coverage.json' UNION ALL SELECT 'first', 'manifest.json' UNION ALL SELECT 'third', 'README.md' UNION ALL SELECT 'third', 'coverage.json'")
def command_meta(spark, sf_dir):
    """What is written about a workspace: everything at first, nothing while nothing changes, then what did."""
    work, docs = _workspace(spark, "meta"), documents(spark, sf_dir, SOURCE)
    known = docs.select(F.col("norm").alias("key"))
    none = spark.createDataFrame([], "key string, reason string")
    work.bootstrap(docs.where("CAST(norm AS BIGINT) % 2 = 0"), "2024-01-01")
    written = [("first", work.meta(known, none, "2024-01-01")), ("second", work.meta(known, none, "2024-01-02"))]
    work.bootstrap(docs, "2024-01-03")
    written.append(("third", work.meta(known, none, "2024-01-03")))
    return spark.createDataFrame([(run, name) for run, names in written for name in names], "run string, name string")


_FED = "f AS (SELECT user_id AS key, event_id AS id, CAST(ts AS DATE) AS day, event_type AS kind FROM events)"


@query("daily_run", f"""WITH {_FED}, d AS (SELECT * FROM f WHERE day >= DATE '2024-01-11' AND day <= DATE '2024-01-21' AND isodow(day) <> 7)
SELECT CAST(day AS VARCHAR) AS day, count(DISTINCT (key, kind)) AS published, '2024-01-08 2024-01-10' AS dropped, '2024-01-20' AS cursor FROM d GROUP BY day""")
def daily_run(spark, sf_dir):
    """Runs of two days over a feed: from the cursor, ten days back at most, with what that drops; each key of a day once.

    The first run dies on the last of its days; the second takes that day again, and what had been
    published is known.
    """
    feed = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.to_date("ts").alias("day"), F.col("event_type").alias("kind"))
    path, state_path = scratch(spark, "daily-log"), scratch(spark, "daily-state")
    schema = "key long, day date, kind string"
    spark.createDataFrame([], schema).write.parquet(path)

    def process(day, pending, dies=None):
        new = feed.where(F.col("day") == F.lit(day)).distinct()
        known = spark.read.schema(schema).parquet(path).where(F.col("day") == F.lit(day))
        rows = new.join(known, ["key", "day", "kind"], "left_anti")
        if day == dies:
            rows.where("key % 2 = 0").write.mode("append").parquet(path)
            raise OSError("the source went away")
        n = rows.count()
        rows.write.mode("append").parquet(path)
        return n, {}, set()

    state = days.State(state_path, cursor=date(2024, 1, 7))
    first = days.run(spark, state, date(2024, 1, 20), lambda d, p: process(d, p, date(2024, 1, 20)), skip={6}, lookback=9)
    state = days.State.load(spark, state_path)
    second = days.run(spark, state, date(2024, 1, 21), process, skip={6}, lookback=9)
    if not first.errors or second.errors or first.dropped is None:
        raise AssertionError((first, second))
    counts = spark.read.schema(schema).parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("published"))
    return counts.select(iso("day").alias("day"), "published", F.lit(f"{first.dropped[0]} {first.dropped[1]}").alias("dropped"), F.lit(str(days.State.load(spark, state_path).cursor)).alias("cursor"))
