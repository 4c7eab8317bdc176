"""Named queries on sources, sinks and scope filters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.plans.catalogue import query
from lexloom.session import importable, materialise, scratch
from lexloom.sources import archives, catalogue, http, registry, sinks
from lexloom.views import iso, with_views


@query("paged_source", "SELECT i AS id, 'norm-' || i AS name, '2024-01-' || lpad(CAST(i % 28 + 1 AS VARCHAR), 2, '0') AS day FROM range(1, 5001) t(i)")
def paged_source(spark, sf_dir):
    """All pages of a catalogue, a task for each run of pages."""
    catalogue.register(spark)
    return spark.read.format("catalogue").option("total", 5000).option("pagesize", 100).load()


@query("keyset_pages", "SELECT i AS id, 'norm-' || i AS name FROM range(4201, 5001) t(i)")
def keyset_pages(spark, sf_dir):
    """Rows after a key: the bound reaches the source, which leaves the pages before it out."""
    catalogue.register(spark)
    return spark.read.format("catalogue").option("total", 5000).option("pagesize", 100).load().where("id > 4200").select("id", "name")


@query("catalogue_stream", "SELECT '2024-01-' || lpad(CAST(i % 28 + 1 AS VARCHAR), 2, '0') AS day, count(*) AS n FROM range(1, 1001) t(i) GROUP BY 1")
def catalogue_stream(spark, sf_dir):
    catalogue.register(spark)
    path = scratch(spark, "catalogue")
    stream = spark.readStream.format("catalogue").option("total", 1000).option("pagesize", 250).load()
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch(spark, "checkpoint")).start()
    try:
        writer.processAllAvailable()
    finally:
        writer.stop()
    return spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("composite_cursor", f"""{with_views('log')} SELECT norm, id FROM log WHERE norm > 70 OR (norm = 70 AND id > 3000) ORDER BY norm, id LIMIT 200""")
def composite_cursor(spark, sf_dir):
    """The page after a pair of keys."""
    after = F.struct(F.col("norm"), F.col("id")) > F.struct(F.lit(70).cast("bigint"), F.lit(3000).cast("bigint"))
    return views.log(spark, sf_dir).select("norm", "id").where("norm >= 70").where(after).orderBy("norm", "id").limit(200)


@query("shifting_pages", f"""{with_views('log')} SELECT norm, count(*) AS seen FROM (SELECT DISTINCT norm, kind FROM log) GROUP BY norm""")
def shifting_pages(spark, sf_dir):
    """Pages whose order shifts between requests repeat keys; each counts once."""
    log = views.log(spark, sf_dir).select("norm", "kind")
    return log.unionAll(log).dropDuplicates(["norm", "kind"]).groupBy("norm").agg(F.count(F.lit(1)).alias("seen"))


@query("probe_sequence", """WITH h AS (SELECT DISTINCT p_partkey AS n FROM part WHERE p_size < 45), s AS (SELECT i AS n, h.n IS NULL AS miss FROM range(1, (SELECT max(p_partkey) + 5 FROM part)) t(i) LEFT JOIN h ON h.n = i),
g AS (SELECT n, miss, n - sum(CAST(miss AS INT)) OVER (ORDER BY n ROWS UNBOUNDED PRECEDING) AS island FROM s), r AS (SELECT n, miss, row_number() OVER (PARTITION BY island, miss ORDER BY n) AS run FROM g)
SELECT count(*) AS hits FROM r WHERE NOT miss AND n < coalesce((SELECT min(n) FROM r WHERE miss AND run >= 3), 1e9)""")
def probe_sequence(spark, sf_dir):
    """Numbers tried in order until three in a row are missing: a run of misses is one number whose next two are missing too.

    Gaps between neighbouring hits tell the same, so only hits are sorted, in ranges.
    """
    hits = views.table(spark, sf_dir, "part").where("p_size < 45 AND p_partkey >= 1").select(F.col("p_partkey").alias("n")).distinct()
    first = hits.agg(F.min("n").alias("least"))
    nexts = hits.select((F.col("n") - 1).alias("n")).union(hits.select((F.col("n") - 2).alias("n"))).union(hits.select((F.col("n") - 3).alias("n"))).distinct().withColumn("more", F.lit(True))
    ends = hits.join(nexts, "n", "left").where("more IS NULL").agg(F.min("n").alias("last"))
    bounded = hits.join(F.broadcast(ends), F.lit(True)).join(F.broadcast(first), F.lit(True))
    return bounded.agg(F.count_if((F.col("n") <= F.col("last")) & (F.col("least") <= 3)).alias("hits"))


@query("year_type_walk", """SELECT r_name AS type, y AS year, count(o_orderkey) AS n FROM region CROSS JOIN range(1995, 2002) t(y) LEFT JOIN orders ON year(CAST(o_orderdate AS DATE)) = y AND o_custkey % 5 = r_regionkey GROUP BY ALL""")
def year_type_walk(spark, sf_dir):
    """A listing per type and year, empty ones too: counts by key, joined to the small calendar of pages."""
    pages = views.table(spark, sf_dir, "region").select(F.col("r_name").alias("type"), F.col("r_regionkey").cast("bigint").alias("k"), F.explode(F.sequence(F.lit(1995).cast("bigint"), F.lit(2001).cast("bigint"))).alias("year"))
    counts = views.table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 5).alias("k"), F.year("o_orderdate").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return pages.join(counts, ["k", "year"], "left").select("type", "year", F.coalesce("n", F.lit(0)).alias("n"))


@query("sitemap_locations", r"""WITH s AS (SELECT '<urlset>' || string_agg('<url><loc>' || url || '</loc></url>', '' ORDER BY page_id) || '</urlset>' AS x FROM pages GROUP BY page_id // 100)
SELECT DISTINCT regexp_extract(u, '^https?://([^/?#]+)', 1) AS host, u AS loc FROM (SELECT unnest(regexp_extract_all(x, '<loc>([^<]*)</loc>', 1)) AS u FROM s) WHERE u LIKE '%/en/%'""")
def sitemap_locations(spark, sf_dir):
    """Locations of sitemaps in scope, once each."""
    pages = views.table(spark, sf_dir, "pages").select("page_id", "url")
    entries = F.transform(F.array_sort(F.collect_list(F.struct("page_id", "url"))), lambda x: F.concat(F.lit("<url><loc>"), x["url"], F.lit("</loc></url>")))
    maps = pages.groupBy(F.expr("page_id div 100").alias("child")).agg(F.concat(F.lit("<urlset>"), F.array_join(entries, ""), F.lit("</urlset>")).alias("x"))
    locs = maps.select(F.explode(F.regexp_extract_all("x", F.lit("<loc>([^<]*)</loc>"), 1)).alias("loc")).where(F.contains("loc", F.lit("/en/"))).distinct()
    return locs.select(F.regexp_extract("loc", "^https?://([^/?#]+)", 1).alias("host"), "loc")


@query("calendar_walk", f"""{with_views('log')}, c AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY))::DATE AS day) SELECT CAST(c.day AS VARCHAR) AS day, count(l.id) AS n FROM c LEFT JOIN log l ON c.day = l.day GROUP BY 1""")
def calendar_walk(spark, sf_dir):
    days = spark.range(1).select(F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"))).alias("day"))
    counts = views.log(spark, sf_dir).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "day", "left").select(iso("day").alias("day"), F.coalesce("n", F.lit(0)).alias("n"))


@query("newest_first_log", f"""{with_views('log')} SELECT norm, CAST(max(day) AS VARCHAR) AS day FROM log WHERE day >= DATE '2024-01-20' GROUP BY norm""")
def newest_first_log(spark, sf_dir):
    return views.log(spark, sf_dir).where("day >= DATE '2024-01-20'").groupBy("norm").agg(iso(F.max("day")).alias("day"))


@query("part_completeness", """SELECT l_orderkey AS id, count(*) AS parts, max(l_linenumber) AS expected, count(DISTINCT l_linenumber) = max(l_linenumber) AS complete FROM lineitem GROUP BY 1""")
def part_completeness(spark, sf_dir):
    """A document whose parts are not all there fails as a whole."""
    numbers = F.size(F.collect_set("l_linenumber"))
    return views.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count(F.lit(1)).alias("parts"), F.max("l_linenumber").alias("expected"), (numbers == F.max("l_linenumber")).alias("complete"))


def _zip(rows: pd.DataFrame) -> pd.DataFrame:
    files = {f"{r.doc_id}.txt": r.text.encode() for r in rows.sort_values("doc_id").itertuples()}
    return pd.DataFrame({"name": [f"{rows['lang'].iloc[0]}-{rows['part'].iloc[0]}.zip"], "content": [archives.zipped(files)]})


@query("archive_members", """SELECT lang || '-' || (doc_id // 200) || '.zip' AS archive, doc_id || '.txt' AS name, md5(text) AS digest FROM documents""")
def archive_members(spark, sf_dir):
    """Documents packed into ZIP archives of 200 at most, written, and read back as members."""
    importable(spark)
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang", "text", F.expr("doc_id div 200").alias("part"))
    packed = materialise(docs.groupBy("lang", "part").applyInPandas(_zip, "name string, content binary"), "archives")
    packed.createOrReplaceTempView("lexloom_archives")
    spark.udtf.register("archive_members", archives.Members)
    return spark.sql("SELECT a.name AS archive, m.name AS name, md5(m.content) AS digest FROM lexloom_archives a, LATERAL archive_members(a.content) m")


@query("increment_overlay", """SELECT doc_id, md5(CASE WHEN doc_id % 9 = 0 THEN text || ' amended' ELSE text END) AS digest, doc_id % 9 = 0 AS touched FROM documents""")
def increment_overlay(spark, sf_dir):
    """A later increment over a dump: its rows win, and tell which keys it touched."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    dump = docs.select("doc_id", F.md5("text").alias("digest"), F.lit(0).alias("layer"))
    increment = docs.where("doc_id % 9 = 0").select("doc_id", F.md5(F.concat("text", F.lit(" amended"))).alias("digest"), F.lit(1).alias("layer"))
    return dump.unionByName(increment).groupBy("doc_id").agg(F.max_by("digest", "layer").alias("digest"), (F.max("layer") == 1).alias("touched"))


@query("csv_repair", """SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM part""")
def csv_repair(spark, sf_dir):
    """A semicolon CSV with a byte-order mark and quoted headers, read back with clean names."""
    path = scratch(spark, "csv")
    lines = views.table(spark, sf_dir, "part").select(F.concat_ws(";", "p_partkey", F.concat(F.lit('"'), F.replace("p_name", F.lit('"'), F.lit('""')), F.lit('"')), F.col("p_retailprice").cast("string")).alias("value"))
    lines.select(F.concat(F.lit("﻿\"Id\";\"Nombre \";\"Precio\"\n"), F.lit("")).alias("value")).limit(1).write.text(path + "-head")
    lines.write.text(path)
    head = spark.read.text(path + "-head").where("value <> ''").select(F.split(F.regexp_replace("value", "[﻿\"]", ""), ";").alias("names")).first()["names"]
    names = [x.strip().lower() for x in head]
    rows = spark.read.option("sep", ";").option("quote", '"').option("escape", '"').schema("a bigint, b string, c double").csv(path).toDF(*names)
    return rows.select(F.col("id"), F.col("nombre").alias("name"), F.col("precio").alias("price"))


@query("structured_json", f"""{with_views('ver')} SELECT norm, block, src, CAST(pub AS VARCHAR) AS pub, CAST(eff AS VARCHAR) AS eff, txt FROM ver""")
def structured_json(spark, sf_dir):
    """Nested documents written as JSON and scanned back into rows."""
    path = scratch(spark, "json")
    sinks.structured(views.norms(spark, sf_dir), views.versions(spark, sf_dir)).select(F.col("json").alias("value")).write.option("compression", "gzip").text(path)
    return sinks.read_structured(spark.read.text(path))


@query("guarded_write", """WITH n AS (SELECT doc_id AS key, md5(text) AS content, n_chars % 7 AS day FROM documents), c AS (SELECT doc_id AS key, md5(CASE WHEN doc_id % 3 = 0 THEN text || '.' ELSE text END) AS content, CASE WHEN doc_id % 6 = 0 THEN 8 ELSE n_chars % 7 END AS day FROM documents WHERE lang <> 'de')
SELECT n.key, CASE WHEN c.content IS NULL THEN 'write' WHEN c.content = n.content THEN 'unchanged' WHEN c.day <> n.day AND n.key % 4 <> 0 THEN 'refused' ELSE 'write' END AS outcome FROM n LEFT JOIN c ON n.key = c.key""")
def guarded_write(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text", "lang", (F.col("n_chars") % 7).alias("day"))
    new = docs.select("key", F.md5("text").alias("content"), "day")
    held = docs.where("lang <> 'de'").select("key", F.md5(F.when(F.col("key") % 3 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text"))).alias("content"), F.when(F.col("key") % 6 == 0, 8).otherwise(F.col("day")).alias("day"))
    return sinks.guarded(new, held, "key", "content", "day", F.col("key") % 4 == 0).select("key", "outcome")


@query("report_day_kept", """SELECT n_nationkey AS id, CASE WHEN n_regionkey % 2 = 0 THEN '2024-01-01' ELSE '2024-02-01' END AS as_of FROM nation""")
def report_day_kept(spark, sf_dir):
    old, new = F.col("n_regionkey"), F.when(F.col("n_regionkey") % 2 == 0, F.col("n_regionkey")).otherwise(F.col("n_regionkey") + 1)
    return views.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), sinks.keeping_day(new, old, F.lit("2024-02-01"), F.lit("2024-01-01")).alias("as_of"))


@query("cache_with_ttl", f"""{with_views('log')} SELECT norm, arg_max(value, id) AS content, CAST(max(day) AS VARCHAR) AS fetched FROM log GROUP BY norm HAVING max(day) > DATE '2024-01-28'""")
def cache_with_ttl(spark, sf_dir):
    """Entries fetched within the time to live, the newest of each key."""
    newest = views.log(spark, sf_dir).groupBy("norm").agg(F.max_by("value", "id").alias("content"), F.max("day").alias("fetched"))
    return newest.where("fetched > DATE '2024-01-28'").withColumn("fetched", iso("fetched"))


@query("result_reuse", """SELECT doc_id, lang <> 'de' AND doc_id % 4 <> 0 AS reused FROM documents""")
def result_reuse(spark, sf_dir):
    """A parsed result is reused while source digest and parser revision are those it was made with."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("digest"), F.lit("r2").alias("revision"))
    stamps = docs.where("lang <> 'de'").select("doc_id", "digest", F.when(F.col("doc_id") % 4 == 0, "r1").otherwise("r2").alias("revision"), F.lit(True).alias("known"))
    return docs.join(stamps, ["doc_id", "digest", "revision"], "left").select("doc_id", F.coalesce("known", F.lit(False)).alias("reused"))


@query("tier_filter", """SELECT p_partkey AS id FROM part WHERE p_partkey IN (3, 7, 11) OR (p_name IS NOT NULL AND p_type LIKE 'STANDARD%')""")
def tier_filter(spark, sf_dir):
    return views.table(spark, sf_dir, "part").where(F.col("p_partkey").isin(3, 7, 11) | (F.col("p_name").isNotNull() & F.col("p_type").startswith("STANDARD"))).select(F.col("p_partkey").alias("id"))


@query("scope_filter", """SELECT p_partkey AS id, CASE WHEN p_size > 40 THEN NULL ELSE split_part(p_type, ' ', 1) END AS rank FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#23') AND (p_size > 40 OR split_part(p_type, ' ', 1) IN ('PROMO', 'SMALL'))""")
def scope_filter(spark, sf_dir):
    """Sections and ranks in scope; an unknown rank passes."""
    rank = F.when(F.col("p_size") <= 40, F.split_part("p_type", F.lit(" "), F.lit(1)))
    rows = views.table(spark, sf_dir, "part").where(F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#13", "Brand#23")).select(F.col("p_partkey").alias("id"), rank.alias("rank"))
    return rows.where(F.col("rank").isNull() | F.col("rank").isin("PROMO", "SMALL"))


@query("reviewed_gaps", """SELECT o_orderpriority AS reason, count(*) AS n, o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AS reviewed FROM orders GROUP BY 1""")
def reviewed_gaps(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("reason")).agg(F.count(F.lit(1)).alias("n")).withColumn("reviewed", F.col("reason").isin("1-URGENT", "2-HIGH", "5-LOW"))


@query("key_shape", r"""SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https?://[a-z0-9.]+/(en|fr|de|es)/[0-9]+$')""")
def key_shape(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").where(F.col("url").rlike("^https?://[a-z0-9.]+/(en|fr|de|es)/[0-9]+$")).select("page_id", "url")


@query("amendment_titles", r"""SELECT page_id, regexp_extract(url, '/([0-9]+)', 1) AS base, regexp_matches(url, '[?#]') AS amends FROM pages""")
def amendment_titles(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "/([0-9]+)", 1).alias("base"), F.col("url").rlike("[?#]").alias("amends"))


@query("schedule_filter", f"""{with_views('log')} SELECT norm, id FROM log WHERE isodow(day) < 6 AND day < DATE '2024-01-29'""")
def schedule_filter(spark, sf_dir):
    """Neither weekends nor a day that has not ended yet."""
    return views.log(spark, sf_dir).where(~F.weekday("day").isin(5, 6) & (F.col("day") < F.lit("2024-01-29").cast("date"))).select("norm", "id")


@query("removed_documents", f"""{with_views('log')} SELECT id, CASE WHEN norm % 3 = 0 THEN 'acc-' || id ELSE 'norm-' || norm END AS key FROM log WHERE kind <> 'error'""")
def removed_documents(spark, sf_dir):
    """Removed ones left out; the key falls back to the accession number."""
    key = F.coalesce(F.when(F.col("norm") % 3 != 0, F.concat(F.lit("norm-"), F.col("norm").cast("string"))), F.concat(F.lit("acc-"), F.col("id").cast("string")))
    return views.log(spark, sf_dir).where("kind <> 'error'").select("id", key.alias("key"))


@query("stated_fields", """SELECT doc_id, source AS value FROM documents WHERE length(source) <= 200 AND source <> '' UNION ALL SELECT doc_id, string_split(text, chr(10))[1] FROM documents WHERE length(string_split(text, chr(10))[1]) <= 200 AND string_split(text, chr(10))[1] <> ''""")
def stated_fields(spark, sf_dir):
    """Fields that state something: not empty and not whole texts."""
    values = F.array("source", F.substring_index("text", "\n", 1))
    return views.table(spark, sf_dir, "documents").select("doc_id", F.explode(values).alias("value")).where("value <> '' AND length(value) <= 200")


@query("identical_snapshots", f"""{with_views('ver')}, o AS (SELECT norm, src, block, md5(txt || qty) AS h, lag(md5(txt || qty)) OVER (PARTITION BY norm ORDER BY pub, src, block) AS before FROM ver) SELECT norm, src, block FROM o WHERE before IS NULL OR h <> before""")
def identical_snapshots(spark, sf_dir):
    digest = F.md5(F.concat("txt", F.col("qty").cast("string")))
    rows = views.versions(spark, sf_dir).select("norm", "src", "block", "pub", digest.alias("h"))
    before = F.lag("h").over(Window.partitionBy("norm").orderBy("pub", "src", "block"))
    return rows.withColumn("before", before).where("before IS NULL OR h <> before").select("norm", "src", "block")


_CAP = 90


def _halve(rows: pd.DataFrame) -> pd.DataFrame:
    """Ask a source that cuts its answers at ``_CAP`` rows for all keys of a batch."""
    held = {key: own["id"].tolist() for key, own in rows.groupby("key")}
    asked = []

    def ask(keys):
        asked.append(keys)
        return [(key, number) for key in keys for number in held[key]][:_CAP]

    found = http.halved(sorted(held), ask, _CAP)
    return pd.DataFrame(found, columns=["key", "id"]).assign(requests=len(asked))


@query("halving_pages", """WITH r AS (SELECT o_custkey AS key, o_orderkey AS id, o_custkey // 64 AS batch FROM orders), n AS (SELECT batch, count(*) AS n FROM r GROUP BY batch) SELECT key, id, n >= 90 AS halved FROM r JOIN n ON r.batch = n.batch""")
def halving_pages(spark, sf_dir):
    """Batches of 64 keys; one whose answer hits the row cap is asked for in halves until none does."""
    importable(spark)
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("id"), F.expr("o_custkey div 64").alias("batch"))
    return rows.groupBy("batch").applyInPandas(_halve, "key long, id long, requests int").select("key", "id", (F.col("requests") > 1).alias("halved"))


_SIGNALS = ("exact", "cumulative", "snapshot", "probe", "none")


@query("daily_signals", f"""{with_views('log')},
r AS (SELECT norm AS key, max(day) AS day, count(*) AS digest FROM log GROUP BY norm), b AS (SELECT norm AS key, count(*) AS digest FROM log WHERE day < DATE '2024-01-29' AND norm < 100 GROUP BY norm)
SELECT 'exact' AS signal, key FROM r WHERE day = DATE '2024-01-29' UNION ALL SELECT 'cumulative', key FROM r WHERE day = DATE '2024-01-29'
UNION ALL SELECT 'snapshot', r.key FROM r LEFT JOIN b ON r.key = b.key WHERE b.digest IS NULL OR b.digest <> r.digest UNION ALL SELECT 'probe', key FROM r WHERE key > (SELECT max(key) FROM b)""")
def daily_signals(spark, sf_dir):
    """What each way of signalling a change reports for one day."""
    log = views.log(spark, sf_dir).withColumnRenamed("norm", "key")
    rows = log.groupBy("key").agg(F.max("day").alias("day"), F.count(F.lit(1)).alias("digest"))
    before = log.where("day < DATE '2024-01-29' AND key < 100").groupBy("key").agg(F.count(F.lit(1)).alias("digest"))
    parts = [registry.changed(signal, rows, before, "2024-01-29").select(F.lit(signal).alias("signal"), "key") for signal in _SIGNALS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


_DAY = "DATE '2024-01-29'"
_DAILY_ROWS = f"""{with_views('log')}, c AS (SELECT norm AS key, count(*) AS digest FROM log GROUP BY norm),
rows_ AS (SELECT DISTINCT l.norm AS key, l.day, c.digest, CASE l.kind WHEN 'purchase' THEN 'consolidated' WHEN 'signup' THEN 'amended' ELSE 'published' END AS feed, CASE WHEN l.norm % 4 = 1 THEN l.norm - 1 END AS base, l.kind = 'error' AS removed FROM log l JOIN c ON c.key = l.norm),
before_ AS (SELECT norm AS key, count(*) AS digest FROM log WHERE day < {_DAY} AND norm % 7 <> 0 GROUP BY norm), pending_ AS (SELECT DISTINCT norm AS key FROM log WHERE kind = 'error' AND norm % 11 = 0)"""


def _daily_sql(source: registry.Source) -> str:
    """The same rule as SQL: each option of it a step of its own."""
    rule, rows = registry.DAILY.get(source.code, registry.Daily()), "rows_"
    if rule.removed:
        rows = f"(SELECT * FROM {rows} WHERE NOT removed)"
    if rule.base:
        rows = f"(SELECT * REPLACE (coalesce(base, key) AS key) FROM {rows})"
    if rule.latest:
        rows = f"(SELECT key, max(day) AS day, any_value(digest) AS digest, 'published' AS feed FROM {rows} GROUP BY key)"
    snapshot = f"SELECT r.key FROM {rows} r LEFT JOIN before_ b ON r.key = b.key WHERE b.digest IS NULL OR b.digest <> r.digest"
    found = {
        "exact": " UNION ".join(f"SELECT key FROM {rows} WHERE {'TRUE' if rule.latest else f'feed = {chr(39)}{feed}{chr(39)}'} AND day BETWEEN {_DAY} - {back} AND {_DAY}" for feed, back in rule.feeds),
        "cumulative": f"SELECT key FROM {rows} WHERE day >= {_DAY} AND key NOT IN (SELECT key FROM {rows} WHERE day > {_DAY})",
        "snapshot": snapshot, "probe": f"SELECT key FROM {rows} WHERE key > (SELECT coalesce(max(key), 0) FROM before_)", "none": "SELECT key FROM rows_ WHERE FALSE",
    }[source.signal]
    found += {"snapshot": f" UNION {snapshot}", "pending": " UNION SELECT key FROM pending_", "": ""}[rule.also]
    return f"SELECT DISTINCT '{source.code}' AS source, key FROM ({found}) {'WHERE key IN (SELECT key FROM before_)' if rule.scope else ''}"


@query("daily_by_source", f"{_DAILY_ROWS} " + " UNION ALL ".join(map(_daily_sql, registry.SOURCES)))
def daily_by_source(spark, sf_dir):
    """What each registered source reports for one day, by its own rule."""
    log = views.log(spark, sf_dir)
    feed = F.when(F.col("kind") == "purchase", "consolidated").when(F.col("kind") == "signup", "amended").otherwise("published")
    rows = log.select(F.col("norm").alias("key"), "day", feed.alias("feed"), F.when(F.col("norm") % 4 == 1, F.col("norm") - 1).alias("base"), (F.col("kind") == "error").alias("removed")).distinct()
    counts = log.groupBy(F.col("norm").alias("key")).agg(F.count(F.lit(1)).alias("digest"))
    rows = materialise(rows.join(counts, "key"), "daily-rows")
    before = materialise(log.where(f"day < {_DAY} AND norm % 7 <> 0").groupBy(F.col("norm").alias("key")).agg(F.count(F.lit(1)).alias("digest")), "daily-before")
    pending = log.where("kind = 'error' AND norm % 11 = 0").select(F.col("norm").alias("key")).distinct()
    out = None
    for source in registry.SOURCES:
        # A key's newest day says nothing of its list, so such a source has one.
        own = rows.withColumn("feed", F.lit("published")) if registry.DAILY.get(source.code, registry.Daily()).latest else rows
        part = registry.daily(source.code, own, before, "2024-01-29", pending).select(F.lit(source.code).alias("source"), "key")
        out = part if out is None else out.unionAll(part)
    return out


@query("source_registry", "SELECT * FROM (VALUES " + ", ".join(f"('{x.code}', '{x.formats}', '{x.history}', '{x.signal}', '{x.status}')" for x in registry.SOURCES) + ") v(code, formats, history, signal, status)")
def source_registry(spark, sf_dir):
    return registry.table(spark)
