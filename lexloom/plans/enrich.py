"""Named queries that join: enrichment, dimension lookups, edges, ranges, candidates."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.operators import enrich as e
from lexloom.plans.catalogue import query
from lexloom.views import iso, with_views


@query("reform_block_titles", f"""{with_views('norm', 'ver')}
SELECT v.src, string_agg(v.block || ' ' || n.title, '; ' ORDER BY v.block, v.norm) AS titles, count(*) AS n FROM ver v JOIN norm n ON v.norm = n.norm GROUP BY v.src""")
def reform_block_titles(spark, sf_dir):
    joined = views.versions(spark, sf_dir).select("src", "norm", "block").join(views.norms(spark, sf_dir).select("norm", "title"), "norm")
    items = F.array_sort(F.collect_list(F.struct("block", "norm", "title")))
    return joined.groupBy("src").agg(F.array_join(F.transform(items, lambda x: F.concat_ws(" ", x["block"], x["title"])), "; ").alias("titles"), F.count(F.lit(1)).alias("n"))


@query("catalogue_enrichment", """WITH a AS (SELECT l_partkey AS k, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS authors FROM lineitem WHERE l_quantity > 40 GROUP BY 1),
r AS (SELECT l_partkey AS k, min(l_orderkey) AS repealer FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
m AS (SELECT l_partkey AS k, count(*) AS amendments FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT p_partkey AS norm, a.authors, r.repealer, coalesce(m.amendments, 0) AS amendments FROM part LEFT JOIN a ON p_partkey = a.k LEFT JOIN r ON p_partkey = r.k LEFT JOIN m ON p_partkey = m.k""")
def catalogue_enrichment(spark, sf_dir):
    """Three enrichments over one scan and one shuffle of the facts instead of a join each."""
    line = views.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("norm"), "l_suppkey", "l_quantity", "l_returnflag", "l_orderkey")
    authors = F.array_sort(F.collect_set(F.when(F.col("l_quantity") > 40, F.col("l_suppkey").cast("string"))))
    facts = line.groupBy("norm").agg(
        authors.alias("authors"), F.min(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("repealer"), F.count_if(F.col("l_returnflag") == "A").alias("amendments"))
    joined = views.norms(spark, sf_dir).select("norm").join(facts, "norm", "left")
    return joined.select("norm", F.when(F.size("authors") > 0, F.array_join("authors", ",")).alias("authors"), "repealer", F.coalesce("amendments", F.lit(0)).alias("amendments"))


@query("two_hop_labels", """SELECT c_custkey AS id, n_name || '/' || r_name AS label FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'""")
def two_hop_labels(spark, sf_dir):
    """Key to concept to label; the dimensions have fixed sizes (25 and 5 rows), so they are broadcast."""
    nation, region = views.table(spark, sf_dir, "nation"), views.table(spark, sf_dir, "region").where("r_name <> 'ASIA'")
    labels = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.concat_ws("/", "n_name", "r_name").alias("label"))
    return views.table(spark, sf_dir, "customer").join(F.broadcast(labels), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), "label")


@query("edge_resolution", """WITH t AS (SELECT o_custkey AS subject, CASE WHEN o_orderstatus = 'F' THEN 'amends' ELSE 'amended_by' END AS predicate, o_orderkey % 2000 AS object FROM orders),
i AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0),
j AS (SELECT predicate, a.k AS s, b.k AS o FROM t LEFT JOIN i a ON subject = a.k LEFT JOIN i b ON object = b.k)
SELECT CASE WHEN predicate = 'amends' THEN s ELSE o END AS amender, CASE WHEN predicate = 'amends' THEN o ELSE s END AS amended, count(*) AS n
FROM j WHERE s IS NOT NULL AND o IS NOT NULL GROUP BY 1, 2""")
def edge_resolution(spark, sf_dir):
    """Relation triples with both ends known, the direction of inverse predicates turned."""
    triples = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("s"), (F.col("o_orderstatus") == "F").alias("forward"), (F.col("o_orderkey") % 2000).alias("o"))
    known = views.table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey"))
    both = triples.join(known.withColumnRenamed("c_custkey", "s"), "s").join(known.withColumnRenamed("c_custkey", "o"), "o")
    end = lambda a, b: F.when(F.col("forward"), F.col(a)).otherwise(F.col(b))
    return both.groupBy(end("s", "o").alias("amender"), end("o", "s").alias("amended")).agg(F.count(F.lit(1)).alias("n"))


@query("unresolved_relations", """WITH i AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0)
SELECT o_orderstatus AS predicate, count(*) AS relations, count(*) FILTER (WHERE i.k IS NULL) AS unresolved FROM orders LEFT JOIN i ON o_custkey = i.k GROUP BY 1""")
def unresolved_relations(spark, sf_dir):
    known = views.table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    joined = views.table(spark, sf_dir, "orders").join(known, F.col("o_custkey") == F.col("k"), "left")
    return joined.groupBy(F.col("o_orderstatus").alias("predicate")).agg(F.count(F.lit(1)).alias("relations"), F.count_if(F.col("k").isNull()).alias("unresolved"))


@query("last_relation_wins", """SELECT l_partkey AS law, l_suppkey AS act, CAST(max(o_orderdate) AS DATE)::VARCHAR AS day, arg_max(l_orderkey, l_orderkey * 10 + l_linenumber) AS src FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def last_relation_wins(spark, sf_dir):
    line = views.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    joined = line.join(views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(F.col("l_partkey").alias("law"), F.col("l_suppkey").alias("act")).agg(
        iso(F.max("o_orderdate")).alias("day"), F.max_by("l_orderkey", F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("src"))


@query("link_edges", r"""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS url FROM pages),
t AS (SELECT url, min(page_id) AS target FROM pages GROUP BY url)
SELECT h.page_id AS source, count(*) AS links, count(t.target) FILTER (WHERE t.target <> h.page_id) AS resolved FROM h LEFT JOIN t ON h.url = t.url GROUP BY 1""")
def link_edges(spark, sf_dir):
    """Links in bodies resolved to documents; links to itself do not count."""
    pages = views.table(spark, sf_dir, "pages")
    links = pages.select(F.col("page_id").alias("source"), F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("url"))
    targets = pages.groupBy("url").agg(F.min("page_id").alias("target"))
    return links.join(targets, "url", "left").groupBy("source").agg(F.count(F.lit(1)).alias("links"), F.count_if(F.col("target") != F.col("source")).alias("resolved"))


@query("merge_priority", """WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1), b AS (SELECT o_custkey AS k, min(o_totalprice) AS v FROM orders WHERE o_orderpriority LIKE '5%' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.v, b.v) AS v, CASE WHEN a.v IS NULL THEN 'prose' ELSE 'official' END AS origin FROM a FULL JOIN b ON a.k = b.k""")
def merge_priority(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"), "o_orderpriority")
    official = orders.where("o_orderpriority LIKE '1%'").groupBy("k").agg(F.max("v").alias("v"))
    return e.merge_priority(official, orders.where("o_orderpriority LIKE '5%'").groupBy("k").agg(F.min("v").alias("v")), ["k"], "v")


@query("index_growth", f"""{with_views('ver')},
o AS (SELECT norm, list(DISTINCT block) AS bs FROM ver WHERE pub < DATE '1996-06-01' GROUP BY norm), n AS (SELECT norm, list(DISTINCT block) AS bs FROM ver GROUP BY norm)
SELECT n.norm, len(list_filter(n.bs, lambda x: NOT list_contains(coalesce(o.bs, []), x))) AS grown FROM n LEFT JOIN o ON n.norm = o.norm WHERE len(list_filter(n.bs, lambda x: NOT list_contains(coalesce(o.bs, []), x))) > 0""")
def index_growth(spark, sf_dir):
    """Keys of an index that gained members; both states come from one pass over the rows."""
    early = F.collect_set(F.when(F.col("pub") < F.lit("1996-06-01").cast("date"), F.col("block")))
    grown = F.size(F.array_except(F.collect_set("block"), early)).cast("bigint")
    return views.versions(spark, sf_dir).groupBy("norm").agg(grown.alias("grown")).where("grown > 0")


@query("adjacency_sorted", f"""{with_views('ver')} SELECT norm, string_agg(CAST(src AS VARCHAR), ',' ORDER BY eff ASC NULLS LAST, src, block) AS amenders FROM ver GROUP BY norm""")
def adjacency_sorted(spark, sf_dir):
    """Edges of each norm by date, undated ones last."""
    edges = F.array_sort(F.collect_list(F.struct(F.coalesce("eff", F.lit("9999-12-31").cast("date")).alias("at"), "src", "block")))
    return views.versions(spark, sf_dir).groupBy("norm").agg(F.array_join(F.transform(edges, lambda x: x["src"].cast("string")), ",").alias("amenders"))


@query("range_page_lookup", """WITH pg AS (SELECT p_size * 100 AS low, p_size * 100 + 120 AS high, min(p_partkey) AS page FROM part GROUP BY p_size)
SELECT o_orderkey AS id, page FROM orders JOIN pg ON o_orderkey BETWEEN low AND high""")
def range_page_lookup(spark, sf_dir):
    pages = views.table(spark, sf_dir, "part").groupBy((F.col("p_size") * 100).cast("bigint").alias("low")).agg(F.min("p_partkey").alias("page")).withColumn("high", F.col("low") + 120)
    return e.in_ranges(views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), pages, "id", "low", "high", 100).select("id", "page")


@query("range_complement", """WITH pg AS (SELECT DISTINCT p_size * 100 AS low, p_size * 100 + 60 AS high FROM part) SELECT o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT 1 FROM pg WHERE o_orderkey BETWEEN low AND high)""")
def range_complement(spark, sf_dir):
    pages = views.table(spark, sf_dir, "part").select((F.col("p_size") * 100).cast("bigint").alias("low")).distinct().withColumn("high", F.col("low") + 60)
    ids = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return ids.join(e.in_ranges(ids, pages, "id", "low", "high", 100).select("id"), "id", "left_anti")


@query("attribute_correlation", """SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS ref, n_name AS target FROM events LEFT JOIN nation ON CAST(json_extract(props, '$.k') AS INT) % 30 = n_nationkey""")
def attribute_correlation(spark, sf_dir):
    """Elements of one document tied together by a shared id."""
    ref = F.get_json_object("props", "$.k").cast("int")
    rows = views.table(spark, sf_dir, "events").select("event_id", ref.alias("ref"))
    nation = views.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("target"))
    return rows.join(F.broadcast(nation), F.col("ref") % 30 == F.col("n_nationkey"), "left").select("event_id", "ref", "target")


@query("first_relevant_link", """SELECT l_orderkey AS id, arg_min(l_suppkey, (l_linenumber * 100000000 + l_partkey) * 100000 + l_suppkey) AS article FROM lineitem WHERE l_quantity > 10 GROUP BY 1""")
def first_relevant_link(spark, sf_dir):
    line = views.table(spark, sf_dir, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("id"), "l_suppkey", "l_linenumber", "l_partkey")
    return e.first_match(line, ["id"], F.struct("l_linenumber", "l_partkey", "l_suppkey"), ["l_suppkey"]).withColumnRenamed("l_suppkey", "article")


@query("dimension_defaults", """SELECT p_partkey AS norm, coalesce(map {'STANDARD': 'law', 'PROMO': 'decree', 'SMALL': 'order'}[split_part(p_type, ' ', 1)], 'other') AS rank FROM part""")
def dimension_defaults(spark, sf_dir):
    """A lookup with a default; the map is part of the plan, so nothing is joined."""
    ranks = F.create_map(*[F.lit(x) for x in ("STANDARD", "law", "PROMO", "decree", "SMALL", "order")])
    word = F.split_part("p_type", F.lit(" "), F.lit(1))
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("norm"), F.coalesce(F.try_element_at(ranks, word), F.lit("other")).alias("rank"))


@query("candidate_match", """WITH c AS (SELECT o_orderkey, o_custkey AS cand, 1 AS priority FROM orders UNION ALL SELECT o_orderkey, o_custkey // 2, 2 FROM orders UNION ALL SELECT o_orderkey, o_custkey + 7, 3 FROM orders)
SELECT o_orderkey AS id, arg_min(c_custkey, priority) AS matched, min(priority) AS how FROM c JOIN customer ON cand = c_custkey AND c_acctbal > 4000 GROUP BY 1""")
def candidate_match(spark, sf_dir):
    """Several spellings of a key, the best one that hits."""
    key = F.col("o_custkey")
    spelt = F.array(F.struct(key.alias("cand"), F.lit(1).alias("how")), F.struct(F.expr("o_custkey div 2").alias("cand"), F.lit(2).alias("how")), F.struct((key + 7).alias("cand"), F.lit(3).alias("how")))
    tried = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.inline(spelt))
    known = views.table(spark, sf_dir, "customer").where("c_acctbal > 4000").select(F.col("c_custkey").alias("cand"))
    return e.first_match(tried.join(known, "cand"), ["id"], F.col("how"), ["cand", "how"]).select("id", F.col("cand").alias("matched"), "how")


@query("composite_key_gap", """WITH a AS (SELECT lower(trim(p_brand)) || '|' || p_size AS k FROM part WHERE p_partkey % 2 = 0), b AS (SELECT lower(trim(p_brand)) || '|' || p_size AS k FROM part WHERE p_partkey % 3 = 0)
SELECT 'only catalogue' AS side, count(*) AS n FROM (SELECT DISTINCT k FROM a WHERE k NOT IN (SELECT k FROM b)) UNION ALL SELECT 'only repository', count(*) FROM (SELECT DISTINCT k FROM b WHERE k NOT IN (SELECT k FROM a))""")
def composite_key_gap(spark, sf_dir):
    """What each side lacks: one grouping of both sides answers either direction."""
    part = views.table(spark, sf_dir, "part").select(F.concat_ws("|", F.lower(F.trim("p_brand")), "p_size").alias("k"), (F.col("p_partkey") % 2 == 0).alias("a"), (F.col("p_partkey") % 3 == 0).alias("b"))
    sides = part.groupBy("k").agg(F.bool_or("a").alias("a"), F.bool_or("b").alias("b"))
    counts = sides.agg(F.count_if(F.expr("a AND NOT b")).alias("x"), F.count_if(F.expr("b AND NOT a")).alias("y"))
    return counts.select(F.expr("stack(2, 'only catalogue', x, 'only repository', y) AS (side, n)"))


@query("snapshot_amender", f"""{with_views('ver')},
s AS (SELECT DISTINCT norm, pub AS day FROM ver), a AS (SELECT norm, eff AS day, min(src) AS amender FROM ver WHERE eff IS NOT NULL GROUP BY ALL)
SELECT s.norm, CAST(s.day AS VARCHAR) AS day, a.amender FROM s LEFT JOIN a ON s.norm = a.norm AND s.day = a.day""")
def snapshot_amender(spark, sf_dir):
    v = views.versions(spark, sf_dir)
    amenders = v.where("eff IS NOT NULL").groupBy("norm", F.col("eff").alias("day")).agg(F.min("src").alias("amender"))
    return v.select("norm", F.col("pub").alias("day")).distinct().join(amenders, ["norm", "day"], "left").select("norm", iso("day").alias("day"), "amender")


@query("citation_timeline", """WITH c AS (SELECT l_partkey AS norm, l_orderkey AS act FROM lineitem), m AS (SELECT o_orderkey AS act, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus <> 'P'),
r AS (SELECT norm, day, act, row_number() OVER (PARTITION BY norm, day ORDER BY act) AS k FROM c JOIN m USING (act))
SELECT norm, CAST(day AS VARCHAR) AS day, act FROM r WHERE k = 1""")
def citation_timeline(spark, sf_dir):
    """Acts that a norm cites give its dates; of those on one day the first counts."""
    cites = views.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("norm"), F.col("l_orderkey").alias("act"))
    meta = views.table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("act"), F.to_date("o_orderdate").alias("day"))
    return cites.join(meta, "act").groupBy("norm", "day").agg(F.min("act").alias("act")).select("norm", iso("day").alias("day"), "act")


@query("graph_pattern", """SELECT p_partkey AS act, r.l_orderkey AS repealer, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p_partkey AND l.l_quantity > 49) AS consolidated
FROM part LEFT JOIN (SELECT l_partkey, min(l_orderkey) AS l_orderkey FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r ON r.l_partkey = p_partkey
WHERE NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_partkey = p_partkey AND x.l_discount > 0.099 AND x.l_tax > 0.07)""")
def graph_pattern(spark, sf_dir):
    """A pattern with an optional, an absent and a tested part: all three are aggregates of one scan."""
    line = views.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("act")).agg(
        F.min(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("repealer"), F.bool_or(F.col("l_quantity") > 49).alias("full"), F.bool_or((F.col("l_discount") > 0.099) & (F.col("l_tax") > 0.07)).alias("barred"))
    joined = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("act")).join(line, "act", "left")
    return joined.where(~F.coalesce("barred", F.lit(False))).select("act", "repealer", F.coalesce("full", F.lit(False)).alias("consolidated"))


@query("cross_graph", """SELECT o_orderkey AS consolidation, c_custkey AS work, n_name AS act FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'""")
def cross_graph(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").where("o_orderdate >= '1998-01-01' AND o_orderdate < '1998-02-01'").select("o_orderkey", "o_custkey")
    customer = views.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = views.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    works = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return works.select(F.col("o_orderkey").alias("consolidation"), F.col("c_custkey").alias("work"), F.col("n_name").alias("act"))


@query("effect_instruments", f"""{with_views('ver')},
x AS (SELECT DISTINCT src // 1000000 AS instrument FROM ver WHERE superseded),
m AS (SELECT instrument, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderpriority AS url FROM x LEFT JOIN orders ON instrument = o_orderkey)
SELECT v.norm, v.block, v.src, m.day, m.url FROM ver v JOIN m ON v.src // 1000000 = m.instrument WHERE v.superseded""")
def effect_instruments(spark, sf_dir):
    effects = views.versions(spark, sf_dir).where("superseded").select("norm", "block", "src", F.expr("src div 1000000").alias("instrument"))
    meta = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("instrument"), iso("o_orderdate").alias("day"), F.col("o_orderpriority").alias("url"))
    return effects.join(meta, "instrument", "left").select("norm", "block", "src", "day", "url")


@query("unseen_acts", f"""{with_views('ver')},
cited AS (SELECT norm, unnest(string_split(string_agg(DISTINCT CAST(src AS VARCHAR), ' | '), ' | ')) AS act FROM ver GROUP BY norm)
SELECT norm, act FROM cited WHERE NOT EXISTS (SELECT 1 FROM ver r WHERE r.norm = cited.norm AND CAST(r.src AS VARCHAR) = cited.act AND r.txt = 'N')""")
def unseen_acts(spark, sf_dir):
    """Acts that a norm's record lists and its own history lacks."""
    v = views.versions(spark, sf_dir)
    record = v.groupBy("norm").agg(F.array_join(F.collect_set(F.col("src").cast("string")), " | ").alias("record"))
    cited = record.select("norm", F.explode(F.split("record", r" \| ")).alias("act"))
    return cited.join(v.where("txt = 'N'").select("norm", F.col("src").cast("string").alias("act")), ["norm", "act"], "left_anti")


@query("group_map", """WITH g AS (SELECT lang AS grp, min(doc_id) AS known FROM documents WHERE doc_id % 5 = 0 AND lang <> 'fr' GROUP BY 1) SELECT doc_id, coalesce(known, doc_id) AS file FROM documents LEFT JOIN g ON lang = grp""")
def group_map(spark, sf_dir):
    """The file that a version's group already has, else its own id."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang")
    groups = docs.where("doc_id % 5 = 0 AND lang <> 'fr'").groupBy("lang").agg(F.min("doc_id").alias("known"))
    return docs.join(groups, "lang", "left").select("doc_id", F.coalesce("known", "doc_id").alias("file"))


@query("pointer_expansion", """SELECT r_name || '/' || n_name || '/' || s_name AS path, s_suppkey AS leaf FROM region JOIN nation ON r_regionkey = n_regionkey JOIN supplier ON n_nationkey = s_nationkey""")
def pointer_expansion(spark, sf_dir):
    """Structure to sections to articles, by following pointers a level at a time."""
    nodes = views.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("at"), F.col("r_name").alias("path"))
    nation = views.table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("at"), F.col("n_nationkey").alias("next"), F.col("n_name").alias("name"))
    supplier = views.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("at"), F.col("s_suppkey").alias("next"), F.col("s_name").alias("name"))
    for level in (nation, supplier):
        nodes = level.join(nodes, "at").select(F.col("next").alias("at"), F.concat_ws("/", "path", "name").alias("path"))
    return nodes.select("path", F.col("at").alias("leaf"))
