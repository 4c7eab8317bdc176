"""Named queries on markup and rendering."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.functions import markup, render
from lexloom.plans.catalogue import query
from lexloom.session import importable
from lexloom.views import iso, with_views

_pages = lambda spark, sf_dir: views.table(spark, sf_dir, "pages")


@query("page_title", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<p>')) AS paragraphs FROM pages")
def page_title(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<p>")).cast("bigint").alias("paragraphs"))


@query("page_links", """SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages""")
def page_links(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("href"))


@query("feed_records", r"""WITH f AS (SELECT p_partkey AS id, '<entry><id>' || p_partkey || '</id><title>' || p_name || '</title></entry>' AS x FROM part) SELECT id, regexp_extract(x, '<id>([^<]*)</id>', 1) AS key, regexp_extract(x, '<title>([^<]*)</title>', 1) AS title FROM f""")
def feed_records(spark, sf_dir):
    """Feed entries by XPath."""
    entry = F.concat(F.lit("<entry><id>"), F.col("p_partkey").cast("string"), F.lit("</id><title>"), "p_name", F.lit("</title></entry>"))
    rows = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), entry.alias("x"))
    return rows.select("id", F.xpath_string("x", F.lit("entry/id")).alias("key"), F.xpath_string("x", F.lit("entry/title")).alias("title"))


@query("triple_extract", r"""SELECT page_id, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n, array_to_string(list_transform(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x, i: i || '=' || x), ';') AS triples FROM pages""")
def triple_extract(spark, sf_dir):
    """Subject, property and value gathered by position."""
    values = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1)
    return _pages(spark, sf_dir).select("page_id", F.size(values).cast("bigint").alias("n"), F.array_join(F.transform(values, lambda x, i: F.concat_ws("=", (i + 1).cast("string"), x)), ";").alias("triples"))


@query("page_blocks")
def page_blocks(spark, sf_dir):
    importable(spark)
    _pages(spark, sf_dir).select("page_id", "html").createOrReplaceTempView("lexloom_pages")
    spark.udtf.register("page_blocks", markup.PageBlocks)
    return spark.sql("SELECT page_id, pos, kind, depth, text FROM lexloom_pages, LATERAL page_blocks(html)")


@query("page_tables")
def page_tables(spark, sf_dir):
    """Pages with a table of their url's parts added, so that every page has one with spans."""
    importable(spark)
    row = F.concat(F.lit('<table><thead><tr><th colspan="2">Url</th></tr></thead><tr><td rowspan="2">'), F.lit("page"), F.lit("</td><td>"), "url", F.lit("</td></tr><tr><td>a|b</td></tr></table>"))
    return _pages(spark, sf_dir).select("page_id", F.explode(markup.table_grids(F.concat("html", row))).alias("grid"))


@query("versioned_blocks", f"""{with_views('ver')}
SELECT norm, CAST(block AS VARCHAR) AS block, CAST(row_number() OVER (PARTITION BY norm, block ORDER BY src) - 1 AS INT) AS version, CAST(src AS VARCHAR) AS src, CAST(pub AS VARCHAR) AS pub, txt AS text FROM ver""")
def versioned_blocks(spark, sf_dir):
    """Documents written as XML and read back into version rows."""
    importable(spark)
    v = views.versions(spark, sf_dir)
    versions = F.array_sort(F.collect_list(F.struct("src", "pub", "txt")))
    inner = F.array_join(F.transform(versions, lambda x: F.concat(F.lit('<version src="'), x["src"].cast("string"), F.lit('" pub="'), iso(x["pub"]), F.lit('"><p>'), x["txt"], F.lit("</p></version>"))), "")
    blocks = v.groupBy("norm", "block").agg(F.concat(F.lit('<block id="'), F.col("block").cast("string"), F.lit('">'), inner, F.lit("</block>")).alias("xml"))
    docs = blocks.groupBy("norm").agg(F.concat(F.lit("<doc>"), F.array_join(F.array_sort(F.collect_list("xml")), ""), F.lit("</doc>")).alias("xml"))
    docs.createOrReplaceTempView("lexloom_docs")
    spark.udtf.register("versioned_blocks", markup.VersionedBlocks)
    return spark.sql("SELECT norm, block, version, src, pub, text FROM lexloom_docs, LATERAL versioned_blocks(xml)")


@query("markdown_render", r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
r AS (SELECT doc_id, i, CASE WHEN i = 1 THEN '# ' || line WHEN length(line) < 30 THEN '## ' || line ELSE line END AS out FROM l WHERE line <> '')
SELECT doc_id, md5(string_agg(out, chr(10) || chr(10) ORDER BY i)) AS markdown FROM r GROUP BY doc_id""")
def markdown_render(spark, sf_dir):
    """Blocks by kind, joined in order inside each row; nothing is exploded or shuffled."""
    kinds = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(F.when(i == 0, "h1").when(F.length(x) < 30, "h2").otherwise("p").alias("kind"), x.alias("text"))), lambda b: b["text"] != "")
    lines = F.transform(kinds, lambda b: render.block(b["kind"], b["text"]))
    rows = views.table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines")).where(F.size("lines") > 0)
    return rows.select("doc_id", F.md5(F.array_join("lines", "\n\n")).alias("markdown"))


@query("frontmatter", r"""SELECT o_orderkey AS id, '---' || chr(10) || 'identifier: ' || o_orderkey || chr(10) || CASE WHEN o_orderstatus <> 'P' THEN 'status: ' || CASE o_orderstatus WHEN 'F' THEN 'repealed' ELSE 'in_force' END || chr(10) ELSE '' END || 'date: ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || chr(10) || '---' AS header FROM orders""")
def frontmatter(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "repealed").when(F.col("o_orderstatus") == "O", "in_force")
    return views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), render.front_matter(identifier=F.col("o_orderkey").cast("string"), status=status, date=iso("o_orderdate")).alias("header"))


@query("frontmatter_parse", """SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS identifier, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders""")
def frontmatter_parse(spark, sf_dir):
    """The fenced header of a Markdown text, body left alone."""
    header = render.front_matter(identifier=F.col("o_orderkey").cast("string"), date=iso("o_orderdate"))
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.concat(header, F.lit("\n\n# Title\n\nbody: no header\n")).alias("md"))
    keys = F.str_to_map(F.regexp_extract("md", "(?s)^---\n(.*?)\n---", 1), F.lit("\n"), F.lit(": "))
    return rows.select("id", keys["identifier"].alias("identifier"), keys["date"].alias("date"))


@query("title_echo", r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) SELECT doc_id, len(ls) > 1 AND starts_with(lower(ls[2]), left(lower(ls[1]), 5)) AS echoes FROM l""")
def title_echo(spark, sf_dir):
    lines = F.split("text", "\n", -1)
    second = F.get(lines, F.lit(1))
    return views.table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.lower(second).startswith(F.left(F.lower(F.get(lines, F.lit(0))), F.lit(5))), F.lit(False)).alias("echoes"))


@query("stable_block_ids", f"""{with_views('ver')} SELECT norm, block, src, CASE WHEN block % 3 = 0 THEN left(sha1(norm || txt || qty), 12) ELSE 'b' || block END AS block_id FROM ver""")
def stable_block_ids(spark, sf_dir):
    """The source's id where it has one, else one from the content."""
    made = F.left(F.sha1(F.concat(F.col("norm").cast("string"), "txt", F.col("qty").cast("string")).cast("binary")), F.lit(12))
    return views.versions(spark, sf_dir).select("norm", "block", "src", F.when(F.col("block") % 3 == 0, made).otherwise(F.concat(F.lit("b"), F.col("block").cast("string"))).alias("block_id"))


@query("layout_tables", """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, count(*) AS rows_seen, CAST(max(len(string_split(line, ' | '))) AS BIGINT) AS columns FROM l WHERE contains(line, ' | ') GROUP BY doc_id""")
def layout_tables(spark, sf_dir):
    """Lines laid out in columns, told by their separators."""
    rows = F.filter(F.split("text", "\n", -1), lambda x: F.contains(x, F.lit(" | ")))
    docs = views.table(spark, sf_dir, "documents").select("doc_id", rows.alias("r")).where(F.size("r") > 0)
    return docs.select("doc_id", F.size("r").cast("bigint").alias("rows_seen"), F.array_max(F.transform("r", lambda x: F.size(F.split(x, r" \| ", -1)))).cast("bigint").alias("columns"))


@query("prior_version_rows", f"""{with_views('ver')}
SELECT norm, block, 'current' AS which, txt FROM ver WHERE eff IS NOT NULL UNION ALL SELECT norm, block, 'prior', txt FROM ver WHERE eff IS NOT NULL AND eff > pub
UNION ALL SELECT norm, block, 'tombstone', '' FROM ver WHERE expiry IS NOT NULL AND txt = 'R'""")
def prior_version_rows(spark, sf_dir):
    """One source row can hold several versions: the current one, the one it replaces, the mark of its end."""
    current, prior = F.col("eff").isNotNull(), F.col("eff") > F.col("pub")
    ended = F.col("expiry").isNotNull() & (F.col("txt") == "R")
    made = F.array_compact(F.array(
        F.when(current, F.struct(F.lit("current").alias("which"), "txt")), F.when(prior, F.struct(F.lit("prior").alias("which"), "txt")),
        F.when(ended, F.struct(F.lit("tombstone").alias("which"), F.lit("").alias("txt")))))
    return views.versions(spark, sf_dir).select("norm", "block", F.inline(made))


@query("page_markdown")
def page_markdown(spark, sf_dir):
    """Pages to Markdown: blocks parsed, formatted by kind and joined in order."""
    blocks = page_blocks(spark, sf_dir)
    ordered = F.array_sort(F.collect_list(F.struct("pos", render.block(F.col("kind"), F.col("text")).alias("text"))))
    return blocks.groupBy("page_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n\n").alias("markdown"))


@query("inline_serialise", r"""SELECT page_id, len(regexp_extract_all(html, '(?i)<(b|strong)>')) AS bold, len(regexp_extract_all(html, '(?i)<br')) AS breaks FROM pages""")
def inline_serialise(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", F.regexp_count("html", F.lit("(?i)<(b|strong)>")).cast("bigint").alias("bold"), F.regexp_count("html", F.lit("(?i)<br")).cast("bigint").alias("breaks"))


@query("rank_by_page", """WITH r AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, length(html) AS size FROM pages) SELECT page_id, row_number() OVER (PARTITION BY host ORDER BY size DESC, page_id) AS place FROM r""")
def rank_by_page(spark, sf_dir):
    rows = _pages(spark, sf_dir).select("page_id", F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host"), F.length("html").alias("size"))
    return rows.select("page_id", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("size"), "page_id")).cast("bigint").alias("place"))
