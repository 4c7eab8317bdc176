"""Named queries for the function families: text, dates, identifiers, nested values."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom import views
from lexloom.functions import dates as d, identifiers, nested as n, text as t
from lexloom.operators import instructions
from lexloom.plans.catalogue import query
from lexloom.session import importable
from lexloom.views import iso

_docs = lambda spark, sf_dir: views.table(spark, sf_dir, "documents")
_pages = lambda spark, sf_dir: views.table(spark, sf_dir, "pages")
_orders = lambda spark, sf_dir: views.table(spark, sf_dir, "orders")


@query("clean_text", r"""SELECT doc_id, md5(trim(regexp_replace(replace(replace(text, chr(160), ' '), chr(8203), ''), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), ' ')) AS cleaned FROM documents""")
def clean_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(t.clean(F.col("text"))).alias("cleaned"))


@query("squeeze_lines", r"""SELECT doc_id, md5(array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN starts_with(x, '|') OR starts_with(x, '```') THEN x ELSE regexp_replace(x, '[ \t]+', ' ', 'g') END), chr(10))) AS squeezed FROM documents""")
def squeeze_lines(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(t.squeeze_lines(F.col("text"))).alias("squeezed"))


@query("yaml_escape", r"""SELECT doc_id, md5('"' || replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(9), '\t') || '"') AS quoted FROM documents""")
def yaml_escape(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(t.yaml_quoted(F.col("text"))).alias("quoted"))


@query("title_clean", r"""SELECT doc_id, regexp_replace(string_split(text, chr(10))[1], '[. ]+$', '') AS title FROM documents""")
def title_clean(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", t.title(F.substring_index("text", "\n", 1)).alias("title"))


@query("numbering_escape", r"""SELECT o_orderkey AS id, regexp_replace((o_orderkey % 200) || CASE WHEN o_orderkey % 2 = 0 THEN '. ' ELSE ') ' END || o_orderpriority, '^([0-9]{1,9})([.)])([ \t])', '\1\\\2\3') AS line FROM orders""")
def numbering_escape(spark, sf_dir):
    line = F.concat((F.col("o_orderkey") % 200).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ". ").otherwise(") "), "o_orderpriority")
    return _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), t.escape_numbering(line).alias("line"))


@query("inline_wrap", r"""WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN ' ' || p_name WHEN p_partkey % 3 = 1 THEN p_name || '  ' ELSE '  ' END AS s FROM part)
SELECT p_partkey AS id, CASE WHEN trim(s) = '' THEN s ELSE regexp_extract(s, '^( *)', 1) || '**' || trim(s) || '**' || regexp_extract(s, '( *)$', 1) END AS marked FROM x""")
def inline_wrap(spark, sf_dir):
    k = F.col("p_partkey") % 3
    text = F.when(k == 0, F.concat(F.lit(" "), "p_name")).when(k == 1, F.concat("p_name", F.lit("  "))).otherwise("  ")
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), t.wrapped(text, "**").alias("marked"))


@query("normalise_value", r"""WITH x AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE '  ' || upper(event_type) || '  x ' END AS v FROM events)
SELECT event_id, CASE WHEN regexp_matches(lower(trim(regexp_replace(v, '[ \t\n]+', ' ', 'g'))), '^[0-9]{4}-[0-9]{2}-[0-9]{2}[t ][0-9]{2}:') THEN substr(lower(trim(v)), 1, 10) ELSE lower(trim(regexp_replace(v, '[ \t\n]+', ' ', 'g'))) END AS value FROM x""")
def normalise_value(spark, sf_dir):
    value = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.concat(F.lit("  "), F.upper("event_type"), F.lit("  x ")))
    return views.table(spark, sf_dir, "events").select("event_id", t.normalised(value).alias("value"))


@query("safe_ids", """SELECT page_id, replace(translate(url, ':/', '--'), ' ', '') AS id FROM pages""")
def safe_ids(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", t.safe_id(F.col("url")).alias("id"))


@query("accent_fold", f"SELECT doc_id, md5(translate(text, '{t.ACCENTED}', '{t.PLAIN}')) AS folded FROM documents")
def accent_fold(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(t.folded(F.col("text"))).alias("folded"))


@query("slug", f"""SELECT doc_id, left(regexp_replace(regexp_replace(lower(translate(string_split(text, chr(10))[1], '{t.ACCENTED}', '{t.PLAIN}')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 60) AS slug FROM documents""")
def slug(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", t.slug(F.substring_index("text", "\n", 1)).alias("slug"))


@query("article_ids", """SELECT p_partkey AS id, 'art' || regexp_replace(lower(p_brand), '[^a-z0-9]+', '', 'g') AS article FROM part""")
def article_ids(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), t.article_id(F.col("p_brand")).alias("article"))


@query("html_to_text")
def html_to_text(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", t.html_to_text(F.col("html")).alias("text"))


@query("body_snippet", r"""SELECT page_id, left(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')), 300) AS snippet FROM pages""")
def body_snippet(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", t.snippet(F.col("html")).alias("snippet"))


@query("html_to_markdown", r"""SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)</?(b|strong)>', '**', 'g'), '(?i)</?(i|em)>', '*', 'g'), '(?i)<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', '[\2](\1)', 'g'), '(?i)<br[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g')) AS markdown FROM pages""")
def html_to_markdown(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", F.md5(t.html_to_markdown(F.col("html"))).alias("markdown"))


@query("raised_numbers", f"""SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN translate(CAST(p_size AS VARCHAR), '{t.DIGITS}', '{t.SUPERSCRIPT}') ELSE '^(' || p_brand || ')' END AS raised FROM part""")
def raised_numbers(spark, sf_dir):
    text = F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_brand"))
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), t.raised(text).alias("raised"))


@query("tokenise", r"""SELECT doc_id, len(ts) AS n_tokens, len(list_distinct(ts)) AS n_distinct, md5(array_to_string(ts, ' ')) AS tokens FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\pL\pM\p{Nd}\p{Pc}]+') AS ts FROM documents)""")
def tokenise(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", t.tokens(F.col("text")).alias("ts"))
    return rows.select("doc_id", F.size("ts").cast("bigint").alias("n_tokens"), F.size(F.array_distinct("ts")).cast("bigint").alias("n_distinct"), F.md5(F.array_join("ts", " ")).alias("tokens"))


@query("mojibake_repair")
def mojibake_repair(spark, sf_dir):
    """Text broken on purpose comes back as it was."""
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return _docs(spark, sf_dir).select("doc_id", t.mojibake(broken).cast("bigint").alias("pairs"), (t.repaired(broken) == F.col("text")).alias("restored"))


@query("image_payloads", r"""SELECT page_id, md5(regexp_replace(html, 'data:image/[a-z]+;base64,[A-Za-z0-9+/=]+', '', 'g')) AS bare, len(regexp_extract_all(html, '<img')) AS images FROM pages""")
def image_payloads(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", F.md5(t.without_payload(F.col("html"))).alias("bare"), F.regexp_count("html", F.lit("<img")).cast("bigint").alias("images"))


_RULES = [("^STANDARD", "law"), ("BRUSHED|POLISHED", "decree"), ("^PROMO", "order"), ("STEEL$", "resolution")]


@query("rank_rules", "SELECT p_partkey AS id, CASE " + " ".join(f"WHEN regexp_matches(p_type, '{p}') THEN '{v}'" for p, v in _RULES) + " ELSE 'other' END AS rank FROM part")
def rank_rules(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), t.first_rule(F.col("p_type"), _RULES, "other").alias("rank"))


_ACT = [
    ("Art. 1° - Sustitúyese el artículo ", "p_size", "° bis de la Ley N° 19.", "p_partkey", " por el siguiente: \"Artículo ", "p_size", "° bis: texto de ", "p_type", ".\""),
    (" Art. 2° - Deróganse los artículos 101 y ", "p_size", " de la Ley 20.000. Derógase el artículo 7 de la Ley N° 1.", "p_partkey", "."),
    (" ARTICULO 3° - Sustitúyense los artículos 21; 22 de la Ley N° 19.550 por los siguientes: “Artículo 21- ", "p_name", ".” “Artículo 22- ", "p_brand", ".”"),
    (" Art. 4° - Incorpórase como artículo 30 de la Ley Nro. 19.550 el siguiente: ", "p_type", ". Art. 5° - Sustitúyense los artículos 40 y 41 de la Ley N° 19.550 por los siguientes: sin comillas."),
]
_ORDERS = [
    ("1", "substitute", "'19' || p_partkey", "p_size || ' bis'", "'texto de ' || p_type || '.'"), ("2", "repeal", "'20000'", "'101'", "''"), ("2", "repeal", "'20000'", "CAST(p_size AS VARCHAR)", "''"), ("2", "repeal", "'1' || p_partkey", "'7'", "''"),
    ("3", "substitute", "'19550'", "'21'", "p_name || '.'"), ("3", "substitute", "'19550'", "'22'", "p_brand || '.'"), ("4", "insert", "'19550'", "'30'", "p_type || '.'"), ("5", "unknown", "'19550'", "'40'", "''"), ("5", "unknown", "'19550'", "'41'", "''"),
]


@query("instruction_extract", " UNION ALL ".join(f"SELECT p_partkey AS act, '{source}' AS source_article, '{kind}' AS kind, {law} AS law, {article} AS article, {wording} AS wording FROM part" for source, kind, law, article, wording in _ORDERS))
def instruction_extract(spark, sf_dir):
    """What an amending act orders, article by article."""
    pieces = [F.col(x).cast("string") if i % 2 else F.lit(x) for part in _ACT for i, x in enumerate(part)]
    acts = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("act"), F.concat(*pieces).alias("text"))
    return instructions.orders(acts).drop("place")


@query("ident_parse", r"""SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS path, regexp_extract(url, '([0-9]+)[^0-9]*$', 1) AS number FROM pages""")
def ident_parse(spark, sf_dir):
    part = lambda pattern: F.regexp_extract("url", pattern, 1)
    return _pages(spark, sf_dir).select("page_id", part("^https?://([^/?#]+)").alias("host"), part("^https?://[^/]+(/[^?#]*)").alias("path"), part("([0-9]+)[^0-9]*$").alias("number"))


@query("section_grammar", r"""SELECT p_partkey AS id, (p_size % 9 + 1) || ':' || p_size || ',' || (p_size % 9 + 1) || ':' || (p_size + 2) || ',' || (p_size % 9 + 1) || ':' || (p_size + 3) || ',' || (p_size % 9 + 1) || ':' || (p_size + 4) || ',2:7,4,8 a' AS affected FROM part""")
def section_grammar(spark, sf_dir):
    """"ändr. 1 kap. 3, 5-7 §§, 2 kap. 7 §; upph. 4 §; ny 8 a §" names 1:3, 1:5 to 1:7, 2:7, 4 and 8 a."""
    size = F.col("p_size")
    note = F.concat(F.lit("ändr. "), (size % 9 + 1).cast("string"), F.lit(" kap. "), size.cast("string"), F.lit(", "), (size + 2).cast("string"), F.lit("–"), (size + 4).cast("string"), F.lit(" §§, 2 kap. 7 §; upph. 4 §; ny 8 a §"))
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.array_join(identifiers.affected_sections(note), ",").alias("affected"))


_IDS = {
    "celex": ("", "R", True, 4), "gazette": ("BOE", "A", True, 0), "eli": ("pt", "dec-lei", True, 0), "urn": ("stato", "legge", True, 0),
    "statute": ("", "ukpga", True, 0), "journal": ("", "DU", True, 0), "register": ("", "BWBR", False, 7), "yearly": ("", "", True, 0),
}
_OR_NULL = lambda x: f"'{x}'" if x else "CAST(NULL AS VARCHAR)"


@query("identifiers", " UNION ALL ".join(f"SELECT p_partkey AS id, '{scheme}' AS scheme, {_OR_NULL(place)} AS place, {_OR_NULL(kind)} AS kind, {'CAST(1990 + p_size % 30 AS VARCHAR)' if year else 'CAST(NULL AS VARCHAR)'} AS year, {f'lpad(CAST(p_partkey % 10000 AS VARCHAR), {pad}, chr(48))' if pad else 'CAST(p_partkey % 10000 AS VARCHAR)'} AS number FROM part" for scheme, (place, kind, year, pad) in _IDS.items()))
def identifiers_query(spark, sf_dir):
    """Identifiers of each scheme built from their parts and parsed again."""
    part = views.table(spark, sf_dir, "part").select("p_partkey", (1990 + F.col("p_size") % 30).alias("year"), (F.col("p_partkey") % 10_000).alias("number"))
    given = lambda x: F.lit(x) if x else None
    ids = F.array(*[identifiers.built(scheme, given(place), given(kind), F.col("year") if year else None, F.col("number")) for scheme, (place, kind, year, _) in _IDS.items()])
    rows = part.select(F.col("p_partkey").alias("id"), F.explode(ids).alias("text")).select("id", identifiers.parsed(F.col("text")).alias("p"))
    return rows.select("id", "p.scheme", "p.place", "p.kind", "p.year", "p.number")


@query("short_titles", """SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'Directive ' || p_name WHEN 1 THEN 'The ' || p_type || ' Act' ELSE 'Ley ' || p_partkey || ' de ' || p_name END AS short FROM part""")
def short_titles(spark, sf_dir):
    name = F.col("p_name")
    key = F.col("p_partkey")
    title = F.when(key % 3 == 0, F.concat(F.lit("Directive "), name, F.lit(" of the European Parliament and of the Council (Text with EEA relevance)"))).when(key % 3 == 1, F.concat(F.lit("An Act to do many things (The "), F.col("p_type"), F.lit(" Act)."))).otherwise(F.concat(F.lit("Ley "), key.cast("string"), F.lit(" de "), name, F.lit(", por la que se regula.")))
    return views.table(spark, sf_dir, "part").select(key.alias("id"), identifiers.short_title(title).alias("short"))


@query("commit_message", """SELECT o_orderkey AS id, '[' || CASE o_orderstatus WHEN 'F' THEN 'repeal' ELSE 'reform' END || '] ' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN ' — art. ' || (o_orderkey % 90) ELSE '' END || chr(10) || chr(10) || 'Source-Id: ' || o_orderkey || chr(10) || 'Norm-Id: ' || o_custkey || CASE WHEN o_orderstatus <> 'P' THEN chr(10) || 'Source-Date: ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) ELSE '' END AS message FROM orders""")
def commit_message(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "F", "repeal").otherwise("reform")
    article = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("art. "), (F.col("o_orderkey") % 90).cast("string"))).otherwise("")
    subject = t.commit_subject(kind, F.col("o_custkey").cast("string"), article)
    body = t.trailers(Source_Id=F.col("o_orderkey").cast("string"), Norm_Id=F.col("o_custkey").cast("string"), Source_Date=F.when(F.col("o_orderstatus") != "P", iso("o_orderdate")))
    return _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), F.concat(subject, F.lit("\n\n"), body).alias("message"))


@query("trailer_parse", """SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS norm, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS source_date, 2::BIGINT AS n FROM orders""")
def trailer_parse(spark, sf_dir):
    """Lines "Key: value" of a message into a map."""
    message = F.concat(F.lit("subject\n\nbody text\n\nNorm-Id: "), F.col("o_custkey").cast("string"), F.lit("\nSource-Date:  "), iso("o_orderdate"), F.lit(" \n"))
    pairs = F.transform(F.regexp_extract_all(message, F.lit("(?m)^[A-Z][A-Za-z-]*: *.+?[ \t]*$"), 0), lambda x: F.struct(F.substring_index(x, ":", 1).alias("k"), F.trim(F.substr(x, F.instr(x, ":") + 1)).alias("v")))
    rows = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), F.map_from_entries(pairs).alias("m"))
    return rows.select("id", F.col("m")["Norm-Id"].alias("norm"), F.col("m")["Source-Date"].alias("source_date"), F.size("m").cast("bigint").alias("n"))


@query("date_parse_ladder", """SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS day FROM orders""")
def date_parse_ladder(spark, sf_dir):
    """Four ways of writing a day and one that is none."""
    form = lambda f: F.date_format("o_orderdate", f)
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, form("yyyy-MM-dd")).when(k == 1, form("dd.MM.yyyy")).when(k == 2, form("dd/MM/yyyy")).when(k == 3, form("yyyyMMdd")).otherwise("n/a")
    rows = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), text.alias("s"))
    return rows.select("id", iso(d.ladder(F.col("s"), "yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy", "yyyyMMdd")).alias("day"))


@query("compact_dates", """SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS day, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS of_number FROM orders""")
def compact_dates(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 3 == 0, "99999999").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), iso(d.compact(text)).alias("day"), iso(d.from_number(F.date_format("o_orderdate", "yyyyMMdd").cast("int"))).alias("of_number"))


@query("spelled_dates", """SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS es, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fr FROM orders""")
def spelled_dates(spark, sf_dir):
    def text(language: str, join: str):
        names = F.array(*[F.lit(x) for x in d.MONTHS[language].split()])
        return F.concat_ws(join, F.date_format("o_orderdate", "d"), F.element_at(names, F.month("o_orderdate")), F.date_format("o_orderdate", "yyyy"))

    rows = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), text("es", " de ").alias("es"), text("fr", " ").alias("fr"))
    return rows.select("id", iso(d.spelled(F.col("es"), "es")).alias("es"), iso(d.spelled(F.col("fr"), "fr")).alias("fr"))


@query("http_dates", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events""")
def http_dates(spark, sf_dir):
    text = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    return views.table(spark, sf_dir, "events").select("event_id", F.date_format(d.http_date(text), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("calendar_plan", """WITH p AS (SELECT n_nationkey AS source, DATE '2024-01-01' + n_nationkey AS cursor FROM nation), s AS (SELECT source, unnest(generate_series(greatest(cursor + 1, DATE '2024-01-20' - 10), DATE '2024-01-20', INTERVAL 1 DAY))::DATE AS day FROM p WHERE greatest(cursor + 1, DATE '2024-01-20' - 10) <= DATE '2024-01-20')
SELECT source, CAST(day AS VARCHAR) AS day FROM s WHERE isodow(day) < 6""")
def calendar_plan(spark, sf_dir):
    """The days to process: after the cursor, at most ten back, without weekends."""
    today = F.lit("2024-01-20").cast("date")
    cursor = F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_nationkey"))
    start = F.greatest(F.date_add(cursor, 1), F.date_sub(today, 10))
    return views.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source"), F.explode(d.working_days(start, today)).alias("day")).select("source", iso("day").alias("day"))


@query("lookback_clamp", """WITH p AS (SELECT n_nationkey AS source, DATE '2024-01-01' + n_nationkey AS cursor FROM nation) SELECT source, CAST(greatest(cursor + 1, DATE '2024-01-20' - 10) AS VARCHAR) AS start,
  CASE WHEN cursor + 1 < DATE '2024-01-20' - 10 THEN CAST(cursor + 1 AS VARCHAR) || '..' || CAST(DATE '2024-01-20' - 11 AS VARCHAR) END AS dropped FROM p""")
def lookback_clamp(spark, sf_dir):
    today = F.lit("2024-01-20").cast("date")
    first, least = F.date_add(F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_nationkey")), 1), F.date_sub(today, 10)
    dropped = F.when(first < least, F.concat(iso(first), F.lit(".."), iso(F.date_sub(least, 1))))
    return views.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source"), iso(F.greatest(first, least)).alias("start"), dropped.alias("dropped"))


@query("previous_scheduled", """WITH x AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) SELECT CAST(day AS VARCHAR) AS day, CAST(day - CASE isodow(day) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS VARCHAR) AS before FROM x""")
def previous_scheduled(spark, sf_dir):
    rows = _orders(spark, sf_dir).select(F.to_date("o_orderdate").alias("day")).distinct()
    return rows.select(iso("day").alias("day"), iso(d.previous_scheduled(F.col("day"))).alias("before"))


@query("epoch_clamp", """SELECT o_orderkey AS id, CAST(epoch(greatest(CAST(o_orderdate AS DATE) - 10000, DATE '1970-01-02')) AS BIGINT) AS seconds, substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 3) || '0s' AS decade FROM orders""")
def epoch_clamp(spark, sf_dir):
    day = d.clamped(F.date_sub(F.to_date("o_orderdate"), 10000))
    return _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), (F.unix_date(day).cast("bigint") * 86400).alias("seconds"), d.decade(F.to_date("o_orderdate")).alias("decade"))


@query("change_windows", """SELECT o_orderkey AS id, CASE WHEN age <= 7 THEN 'OneWeek' WHEN age <= 14 THEN 'TwoWeeks' WHEN age <= 31 THEN 'OneMonth' WHEN age <= 93 THEN 'ThreeMonths' WHEN age <= 186 THEN 'SixMonths' ELSE 'OneYear' END AS name FROM (SELECT o_orderkey, DATE '2001-08-02' - CAST(o_orderdate AS DATE) AS age FROM orders)""")
def change_windows(spark, sf_dir):
    age = F.datediff(F.lit("2001-08-02").cast("date"), F.to_date("o_orderdate"))
    return _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), d.window_name(age).alias("name"))


@query("json_props", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("json_paths", """SELECT event_id, 'meta.kind' AS path, event_type AS value FROM events UNION ALL SELECT event_id, 'ids', CAST(event_id AS VARCHAR) FROM events UNION ALL SELECT event_id, 'ids', CAST(user_id AS VARCHAR) FROM events""")
def json_paths(spark, sf_dir):
    importable(spark)
    doc = F.to_json(F.struct(F.struct(F.col("event_type").alias("kind")).alias("meta"), F.array("event_id", "user_id").alias("ids")))
    views.table(spark, sf_dir, "events").select("event_id", doc.alias("doc")).createOrReplaceTempView("lexloom_json")
    spark.udtf.register("json_paths", n.JsonPaths)
    return spark.sql("SELECT event_id, path, value FROM lexloom_json, LATERAL json_paths(doc)")


@query("one_or_many", """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type || ',' || user_id ELSE event_type END AS items FROM events""")
def one_or_many(spark, sf_dir):
    text = F.when(F.col("event_id") % 2 == 0, F.to_json(F.array("event_type", F.col("user_id").cast("string")))).otherwise(F.col("event_type"))
    return views.table(spark, sf_dir, "events").select("event_id", F.array_join(n.one_or_many(text), ",").alias("items"))


@query("ordered_unique", """WITH w AS (SELECT doc_id, string_split(text, ' ') AS ws FROM documents) SELECT doc_id, md5(array_to_string(list_filter(ws, lambda x, i: list_position(ws, x) = i), ' ')) AS words FROM w""")
def ordered_unique(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(F.array_join(F.array_distinct(F.split("text", " ", -1)), " ")).alias("words"))


@query("map_merge", """SELECT event_id, event_type AS kind, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS extra, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS n FROM events""")
def map_merge(spark, sf_dir):
    core = F.create_map(F.lit("kind"), F.col("event_type"))
    extra = n.present(F.create_map(F.lit("kind"), F.lit("shadowed"), F.lit("extra"), F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("string"))))
    rows = views.table(spark, sf_dir, "events").select("event_id", n.merged(core, extra).alias("m"))
    return rows.select("event_id", F.col("m")["kind"].alias("kind"), F.try_element_at("m", F.lit("extra")).alias("extra"), F.size("m").cast("bigint").alias("n"))


@query("paragraph_split", r"""SELECT doc_id, len(ps) AS n, md5(array_to_string(ps, '|')) AS joined FROM (SELECT doc_id, list_filter(string_split(replace(text, '. ', chr(10) || chr(10)), chr(10) || chr(10)), lambda x: x <> '') AS ps FROM documents)""")
def paragraph_split(spark, sf_dir):
    parts = F.filter(F.split(F.replace("text", F.lit(". "), F.lit("\n\n")), "\n\n", -1), lambda x: x != "")
    return _docs(spark, sf_dir).select("doc_id", F.size(parts).cast("bigint").alias("n"), F.md5(F.array_join(parts, "|")).alias("joined"))


@query("positional_zip", r"""SELECT doc_id, len(ls) AS n, md5(array_to_string(list_transform(ls, lambda x, i: CASE WHEN i <= 2 THEN 'head' ELSE 'body' END || ':' || x), chr(10))) AS zipped FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)""")
def positional_zip(spark, sf_dir):
    """Texts with their classes by position; texts beyond the classes get the default."""
    lines, classes = F.split("text", "\n", -1), F.array(F.lit("head"), F.lit("head"))
    zipped = F.zip_with(F.slice(lines, 1, 2), F.slice(classes, F.lit(1), F.least(F.size(lines), F.lit(2))), lambda x, c: F.concat(c, F.lit(":"), x))
    rest = F.transform(F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0))), lambda x: F.concat(F.lit("body:"), x))
    return _docs(spark, sf_dir).select("doc_id", F.size(lines).cast("bigint").alias("n"), F.md5(F.array_join(F.concat(zipped, rest), "\n")).alias("zipped"))


@query("sha_bucket", """SELECT page_id, left(sha1(url), 2) AS bucket FROM pages""")
def sha_bucket(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", n.sha_bucket(F.col("url")).alias("bucket"))


@query("content_hashes", """SELECT doc_id, sha1('blob ' || octet_length(encode(text)) || chr(0) || text) AS blob, sha256(text) AS digest, sha1('p' || chr(31) || text || chr(30)) AS paragraph FROM documents""")
def content_hashes(spark, sf_dir):
    marked = F.concat(F.lit("p\x1f"), "text", F.lit("\x1e"))
    return _docs(spark, sf_dir).select("doc_id", n.blob_hash(F.col("text")).alias("blob"), F.sha2("text", 256).alias("digest"), F.sha1(marked.cast("binary")).alias("paragraph"))


@query("path_layout", """SELECT p_partkey AS id, 'es/' || lower(split_part(p_type, ' ', 1)) || '/' || left(sha1(CAST(p_partkey AS VARCHAR)), 2) || '/' || p_partkey || '.md' AS path FROM part""")
def path_layout(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    return views.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), n.path_of("es/{rank}/{bucket}/{id}.md", rank=F.lower(F.split_part("p_type", F.lit(" "), F.lit(1))), bucket=n.sha_bucket(key), id=key).alias("path"))


@query("manifest_lines", """SELECT n_nationkey AS id, printf('{"country": "%s", "region": %d, "layout": "%s/{id}.md"}', n_name, n_regionkey, lower(n_name)) AS line FROM nation""")
def manifest_lines(spark, sf_dir):
    return views.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.format_string('{"country": "%s", "region": %d, "layout": "%s/{id}.md"}', "n_name", "n_regionkey", F.lower("n_name")).alias("line"))


@query("envelope_round_trip")
def envelope_round_trip(spark, sf_dir):
    """A text in base64 inside JSON comes back as it went in."""
    envelope = F.to_json(F.struct(F.col("doc_id").alias("id"), F.base64(F.encode("text", "UTF-8")).alias("body")))
    rows = _docs(spark, sf_dir).select("doc_id", "text", F.from_json(envelope, "id bigint, body string").alias("e"))
    return rows.select("doc_id", (F.decode(F.unbase64("e.body"), "UTF-8") == F.col("text")).alias("same"))


@query("linear_interpolation", """WITH m AS (SELECT low, high, low_year, high_year FROM (VALUES (0, 5000, 1990, 1996), (5000, 12000, 1996, 2001), (12000, 100000000, 2001, 2010)) v(low, high, low_year, high_year))
SELECT o_orderkey AS id, CAST(floor(low_year + (high_year - low_year) * (o_orderkey - low) / (high - low)) AS INT) AS year FROM orders JOIN m ON o_orderkey >= low AND o_orderkey < high""")
def linear_interpolation(spark, sf_dir):
    """The year of a number between landmarks; three fixed landmarks are an expression, not a join."""
    marks = [(0, 5000, 1990, 1996), (5000, 12000, 1996, 2001), (12000, 100_000_000, 2001, 2010)]
    key, year = F.col("o_orderkey"), None
    for low, high, first, last in marks:
        value = F.floor(first + (last - first) * (key - low) / (high - low)).cast("int")
        test = (key >= low) & (key < high)
        year = F.when(test, value) if year is None else year.when(test, value)
    return _orders(spark, sf_dir).where((key >= 0) & (key < 100_000_000)).select(key.alias("id"), year.alias("year"))


@query("numeric_cells", r"""SELECT p_partkey AS id, cell, regexp_matches(cell, '^[+-]?[0-9][0-9 .,]*%?$') AS numeric FROM (SELECT p_partkey, unnest([p_name, CAST(p_size AS VARCHAR), p_size || '%', '1 000,5']) AS cell FROM part)""")
def numeric_cells(spark, sf_dir):
    cells = F.array("p_name", F.col("p_size").cast("string"), F.concat(F.col("p_size").cast("string"), F.lit("%")), F.lit("1 000,5"))
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.explode(cells).alias("cell")).withColumn("numeric", F.col("cell").rlike("^[+-]?[0-9][0-9 .,]*%?$"))
