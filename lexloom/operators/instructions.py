"""What an amending act orders: substitutions, insertions and repeals of articles of a named law.

The act is cut into its own articles, each of those into sentences of one order, and an order into its
verb, the articles that it names, the law and the wording after its colon.  All of it is split and
matched with column functions, so an act of any length stays in its row and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The verbs of the orders, as the gazettes print them.
VERBS = {
    "substitute": r"sustit[úu]yen?se|modif[íi]can?se",
    "insert": r"incorp[óo]ran?se|agr[ée]gan?se",
    "repeal": r"der[óo]gan?se",
}
_ARTICLE = r"\d+\s*[°º]?(?:\s*(?:bis|ter|qu[áa]ter))?"
_OWN = r"(?i)(?<![\"“«])(?=\bart(?:[íi]culo|\.)?\s*\d+\s*[°º.]?\s*[-–—])"
_ORDER = "(?i)(?=" + "|".join(rf"\b(?:{v})" for v in VERBS.values()) + ")"
_QUOTED = rf"(?i)(?=[\"“«]\s*art[íi]culo\s+{_ARTICLE}\s*[°º]?\s*[-–—:.])"


def _article(text: Column) -> Column:
    """Number and suffix alone: 8° BIS is 8 bis."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), "[°º]", " "), r"\s+", " "))


def law_number(text: Column) -> Column:
    """The digits of the first law that a text names."""
    return F.nullif(F.regexp_replace(F.regexp_extract(text, r"(?i)\bley\s+(?:n\s*[°ºro.]*\s*)?([\d.]*\d)", 1), r"\D", ""), F.lit(""))


def _kind(order: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, verb in VERBS.items():
        kind = F.when(order.rlike(rf"(?i)^\s*(?:{verb})"), name).otherwise(kind)
    return kind


def orders(acts: DataFrame, key: str = "act", text: str = "text", law: str | None = None) -> DataFrame:
    """(key, place, source_article, kind, law, article, wording), a row for each article that an order names.

    Articles are told apart by number and suffix.  An order for several articles gives each the quoted
    wording that begins with its own number; where there is none its kind is unknown, so that a reader
    can go back to the whole text.  With ``law`` only orders about that law are given.
    """
    blocks = acts.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), _OWN)).alias("block_at", "block"))
    parts = blocks.select(key, "block_at", F.nullif(F.regexp_extract("block", r"(?i)^\s*art(?:[íi]culo|\.)?\s*(\d+)", 1), F.lit("")).alias("source_article"), F.posexplode(F.split("block", _ORDER)).alias("order_at", "order"))
    told = parts.withColumn("kind", _kind(F.col("order"))).where("kind IS NOT NULL")
    head, wording = F.regexp_extract("order", r"(?s)^([^:]*)", 1), F.regexp_extract("order", r"(?s)^[^:]*:\s*(.*?)\s*$", 1)
    told = told.withColumns({"head": head, "wording": wording})
    named = F.regexp_extract("head", r"(?is)\bart[íi]culos?\s+(.*?)(?:\bde\s+la\b|\bpor\b|$)", 1)
    told = told.withColumn("law", law_number(F.col("head"))).withColumn("articles", F.transform(F.regexp_extract_all(named, F.lit(rf"(?i){_ARTICLE}"), 0), _article))
    if law is not None:
        told = told.where(F.col("law") == law)
    told = told.withColumn("quotes", F.split("wording", _QUOTED)).withColumn("several", F.size("articles") > 1)
    rows = told.select(key, "block_at", "order_at", "source_article", "kind", "law", "wording", "quotes", "several", F.posexplode("articles").alias("article_at", "article"))
    own = F.filter("quotes", lambda q: _article(F.regexp_extract(q, rf"(?i)^[\"“«]\s*art[íi]culo\s+({_ARTICLE})", 1)) == F.col("article"))
    bare = lambda q: F.trim(F.regexp_replace(F.regexp_replace(q, rf"(?i)^[\"“«]?\s*art[íi]culo\s+{_ARTICLE}\s*[°º]?\s*[-–—:.]+\s*", ""), r"[\"”»]\s*[.;]?\s*$", ""))
    lost = F.col("several") & (F.size(own) == 0) & (F.col("kind") != "repeal")
    text_of = F.when(F.col("kind") == "repeal", "").when(lost, "").when(F.col("several"), bare(F.get(own, F.lit(0)))).otherwise(bare(F.col("wording")))
    place = F.struct("block_at", "order_at", "article_at")
    return rows.select(key, place.alias("place"), "source_article", F.when(lost, "unknown").otherwise(F.col("kind")).alias("kind"), "law", "article", text_of.alias("wording"))
