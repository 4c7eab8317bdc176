"""Named queries on the documents of each registered source.

The test tables hold no laws, so each document is a source's sample with the values of a part put in:
its texts, its title, and the days on which it is published and changed.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lexloom import views
from lexloom.plans.catalogue import query
from lexloom.sources import layouts
from lexloom.sources.layout_table import LAYOUTS, SAMPLES

#: What stands for each mark: as a Spark expression and in DuckDB.
_DATES = {"{}": ("yyyy-MM-dd", "%Y-%m-%d"), "{}8": ("yyyyMMdd", "%Y%m%d"), "{}dot": ("dd.MM.yyyy", "%d.%m.%Y"), "{}slash": ("dd/MM/yyyy", "%d/%m/%Y"), "{}mdy": ("MM/dd/yyyy", "%m/%d/%Y")}
MARKS = {
    "id": ("CAST(p_partkey AS STRING)", "CAST(p_partkey AS VARCHAR)"),
    "title": ("p_name", "p_name"),
    "one": ("concat(p_type, ' of the first')", "p_type || ' of the first'"),
    "two": ("concat(p_brand, ' of the second')", "p_brand || ' of the second'"),
    "later": ("concat(p_type, ' as changed by ', p_partkey)", "p_type || ' as changed by ' || p_partkey"),
} | {
    form.format(name): (f"date_format(date_add(DATE '{start}', p_size), '{spark}')", f"strftime(DATE '{start}' + p_size, '{duck}')")
    for name, start in (("day", "1990-01-01"), ("next", "1992-06-15")) for form, (spark, duck) in _DATES.items()
}
COLUMNS = ("unit", "kind", "heading", "src", "eff", "text")


def documents(spark, sf_dir: str, code: str):
    """(norm, content): the sample of a source for every part, in the bytes of its encoding."""
    text = F.lit(SAMPLES[code].text)
    for mark, (expression, _) in MARKS.items():
        if "{" + mark + "}" in SAMPLES[code].text:
            text = F.replace(text, F.lit("{" + mark + "}"), F.expr(expression))
    latin = LAYOUTS[code].encoding in ("iso-8859-1", "windows-1252")
    part = views.table(spark, sf_dir, "part").repartition(4 * spark.sparkContext.defaultParallelism, "p_partkey")  # a small file whose documents are large: dealt to all cores before they are made
    return part.select(F.col("p_partkey").cast("string").alias("norm"), F.encode(text, "ISO-8859-1" if latin else "UTF-8").alias("content"))


def _sql(text: str | None) -> str:
    """A row's value, with its marks, as SQL."""
    if text is None:
        return "CAST(NULL AS VARCHAR)"
    parts = [x for x in re.split(r"(\{\w+\})", text) if x]
    quoted = lambda x: " || chr(10) || ".join("'" + y.replace("'", "''") + "'" for y in x.split("\n"))
    return " || ".join(f"({MARKS[x[1:-1]][1]})" if x[0] == "{" and x[1:-1] in MARKS else quoted(x) for x in parts) or "''"


def oracle(code: str) -> str:
    sample = SAMPLES[code]
    rows = [", ".join(f"{_sql(value)} AS {name}" for name, value in zip(COLUMNS, row, strict=True)) for row in sample.rows]
    return " UNION ALL ".join(f"SELECT CAST(p_partkey AS VARCHAR) AS norm, {row}, '{sample.rank}' AS rank, '{sample.status}' AS status FROM part" for row in rows)


def _register(code: str) -> None:
    @query(f"source_{code}", oracle(code))
    def read(spark, sf_dir):
        return layouts.read(documents(spark, sf_dir, code), LAYOUTS[code]).select("norm", *COLUMNS, "rank", "status")


for _code in LAYOUTS:
    _register(_code)
