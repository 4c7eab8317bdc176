"""Checks of what is published against what is known, each a row: severity, check, count and examples.

Every check is a plan of its own over the tables; they run side by side in one union, and only five
examples of each leave the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

EXAMPLES, TINY = 5, 50
REPORT = "severity string, finding string, n long, examples string"


def finding(severity: str, name: str, rows: DataFrame, key: Column | str) -> DataFrame:
    """A row if ``rows`` has any: their number and the first keys in order."""
    keys = rows.select((F.col(key) if isinstance(key, str) else key).cast("string").alias("key"))
    some = F.array_join(F.slice(F.array_sort(F.collect_set("key")), 1, EXAMPLES), ", ")
    few = keys.orderBy("key").limit(EXAMPLES).agg(some.alias("examples"))
    counted = keys.agg(F.count(F.lit(1)).alias("n"))
    return counted.join(F.broadcast(few), F.lit(True)).where("n > 0").select(F.lit(severity).alias("severity"), F.lit(name).alias("finding"), "n", "examples")


def report(files: DataFrame, data: DataFrame, events: DataFrame, discovered: DataFrame, excluded: DataFrame, today: str, path_of: Callable[[Column], Column] | None = None, fields: DataFrame | None = None, deep: bool = False) -> DataFrame:
    """The findings, errors first.

    ``files``: key, path, text, published (day); ``data``: key; ``events``: key, day, committed (day), source;
    ``discovered``: key; ``excluded``: key, reason, transient; ``fields``: field, seen, carried.  ``deep``
    reads the texts and fields as well.
    """
    day = F.lit(today).cast("date")
    there, known = files.select("key").distinct(), data.select("key").distinct()
    found = [
        finding("ERROR", "identifier claimed by more than one file", files.groupBy("key").agg(F.count_distinct("path").alias("c")).where("c > 1"), "key"),
        finding("ERROR", "data that never became a file", known.join(there, "key", "left_anti"), "key"),
        finding("ERROR", "file without data behind it", there.join(known, "key", "left_anti"), "key"),
        finding("ERROR", "discovered, neither published nor excluded", discovered.select("key").distinct().join(there, "key", "left_anti").join(excluded.select("key"), "key", "left_anti"), "key"),
        finding("ERROR", "excluded for a failure that may pass", excluded.where("transient"), "key"),
        finding("WARN", "excluded without a reason", excluded.where("reason = 'not fetched'"), "key"),
        finding("ERROR", "published and excluded at once", there.join(excluded.select("key"), "key", "left_semi"), "key"),
        finding("ERROR", "file without any event", there.join(events.select("key").distinct(), "key", "left_anti"), "key"),
        finding("ERROR", "event of a norm without a file", events.select("key").distinct().join(there, "key", "left_anti"), "key"),
        finding("WARN", "event with an epoch day", events.where(F.year("day") == 1970), "key"),
        finding("WARN", "event in the near future", events.where((F.col("day") > day) & (F.col("day") <= F.date_add(day, 365))), "key"),
        finding("ERROR", "event in the far future", events.where(F.col("day") > F.date_add(day, 365)), "key"),
        finding("ERROR", "event told twice", events.groupBy("key", "source", "day").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "key"),
    ]
    if path_of is not None:
        found.append(finding("ERROR", "file not where the layout says", files.where(F.col("path") != path_of(F.col("key"))), "path"))
    if deep:
        size = F.octet_length(F.coalesce("text", F.lit("")))
        found += [finding("ERROR", "empty file", files.where(F.trim(F.coalesce("text", F.lit(""))) == ""), "path"), finding("WARN", f"file under {TINY} bytes", files.where((size < TINY) & (F.trim("text") != "")), "path"),
                  finding("ERROR", "heading without a text", files.where(F.coalesce("text", F.lit("")).rlike(r"(?m)^#{1,6} [^\n]*\n*\z")), "path")]
        if fields is not None:
            lost = F.col("seen") - F.col("carried")
            found += [finding("ERROR", "field of the source that no file carries", fields.where((F.col("seen") > 0) & (lost / F.col("seen") > 0.9)), "field"), finding("WARN", "field of the source that some files lose", fields.where((F.col("seen") > 0) & (lost / F.col("seen") >= 0.01) & (lost / F.col("seen") <= 0.9)), "field")]
    out = found[0]
    for rows in found[1:]:
        out = out.unionAll(rows)
    return out
