"""Exact dedup, with DataFrame functions only.

Rows are grouped by a 128-bit content hash; a first aggregation counts the rows of each hash, so that
only texts whose hash is found twice are compared at all (``marks.py`` tells them apart while they are
read).  Those are grouped by the hash together with the normalised text itself: the hash spreads them,
and the grouping compares whole texts byte by byte, so texts whose hashes collide stay apart.  Copies
meet in the map-side part of the aggregation first; a group of any size leaves one row per task.  Each
row then looks up its group by the hash and a second, 256-bit one; only ids and hashes move for that,
and only groups of two or more rows are looked up.  A hot group is one key of a sort-merge join of
plain exchanges, which AQE splits.

Defined results: a null text counts as empty; texts of any length are compared whole; of the rows of a
group one is kept, that with the smallest id, and of rows that repeat this id and text one as well; null
ids come last, and keep_id is null only where every id of the group is; ids keep their type; an empty
table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.llm import store
from lexloom.llm.marks import Marks

SPACES = "[\\x20\\x09-\\x0D]+"


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, " ")
    texts = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"))
    hashed = F.unhex(F.md5(F.col("norm").cast("binary")))
    rows = store.materialise(texts.select("doc_id", hashed.alias("hash"), F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha")), "hashes")
    found_twice = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    compared = Marks(found_twice, "hash").tested(texts.withColumn("hash", hashed), "hash", "_marked").where("_marked")
    groups = (compared.groupBy("hash", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .where("group_size > 1").select(F.col("hash").alias("of"), F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("own"), "keep_id", "group_size"))
    repeats = rows.groupBy("doc_id", "hash", "sha").agg(F.count(F.lit(1)).alias("times"))
    found = repeats.join(groups, (F.col("hash") == F.col("of")) & (F.col("sha") == F.col("own")), "left").withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    kept = F.col("doc_id").eqNullSafe(keep) & (F.col("time") == 1)
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""
