"""Writers of structured documents and change logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def structured(norms: DataFrame, versions: DataFrame) -> DataFrame:
    """(norm, json): each document with its blocks and their versions nested in order; unknown fields left out."""
    chain = F.array_sort(F.collect_list(F.struct("src", F.date_format("pub", "yyyy-MM-dd").alias("pub"), F.date_format("eff", "yyyy-MM-dd").alias("eff"), "txt")))
    blocks = versions.groupBy("norm", "block").agg(chain.alias("versions"))
    docs = blocks.groupBy("norm").agg(F.array_sort(F.collect_list(F.struct("block", "versions"))).alias("blocks"))
    return norms.join(docs, "norm").select("norm", F.to_json(F.struct("norm", "title", "rank", "blocks")).alias("json"))


DOCUMENT = "norm bigint, title string, rank string, blocks array<struct<block: int, versions: array<struct<src: bigint, pub: string, eff: string, txt: string>>>>"


def read_structured(texts: DataFrame) -> DataFrame:
    """Version rows of documents; fields that older documents lack are null."""
    parsed = texts.select(F.from_json("value", DOCUMENT).alias("d")).where("d IS NOT NULL").select("d.norm", F.explode("d.blocks").alias("b"))
    return parsed.select("norm", "b.block", F.explode("b.versions").alias("v")).select("norm", "block", "v.src", "v.pub", "v.eff", "v.txt")


def guarded(new: DataFrame, current: DataFrame, key: str, content: str, day: str, exempt: Column) -> DataFrame:
    """What writing each document would do: write, leave unchanged, or refuse another act under the same key."""
    old = current.select(F.col(key), F.col(content).alias("_old"), F.col(day).alias("_day"))
    joined = new.join(old, key, "left")
    outcome = (F.when(F.col("_old").isNull(), "write").when(F.col("_old") == F.col(content), "unchanged")
               .when((F.col("_day") != F.col(day)) & ~exempt, "refused").otherwise("write"))
    return joined.withColumn("outcome", outcome).drop("_old", "_day")


def keeping_day(new: Column, old: Column, new_day: Column, old_day: Column) -> Column:
    """A report's day stays as it was where nothing else in the report changed."""
    return F.when(new.eqNullSafe(old), old_day).otherwise(new_day)
