"""Reconciling what a source states with what has been published: counted differences, guards, change capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def multiset_new(expected: DataFrame, published: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows of ``expected`` beyond as many of each key as are published already, first ones first."""
    counts = published.groupBy(*keys).agg(F.count(F.lit(1)).alias("_have"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return expected.withColumn("_n", place).join(counts, keys, "left").where(F.col("_n") > F.coalesce("_have", F.lit(0))).drop("_n", "_have")


def changed(new: DataFrame, old: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys that are new or whose value differs, with a label; removals are not reported."""
    before = old.select(*keys, F.col(value).alias("_old"), F.lit(True).alias("_had"))
    joined = new.join(before, keys, "left")
    label = F.when(F.col("_had").isNull(), "added").when(~F.col(value).eqNullSafe(F.col("_old")), "changed")
    return joined.withColumn("change", label).where("change IS NOT NULL").select(*keys, "change")


def clash_names(rows: DataFrame, name: str, owner: str, arrival: str, day: Column) -> DataFrame:
    """The file name of each owner: the first keeps it, the second adds its date, later ones a hash."""
    first = rows.groupBy(name, owner).agg(F.min(arrival).alias("_at"), F.min(day).alias("_day"))
    rank = F.row_number().over(Window.partitionBy(name).orderBy("_at", owner))
    suffix = F.when(F.col("_rank") == 1, "").when(F.col("_rank") == 2, F.concat(F.lit("-"), F.date_format("_day", "yyyyMMdd"))).otherwise(F.concat(F.lit("-"), F.left(F.sha1(F.col(owner).cast("string").cast("binary")), F.lit(8))))
    return first.withColumn("_rank", rank).select(name, owner, F.concat(F.col(name).cast("string"), suffix).alias("stored_as"))
