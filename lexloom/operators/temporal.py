"""Point-in-time operators over bitemporal version chains.

A version applies from its effective date, or from its publication where that is unknown.  Among
the versions that apply on a day the one that applies latest is in force, then the one published
latest, then the one that comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

def in_force() -> Column:
    return F.coalesce("eff", "pub")


KEY = ("norm", "block")
_PAYLOAD = ("src", "pub", "eff", "txt")


def latest(rows: DataFrame, keys: tuple[str, ...], payload: tuple[str, ...] = _PAYLOAD) -> DataFrame:
    """The version in force of each key: one partially aggregated pass, no sort of whole chains."""
    order = F.struct(in_force().alias("f"), F.col("pub").alias("p"), (-F.col("src")).alias("s"))
    best = F.max_by(F.struct(*payload), order)
    return rows.groupBy(*keys).agg(best.alias("best")).select(*keys, *[f"best.{c}" for c in payload])


def live_at(day: Column) -> Column:
    """May the version be read on ``day``: in force by then, not superseded, its block not expired before."""
    expired_before = F.col("expiry").isNotNull() & (F.col("expiry") <= day) & (in_force() < F.col("expiry"))
    return (in_force() <= day) & ~F.col("superseded") & ~expired_before


def as_of(versions: DataFrame, day: Column, keys: tuple[str, ...] = KEY) -> DataFrame:
    return latest(versions.where(in_force() <= day), keys)


def as_of_strict(versions: DataFrame, day: Column) -> DataFrame:
    """As-of with block expiry and versions superseded before they began."""
    return latest(versions.where(live_at(day)), KEY)


def as_of_or_first(versions: DataFrame, day: Column, keys: tuple[str, ...]) -> DataFrame:
    """The version in force on ``day``, else the earliest one."""
    order = F.struct(in_force().alias("f"), F.col("pub").alias("p"), (-F.col("src")).alias("s"))
    first = F.struct(in_force().alias("f"), F.col("pub").alias("p"), F.col("src").alias("s"))
    both = versions.groupBy(*keys).agg(
        F.max_by("src", F.when(in_force() <= day, order)).alias("now"), F.min_by("src", first).alias("earliest"))
    return both.select(*keys, F.coalesce("now", "earliest").alias("src"), F.col("now").isNull().alias("fallback"))


def fallback_document(versions: DataFrame, day: Column) -> DataFrame:
    """As-of per block; a norm with no block in force shows the earliest version of every block."""
    chosen = as_of_or_first(versions, day, KEY)
    none = F.min(F.col("fallback").cast("int")).over(Window.partitionBy("norm")) == 1
    return chosen.withColumn("bare", none).where("bare OR NOT fallback").select("norm", "block", "src", "bare")


def exact_override(versions: DataFrame, events: DataFrame) -> DataFrame:
    """For each (norm, src, day): the block text that the event itself brings wins over the as-of one."""
    order = F.struct(in_force().alias("f"), F.col("pub").alias("p"), (-F.col("v_src")).alias("s"))
    joined = events.join(versions.withColumnRenamed("src", "v_src"), "norm").where(in_force() <= F.col("day"))
    exact = F.when((F.col("v_src") == F.col("src")) & ((F.col("eff") == F.col("day")) | (F.col("pub") == F.col("day"))), order)
    best = joined.groupBy("norm", "src", "day", "block").agg(F.max_by("v_src", exact).alias("own"), F.max_by("v_src", order).alias("asof"))
    return best.select("norm", "src", "day", "block", F.coalesce("own", "asof").alias("shown"), F.col("own").isNotNull().alias("exact"))


def intervals(versions: DataFrame) -> DataFrame:
    """Versions with the half-open span in which each is the one in force; empty spans are gone."""
    chain = Window.partitionBy(*KEY).orderBy(in_force(), "pub", F.desc("src"))
    spans = versions.withColumn("starts", in_force()).withColumn("ends", F.lead(in_force()).over(chain))
    return spans.where("ends IS NULL OR ends > starts")


def events_of(versions: DataFrame) -> DataFrame:
    """norm, seq, day: the days on which some version of the norm comes into force."""
    days = versions.select("norm", in_force().alias("day")).distinct()
    return days.withColumn("seq", F.row_number().over(Window.partitionBy("norm").orderBy("day")).cast("bigint"))


def history(versions: DataFrame) -> DataFrame:
    """norm, seq, day, n_blocks, content: every document as it stood at each of its events.

    A version is in force from the event that brings it to the one before its successor's, so it is
    listed under the numbers of those events; no event is compared with any version.  Versions and
    events meet in partitions of the norm, dealt out once.
    """
    own = Window.partitionBy("norm").orderBy(in_force())
    numbered = versions.select("norm", "block", "txt", "qty", "pub", "src", in_force().alias("day"), F.dense_rank().over(own).cast("bigint").alias("seq"))
    numbered = numbered.withColumn("last", F.max("seq").over(Window.partitionBy("norm")))
    chain = Window.partitionBy(*KEY).orderBy("seq", "pub", F.desc("src"))
    spans = numbered.withColumn("next", F.lead("seq").over(chain)).where("next IS NULL OR next > seq")
    at = spans.select("norm", "block", "txt", "qty", F.explode(F.sequence("seq", F.coalesce("next", F.col("last") + 1) - 1)).alias("seq"))
    parts = F.array_sort(F.collect_list(F.struct("block", "txt", "qty")))
    text = F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["block"], x["txt"], x["qty"])), "\n")
    states = at.groupBy("norm", "seq").agg(F.count(F.lit(1)).alias("n_blocks"), F.md5(text).alias("content"))
    return states.join(events_of(versions), ["norm", "seq"]).select("norm", "seq", "day", "n_blocks", "content")


def timeline(versions: DataFrame, *by: str) -> DataFrame:
    """Versions grouped into events by the given columns, their blocks in order, repeats kept."""
    blocks = F.transform(F.array_sort(F.collect_list(F.struct("block", "src"))), lambda x: x["block"].cast("string"))
    return versions.groupBy("norm", *by).agg(F.array_join(blocks, ",").alias("blocks"), F.count(F.lit(1)).alias("n"))


def staged_timeline(versions: DataFrame) -> DataFrame:
    """Events by publication, source and effective date, in the order in which they apply."""
    grouped = versions.groupBy("norm", "pub", "src", "eff").agg(
        F.array_join(F.transform(F.array_sort(F.collect_set("block")), lambda x: x.cast("string")), ",").alias("blocks"), F.bool_or("superseded").alias("noted"))
    starts = F.coalesce("eff", "pub")
    order = Window.partitionBy("norm").orderBy(F.greatest("pub", starts), "pub", "src", starts)
    return grouped.withColumn("seq", F.row_number().over(order).cast("bigint"))
