"""Ledgers of what failed and what is left out, as append-only tables in the shared folder.

Each entry is a row with its day and a running number of the write; the newest entry of a key counts, so
writing again after a crash changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

FAILURES = "key string, reason string, transient boolean, cleared boolean, at date, n long"
#: What an answer's status says about another try: not of what a source does not have.
FINAL_STATUS = (404, 410)
#: The longest reason that is kept.
LONGEST = 500


class Failures:
    """Dead letters by key: recorded when a key fails, cleared when it succeeds."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        there = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
        return self.spark.read.schema(FAILURES).parquet(self.path) if there else self.spark.createDataFrame([], FAILURES)

    def _write(self, rows: DataFrame) -> None:
        n = (self.entries().agg(F.max("n")).first()[0] or 0) + 1
        rows.select("key", "reason", "transient", "cleared", "at", F.lit(n).cast("long").alias("n")).write.mode("append").parquet(self.path)

    def record(self, failed: DataFrame, at: str) -> None:
        """``failed``: key, reason, and status (null where no answer came)."""
        transient = F.col("status").isNull() | ~F.col("status").isin(*FINAL_STATUS)
        self._write(failed.select(F.col("key").cast("string").alias("key"), F.left("reason", F.lit(LONGEST)).alias("reason"), transient.alias("transient"), F.lit(False).alias("cleared"), F.lit(at).cast("date").alias("at")))

    def clear(self, keys: DataFrame, at: str) -> None:
        """``keys``: key; only those with an open failure get an entry."""
        open_ = self.current().select("key")
        self._write(keys.select(F.col("key").cast("string").alias("key")).distinct().join(open_, "key", "left_semi").select("key", F.lit(None).cast("string").alias("reason"), F.lit(False).alias("transient"), F.lit(True).alias("cleared"), F.lit(at).cast("date").alias("at")))

    def current(self) -> DataFrame:
        """key, reason, transient, at of the failures that no success has cleared."""
        newest = self.entries().groupBy("key").agg(F.max_by(F.struct("reason", "transient", "cleared", "at"), F.struct("n", "at")).alias("e"))
        return newest.where("NOT e.cleared").select("key", "e.reason", "e.transient", "e.at")

    def unresolved(self, keys: DataFrame) -> DataFrame:
        """Of ``keys`` those that another try may settle: network trouble, or no recorded reason."""
        known = self.current().select(F.col("key"), "transient")
        wanted = keys.select(F.col("key").cast("string").alias("key")).distinct()
        return wanted.join(known, "key", "left").where(F.coalesce("transient", F.lit(True))).select("key")


def coverage(discovered: DataFrame, published: DataFrame, failures: DataFrame, exclusions: DataFrame) -> DataFrame:
    """key, reason, transient of every discovered key that is not published, a row each.

    A stated exclusion comes before a failure, a failure before "not fetched".
    """
    left = discovered.select(F.col("key").cast("string").alias("key")).distinct().join(published.select(F.col("key").cast("string").alias("key")), "key", "left_anti")
    stated = exclusions.groupBy(F.col("key").cast("string").alias("key")).agg(F.min("reason").alias("stated"))
    found = left.join(stated, "key", "left").join(failures.select("key", F.col("reason").alias("failed"), "transient"), "key", "left")
    transient = F.col("stated").isNull() & F.coalesce("transient", F.lit(False))
    return found.select("key", F.coalesce("stated", "failed", F.lit("not fetched")).alias("reason"), transient.alias("transient"))
