"""Micro-batch runs over a feed of dated events.

A run takes everything the source has (``availableNow``), hands each micro-batch to an idempotent
writer and leaves its progress in a checkpoint in the shared folder, so a rerun or a restart after
a crash emits nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lexloom.session import scratch


def feed(spark: SparkSession, path: str, schema, files_per_batch: int = 8) -> DataFrame:
    """A folder of Parquet files as a stream, so many files a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def by_day(events: DataFrame, label: str, parts: int = 4) -> str:
    """Write a feed as it would arrive: the files of one ``feed_day`` (0 to parts - 1) after those of another."""
    path = scratch(events.sparkSession, label)
    for part in range(parts):
        events.where(F.col("feed_day") == part).write.mode("append").parquet(path)
    return path


def run(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


class Sink:
    """A table that takes a key once: a batch replayed, or a key read again, adds nothing.

    The table is partitioned by ``day``, which is part of the key, and a batch is compared with the
    partitions of its own days only.
    """

    def __init__(self, spark: SparkSession, schema, keys: list[str], label: str, day: str):
        self.spark, self.schema, self.keys, self.day = spark, schema, keys, day
        self.path = scratch(spark, label)
        spark.createDataFrame([], schema).write.partitionBy(day).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """New keys of a batch; the anti join sees the table as it was before."""
        days = [r[0] for r in batch.select(self.day).distinct().collect()]  # the days of one micro-batch
        held = self.read().where(F.col(self.day).isin(days)).select(*self.keys)
        new = batch.dropDuplicates(self.keys).join(held, self.keys, "left_anti")
        new.select(*[f.name for f in self.schema]).write.mode("append").partitionBy(self.day).parquet(self.path)


PENDING = "norm long, failures long, last_day string, pending boolean"


def pending_state(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Failures of a key since its last success, kept between micro-batches and looked at again in each.

    Rows of one day may come in any order; a day with a failure and a success counts by the later id.
    """
    failures, last = state.get if state.exists else (0, "")
    rows = pd.concat(list(batches)).sort_values("id")
    for row in rows.itertuples():
        failures = failures + 1 if row.kind == "error" else 0 if row.kind == "purchase" else failures
        last = max(last, str(row.day))
    state.update((failures, last))
    yield pd.DataFrame({"norm": [key[0]], "failures": [failures], "last_day": [last], "pending": [failures > 0]})


def pending(stream: DataFrame) -> DataFrame:
    return stream.groupBy("norm").applyInPandasWithState(pending_state, PENDING, "failures long, last string", "update", GroupStateTimeout.NoTimeout)


def upsert(path: str, batch: DataFrame, batch_id: int) -> None:
    """Append a batch with its number; the newest row of a key counts when read."""
    batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(path)
