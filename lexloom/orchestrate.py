"""Long runs of steps, one after the other, with second tries, an end time and a record of what was done.

The record is a table in the shared folder: a run that is started again passes over the steps that it says
are done, so a run can be cut off anywhere.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession, functions as F

RECORD = "run string, place int, step string, outcome string, tries int, reason string"


@dataclass(frozen=True)
class Step:
    """A name, what to do, and whether the run goes on without it."""

    name: str
    do: Callable[[], object]
    needed: bool = True


def overnight(spark: SparkSession, path: str, run: str, steps: list[Step], clock: Callable[[], float], until: float, tries: int = 2) -> list[tuple[str, str]]:
    """(step, outcome) of each: done, before (by an earlier start), failed, skipped or late.

    A step that fails is tried again; one that is needed and fails for good ends the run, and the steps after
    it are skipped.  No step begins after ``until``.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    held = spark.read.schema(RECORD).parquet(path) if there else spark.createDataFrame([], RECORD)
    before = {r["step"] for r in held.where((F.col("run") == run) & (F.col("outcome") == "done")).select("step").distinct().collect()}
    out, ended = [], False
    for place, step in enumerate(steps):
        outcome, reason, tried = "before", None, 0
        if step.name not in before:
            outcome = "skipped" if ended else "late" if clock() > until else "failed"
            while outcome == "failed" and tried < tries:
                tried += 1
                try:
                    step.do()
                    outcome = "done"
                except Exception as wrong:  # recorded, and tried again
                    reason = f"{type(wrong).__name__}: {wrong}"
            ended = ended or outcome == "failed" and step.needed
            spark.createDataFrame([(run, place, step.name, outcome, tried, reason)], RECORD).write.mode("append").parquet(path)
        out.append((step.name, outcome))
    return out
