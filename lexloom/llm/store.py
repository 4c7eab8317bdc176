"""Tables that the driver and all executors share, and small helpers for Arrow batches.

Everything that outlives a stage is written below ``spark.checkpoint.dir``, the folder that a
cluster shares; a temporary folder is made only where the session names none (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), _ROOT]))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session, as a URI."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexloom-shared-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found if "://" in found or found.startswith("file:") else "file://" + found


#: Paths handed out in this process, in order.
_handed: list[str] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    _handed.append(f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _handed[-1]


def mark() -> int:
    """Where the list of paths stands, for ``discard``."""
    return len(_handed)


def discard(spark: SparkSession, since: int, keep: str | None = None) -> None:
    """Delete what was written below paths handed out since the mark, but for ``keep``.

    For a caller that has written its result: frames that still read these tables end there.
    """
    gone, _handed[since:] = [x for x in _handed[since:] if x != keep], [x for x in _handed[since:] if x == keep]
    for path in gone:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def materialise(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a shared Parquet table and read it back: this cuts its lineage."""
    return df.sparkSession.read.schema(df.schema).parquet(write_shared(df, label, partition_by))


def write_shared(df: DataFrame, label: str, partition_by: str | None = None) -> str:
    path = fresh_path(df.sparkSession, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return path


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """What a worker opens a shared path with."""
    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def data_files(uri: str) -> list[str]:
    """The data files of a written table, sorted by name."""
    fs, path = file_system(uri)
    found = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
    names = [x.path for x in found if x.is_file and x.size]
    return sorted(x for x in names if os.path.basename(x).startswith("part-"))


def read_table(uri: str, columns: list[str] | None = None) -> pa.Table:
    import pyarrow.dataset as pads  # brings pandas, which the processes that plan a data source need not hold

    fs, _ = file_system(uri)
    return pads.dataset(data_files(uri), filesystem=fs, format="parquet").to_table(columns=columns)


def blocks(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``most_bytes`` at most, or one row."""
    for batch in batches:
        ends = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
        start, held = 0, 0
        for i, n in enumerate(ends.to_pylist()):
            if held and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns an operator is about to add; its own ones win over clashing names."""
    taken = {x.lower() for x in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])
