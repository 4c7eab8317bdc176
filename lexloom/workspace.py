"""A history kept in a folder: documents as fetched, their unit versions, the event log, files, ledgers.

Each command reads and writes tables of the folder.  Documents and units are partitioned by a bucket of
their key, so a command on named keys reads and rewrites the buckets that hold them and leaves the others
alone.  Events are appended in chunks in the order of the log; a chunk appears as a whole or not at all, and
a run that is started again goes on behind the last whole one.  Small chunks share a file, so a log has as
many files as its events need, whatever the size of a chunk.  What is written already is known by its keys
(norm, source, day), so no command repeats an event.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexloom.operators import health
from lexloom.session import materialise
from lexloom.sources import layouts
from lexloom.sources.layout_table import LAYOUTS
from lexloom.sources.layouts import Layout
from lexloom.sources.ledger import Failures, coverage

BUCKETS = 64
#: Events of a segment of the log: as many whole chunks as make about this many, one at least.
SEGMENT_EVENTS = 100_000
DOCUMENTS = "norm string, content binary, fetched date, bucket int"
UNITS = layouts.ROWS + ", bucket int"
EVENTS = "n long, norm string, src string, day date, kind string, subject string, units string, content string, chunk long"
FILES = "norm string, path string, text string, published date, bucket int"
EVENT_COLUMNS = [x.split()[0] for x in EVENTS.split(", ")]
EVENT_KEY = ["norm", "src", "day"]
EPOCH = "1970-01-02"


def bucket(key="norm"):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


@dataclass
class Workspace:
    spark: SparkSession
    path: str
    code: str
    chunk_events: int = 25_000
    slice_events: int = 2_000

    @property
    def layout(self) -> Layout:
        return LAYOUTS[self.code]

    def _at(self, name: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _has(self, name: str) -> bool:
        fs, at = self._at(name)
        return fs.exists(at)

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if self._has(name) else self.spark.createDataFrame([], schema)

    def documents(self) -> DataFrame:
        return self._table("documents", DOCUMENTS)

    def units(self) -> DataFrame:
        return self._table("units", UNITS)

    def events(self) -> DataFrame:
        return self._log().drop("segment")

    def _log(self) -> DataFrame:
        """The events, each with the folder that holds its chunk."""
        return self._table("events", f"{EVENTS}, segment long")

    def files(self) -> DataFrame:
        return self._table("files", FILES)

    @property
    def failures(self) -> Failures:
        return Failures(self.spark, f"{self.path}/failures")

    def _replace(self, name: str, schema: str, rows: DataFrame) -> None:
        """Rows of whole buckets take the place of what those buckets held; they may be read from there, as all are written before the old ones go."""
        names = [x.split()[0] for x in schema.split(", ")]
        rows.select(names).repartition("bucket").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}")

    def _touched(self, name: str, schema: str, keys: DataFrame) -> DataFrame:
        """The rows of a table in the buckets of ``keys``; the others are not read."""
        return self._table(name, schema).where(F.col("bucket").isin([r[0] for r in keys.select("bucket").distinct().collect()]))  # BUCKETS rows at most

    def _merged(self, name: str, schema: str, new: DataFrame, keys: DataFrame) -> DataFrame:
        """The touched buckets of a table: its rows without ``keys``, and ``new``; the old ones first where a bucket is left empty."""
        if not self._has(name):
            return new
        return self._touched(name, schema, keys).join(keys.select("norm"), "norm", "left_anti").unionByName(new, allowMissingColumns=True)

    # Commands.

    def fetch(self, source: DataFrame, day: str, keys: list[str] | None = None, force: bool = False, offset: int = 0, limit: int | None = None) -> int:
        """Take documents (norm, content; null content is a failure with its reason and status) into the workspace.

        Keys that are there stay unless ``force``; ``keys``, or a slice of the keys in their order, narrow the
        work.  Failures go to the ledger, successes clear it.  The number of documents taken.
        """
        wanted = source.where("norm IS NOT NULL")
        if keys is not None:
            wanted = wanted.where(F.col("norm").isin(keys))
        if offset or limit is not None:
            part = wanted.select("norm").distinct().orderBy("norm").offset(offset)
            wanted = wanted.join(part if limit is None else part.limit(limit), "norm", "left_semi")
        if not force and self._has("documents"):
            wanted = wanted.join(self.documents().select("norm"), "norm", "left_anti")
        got = materialise(wanted, "fetched")
        failed = got.where("content IS NULL")
        if not failed.isEmpty():
            reason = F.col("reason") if "reason" in got.columns else F.lit("no content")
            status = F.col("status") if "status" in got.columns else F.lit(None).cast("int")
            self.failures.record(failed.select(F.col("norm").alias("key"), reason.alias("reason"), status.alias("status")), day)
        new = got.where("content IS NOT NULL").select("norm", F.col("content").cast("binary").alias("content"), F.lit(day).cast("date").alias("fetched"), bucket().alias("bucket"))
        taken = new.count()
        if taken:
            self._replace("documents", DOCUMENTS, self._merged("documents", DOCUMENTS, new, new.select("norm", "bucket")))
            if self._has("failures"):
                self.failures.clear(new.select(F.col("norm").alias("key")), day)
            self._parse(new)
        return taken

    def _parse(self, docs: DataFrame) -> None:
        rows = layouts.read(docs, self.layout).withColumn("bucket", bucket())
        keys = docs.select("norm", "bucket").distinct()
        self._replace("units", UNITS, self._merged("units", UNITS, rows, keys))

    def _named(self, keys: list[str]):
        """The condition that a row of a table in buckets belongs to one of some keys; it names their buckets too."""
        at = self.spark.createDataFrame([(x,) for x in keys], "norm string").select(bucket().alias("bucket")).distinct().collect()
        return F.col("bucket").isin([r[0] for r in at]) & F.col("norm").isin(keys)

    def expected(self, keys: list[str] | None = None) -> DataFrame:
        """The events that the units (of some keys) tell: one for each norm, source and day, in the order of the log.

        The first event of a norm is its bootstrap.  Its day is when it takes effect, not before the second
        day of 1970; ``content`` is a digest of the units that the event changes.
        """
        rows = self.units() if keys is None else self.units().where(self._named(keys))
        rows = rows.where("unit IS NOT NULL AND eff IS NOT NULL").repartition("norm")  # serves the events and their order in a norm
        listed = F.array_sort(F.collect_list(F.struct("unit", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))))
        day = F.greatest(F.to_date("eff"), F.lit(EPOCH).cast("date"))
        found = rows.groupBy("norm", F.coalesce("src", "norm").alias("src"), day.alias("day")).agg(listed.alias("changed"))
        first = F.row_number().over(Window.partitionBy("norm").orderBy("day", "src")) == 1
        kind = F.when(first, "bootstrap").otherwise("reform")
        names = F.array_distinct(F.transform("changed", lambda x: x["unit"]))
        subject = F.concat(F.lit("["), kind, F.lit("] "), F.col("norm"), F.when(~first, F.concat(F.lit(" — "), F.when(F.size(names) <= 4, F.array_join(names, ", ")).otherwise(F.concat(F.array_join(F.slice(names, 1, 3), ", "), F.lit(" and "), (F.size(names) - 3).cast("string"), F.lit(" more"))))).otherwise(""))
        content = F.md5(F.array_join(F.transform("changed", lambda x: F.concat_ws("=", x["unit"], x["digest"])), ";").cast("binary"))
        return found.select("norm", "src", "day", kind.alias("kind"), subject.alias("subject"), F.array_join(names, ",").alias("units"), content.alias("content"))

    def commit(self, dry_run: bool = False, fresh: bool = False, until: str | None = None, write: Callable[[DataFrame, int], None] | None = None, keys: list[str] | None = None) -> DataFrame:
        """Append the events that the log lacks, in order of day, norm and source; those that would be, if ``dry_run``.

        ``fresh`` begins the log anew; ``keys`` narrows the work to the events of some norms.  All chunks are
        written beside the log and then renamed into it in their order, a segment of whole chunks at a time; a
        run that dies leaves a prefix, behind which the next one goes on.  ``write`` is given each chunk and its
        number first, so another log can follow this one; the chunks are then renamed one by one.
        """
        from lexloom.plans.order import numbered

        fs, log = self._at("events")
        if fresh and not dry_run:
            fs.delete(log, True)
        new, start = self.expected(keys), 0
        if not fresh and self._has("events"):
            have = self.events()
            start = have.agg(F.max("n")).first()[0] or 0
            have = have if keys is None else have.where(F.col("norm").isin(keys))
            new = new.join(have.select(*EVENT_KEY), EVENT_KEY, "left_anti")  # a key is expected once
        if until is not None:
            new = new.where(F.col("day") <= F.lit(until).cast("date"))
        chunk = F.expr(f"(n - 1) div {self.chunk_events}")
        rows = numbered(new, "day", "norm", "src").withColumn("n", F.col("n") + start).withColumn("chunk", chunk).select(*EVENT_COLUMNS)
        if dry_run:
            return materialise(rows, "events")
        parts, each = f"_parts/{start}", 1 if write is not None else self._segment_chunks
        placed = rows.withColumn("part", F.expr(f"chunk div {each}"))
        placed.repartition("part").sortWithinPartitions("part", "n").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/{parts}")
        written = self.spark.read.schema(EVENTS).parquet(f"{self.path}/{parts}")
        total = written.count()
        for at in range(start // self.chunk_events // each, -(-(start + total) // (self.chunk_events * each))) if total else ():
            if write is not None:
                write(self.spark.read.schema(EVENTS).parquet(f"{self.path}/{parts}/part={at}"), at)
            self._append(f"{parts}/part={at}", at * each // self._segment_chunks, f"{at:012d}-{start:012d}")
        appended = self.events().where(F.col("n").between(start + 1, start + total))
        if total:
            self._render(appended.select("norm").distinct())
        return appended

    @property
    def _segment_chunks(self) -> int:
        return max(1, SEGMENT_EVENTS // self.chunk_events)

    def _append(self, part: str, number: int, name: str) -> None:
        """Rename a written part into the log, or its file into the segment that is there."""
        fs, segment = self._at(f"events/segment={number}")
        if not fs.exists(segment):
            fs.mkdirs(segment.getParent())
            moves = [(self._at(part)[1], segment)]
        else:
            files = [x.getPath() for x in fs.listStatus(self._at(part)[1])]
            moves = [(x, self._at(f"events/segment={number}/{name}-{x.getName()}")[1]) for x in files if x.getName().startswith("part-")]
        for old, new in moves:
            if not fs.rename(old, new):
                raise OSError(f"not renamed: {old}")

    def _rewrite(self, numbers: list[int], rows: DataFrame) -> None:
        """Put other rows (with their segment) in the place of segments; all are written whole, a task each, before the old ones go."""
        part = f"_parts/rewritten-{uuid.uuid4().hex}"
        rows.select(*EVENT_COLUMNS, "segment").repartition("segment").sortWithinPartitions("segment", "n").write.partitionBy("segment").parquet(f"{self.path}/{part}")
        for number in numbers:
            fs, segment = self._at(f"events/segment={number}")
            written = self._at(f"{part}/segment={number}")[1]
            fs.delete(segment, True)
            if fs.exists(written):  # no row may be left of a segment
                fs.rename(written, segment)

    def _render(self, norms: DataFrame) -> None:
        """The files of norms as they stand after their last event; one that another act holds is refused."""
        keyed = materialise(norms.withColumn("bucket", bucket()), "rendered")
        rows = self._touched("units", UNITS, keyed).where("unit IS NOT NULL").join(keyed.select("norm"), "norm", "left_semi")
        newest = rows.groupBy("norm", "unit").agg(F.max_by(F.struct("kind", "heading", "text"), F.struct(F.col("eff"), F.col("pos"))).alias("v"), F.max(F.coalesce("text", F.lit("")) != "").alias("had_text"), F.min("pos").alias("place"), F.min("title").alias("title"), F.min(F.to_date(F.coalesce("published", "pub"))).alias("published"))
        shown = newest.where("v.text <> '' OR NOT had_text")  # an ended unit goes, a mere heading stays
        blocks = F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda x: F.concat_ws("\n\n", F.when(x["v"]["heading"] != "", F.concat(F.lit("## "), x["v"]["heading"])), F.when(x["v"]["text"] != "", x["v"]["text"])))
        text = F.concat(F.lit("# "), F.coalesce(F.min("title"), F.col("norm")), F.lit("\n\n"), F.array_join(blocks, "\n\n"), F.lit("\n"))
        path = F.concat(F.lit(f"{self.code}/"), F.regexp_replace("norm", "[:/ ]", "-"), F.lit(".md"))
        files = shown.groupBy("norm").agg(text.alias("text"), F.min("published").alias("published")).select("norm", path.alias("path"), "text", "published", bucket().alias("bucket"))
        if self._has("files"):
            held = self._touched("files", FILES, keyed).select("norm", F.col("published").alias("_held"))
            files = files.join(held, "norm", "left").where("_held IS NULL OR published IS NULL OR _held = published").drop("_held")
        allowed = materialise(files, "files")
        self._replace("files", FILES, self._merged("files", FILES, allowed, allowed.select("norm", "bucket")))

    def bootstrap(self, source: DataFrame, day: str, fresh: bool = False) -> int:
        """Fetch what is missing (everything, if ``fresh``) and commit it; the events written."""
        self.fetch(source, day, force=fresh)
        return self.commit(fresh=fresh).count()

    def revised(self, source: DataFrame, other: str) -> int:
        """Add what a second source says of norms that are here: its versions count beside the first ones.

        ``source`` (norm, content) is read by the layout ``other``; its versions carry "revised-" before the
        name of what brings them, so their events are told apart, and a second pass adds none.  The events
        written.
        """
        rows = layouts.read(source, LAYOUTS[other]).where("unit IS NOT NULL").join(self.documents().select("norm"), "norm", "left_semi")
        rows = rows.withColumn("src", F.concat(F.lit("revised-"), F.coalesce("src", "norm"))).withColumn("pos", F.col("pos") + 1_000_000).withColumn("bucket", bucket())
        rows = materialise(rows, "revised")
        keys = rows.select("norm", "bucket").distinct()
        units, ours = self._touched("units", UNITS, keys), F.coalesce(F.startswith("src", F.lit("revised-")), F.lit(False))
        kept = units.where(~ours).unionByName(units.where(ours).join(keys.select("norm"), "norm", "left_anti"))
        self._replace("units", UNITS, kept.unionByName(rows.select(kept.columns)))
        return self.commit().count()

    def reprocess(self, keys: list[str]) -> int:
        """Parse the documents of some keys again, and write their events anew where they differ; other keys are left alone."""
        self._parse(materialise(self.documents().where(self._named(keys)), "reprocessed"))
        own = self._log().where(F.col("norm").isin(keys))
        stale = own.join(self.expected(keys).select(*EVENT_KEY, "content"), [*EVENT_KEY, "content"], "left_anti")
        gone = materialise(stale.select("n", "segment"), "stale")
        segments = [r[0] for r in gone.select("segment").distinct().collect()]  # those that hold events of the named keys
        if segments:
            self._rewrite(segments, self._log().where(F.col("segment").isin(segments)).join(gone.select("n"), "n", "left_anti"))
        return self.commit(keys=keys).count()

    def push(self, published: int = 0) -> DataFrame:
        """(n): the events after which the log is pushed, every slice and the last; those done already are left out."""
        log = self.events().select("n")
        last = log.agg(F.max("n").alias("last"))
        return log.join(F.broadcast(last), F.lit(True)).where(((F.col("n") % self.slice_events == 0) | (F.col("n") == F.col("last"))) & (F.col("n") > published)).select("n")

    def meta(self, discovered: DataFrame, exclusions: DataFrame, day: str) -> list[str]:
        """Write README.md, manifest.json and coverage.json where they would change; the names written.

        The coverage keeps its day while nothing else in it changes.
        """
        counts = {r["stage"]: r["n"] for r in self.status().collect()}
        left = self.coverage(discovered, exclusions)
        reasons = {r["reason"]: r["n"] for r in left.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy("reason").collect()}  # a row a reason
        covered = {"source": self.code, "discovered": discovered.select("key").distinct().count(), "published": counts["files"], "excluded": reasons, "transient": left.where("transient").count()}
        before = self._read("coverage.json")
        held = json.loads(before) if before else {}
        covered["as_of"] = held["as_of"] if {k: v for k, v in held.items() if k != "as_of"} == covered else day
        wanted = {
            "README.md": f"# {self.code}\n\n{counts['files']} documents, {counts['events']} events.\n",
            "manifest.json": json.dumps({"source": self.code, "path": f"{self.code}/{{id}}.md", "formats": self.layout.form, "chunk_events": self.chunk_events}, indent=2) + "\n",
            "coverage.json": json.dumps(covered, indent=2, ensure_ascii=False) + "\n",
        }
        changed = [name for name, text in wanted.items() if self._read(name) != text]
        for name in changed:
            fs, at = self._at(name)
            out = fs.create(at, True)
            out.write(bytearray(wanted[name].encode()))
            out.close()
        return changed

    def _read(self, name: str) -> str | None:
        fs, at = self._at(name)
        return self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()[0] if fs.exists(at) else None

    def status(self) -> DataFrame:
        """stage, n: how many norms each stage holds, and the events."""
        stages = [("documents", self.documents()), ("units", self.units().where("unit IS NOT NULL")), ("files", self.files())]
        parts = [rows.agg(F.count_distinct("norm").alias("n")).select(F.lit(name).alias("stage"), "n") for name, rows in stages]
        parts.append(self.events().agg(F.count(F.lit(1)).alias("n")).select(F.lit("events").alias("stage"), "n"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionAll(part)
        return out

    def reforms(self, norm: str, diff: bool = False) -> DataFrame:
        """The history of a norm, and what its sources changed elsewhere; with ``diff`` the text that each event takes and brings.

        n, day, src, side (own or elsewhere), norm, units; and unit, before, after.
        """
        log = self.events()
        sources = F.broadcast(log.where(F.col("norm") == norm).select("src").distinct())  # the events of one norm
        rows = log.join(sources, "src", "left_semi").withColumn("side", F.when(F.col("norm") == norm, "own").otherwise("elsewhere"))
        rows = rows.select("n", "day", "src", "side", "norm", "units")
        if not diff:
            return rows
        chain = Window.partitionBy("unit").orderBy("eff", "pos")
        versions = self.units().where((F.col("norm") == norm) & F.col("unit").isNotNull()).withColumn("before", F.lag("text").over(chain))
        changed = versions.select(F.coalesce("src", "norm").alias("src"), F.greatest(F.to_date("eff"), F.lit(EPOCH).cast("date")).alias("day"), "unit", "before", F.col("text").alias("after"))
        return rows.where("side = 'own'").join(changed, ["src", "day"]).select("n", "day", "src", "side", "norm", "units", "unit", "before", "after")

    def unseen(self, cited: DataFrame) -> DataFrame:
        """Sources that ``cited`` (norm, src) names for a norm and its log does not hold."""
        return cited.select("norm", "src").distinct().join(self.events().select("norm", "src").distinct(), ["norm", "src"], "left_anti")

    def coverage(self, discovered: DataFrame, exclusions: DataFrame) -> DataFrame:
        return coverage(discovered, self.files().select(F.col("norm").alias("key")), self.failures.current(), exclusions)

    def health(self, discovered: DataFrame, exclusions: DataFrame, today: str, deep: bool = False) -> DataFrame:
        files = self.files().select(F.col("norm").alias("key"), "path", "text", "published")
        events = self.events().select(F.col("norm").alias("key"), F.col("src").alias("source"), "day")
        excluded = self.coverage(discovered, exclusions)
        path = lambda key: F.concat(F.lit(f"{self.code}/"), F.regexp_replace(key, "[:/ ]", "-"), F.lit(".md"))
        return health.report(files, self.documents().select(F.col("norm").alias("key")), events, discovered, excluded, today, path, deep=deep)

    def rewrite_messages(self, change) -> int:
        """Give every event's subject another wording (a column of the old one); the events whose subject changed."""
        rows = materialise(self._log().withColumn("_new", change(F.col("subject"))), "messages")
        numbers = [r[0] for r in rows.where("_new <> subject").select("segment").distinct().collect()]  # a number for each 100,000 events
        if numbers:
            self._rewrite(numbers, rows.where(F.col("segment").isin(numbers)).withColumn("subject", F.col("_new")))
        return rows.where("_new <> subject").count()
