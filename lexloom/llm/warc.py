"""WARC archives as a PySpark Python data source, and revisit records for equal payloads.

Reading plans partitions from whole files (small ones together), takes predicates on the record
type and the other header columns, parses a record's header first, and neither keeps nor decodes
the payload of a record that a predicate or the payload option rules out: it seeks past it, also in
compressed files, whose members say their size in an extra field.

Which record of equal payloads is the response is found on ids and digests only.  Payloads of rows
that are no revisit are written where they are read; a bitmap of fixed size tells most of them
(``marks.py``), and what it leaves in doubt moves through an exact join.  The bitmap is made only
where there are copies, the join only where it leaves a row in doubt.

Defined results: null html is an empty payload; a null url leaves its header out; a null page_id
is written as an empty id and read as null, and never is the response while another id shares the
payload; of rows that repeat the largest id and its payload, that with the largest url is the
response and the others revisit it under their own id; payloads of any length are written whole, one
at a time in memory; ids are cast to long; no pages give an archive without records; further columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
import zlib
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import datasource as ds

from lexloom.llm import store
from lexloom.llm.marks import Marks

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
ID = "urn:lexloom:page:"

COLUMNS = "page_id long, record_type string, target_uri string, payload_digest string, payload_bytes long, refers_to long"
_HEADER = [x.split()[0] for x in COLUMNS.split(", ")]
#: Bytes of a file at which a task begins another, of the files that one task reads, and of an Arrow batch.
FILE_BYTES, PARTITION_BYTES, BATCH_BYTES = 256 << 20, 8 << 20, 4 << 20
#: Bytes of a gzip header with the extra field "sl": compressed and plain size, 32 bits each.
_HEAD = 24
#: What lists the files of a write that succeeded.
LISTED, OWN = "_written-", "part-"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<{ID}{'' if page_id is None else page_id}>"


def _page(uri: str | None) -> int | None:
    number = (uri or "").strip("<>").removeprefix(ID)
    return int(number) if number.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str | None, record_type: str, refers_to: int | None, payload_bytes: int | None = None) -> bytes:
    """The bytes of one record; a revisit carries the digest and length of its payload alone."""
    body = payload if record_type == "response" and payload else b""
    digest = payload_digest(payload or b"") if digest is None else digest
    size = len(payload or b"") if payload_bytes is None else payload_bytes
    fields = [("WARC-Type", record_type), ("WARC-Record-ID", _uri(page_id)), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size))]
    if record_type == "revisit":
        fields += [("WARC-Refers-To", _uri(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8")
    return VERSION + b"\r\n" + head + b"\r\n" + body + END


def member(data: bytes, level: int) -> bytes:
    """A gzip member whose extra field says how many bytes to skip to the next one, and to inflate."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(data) + packer.flush()
    size = _HEAD + len(packed) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def header_of(head: bytes) -> dict:
    """The header columns, and under "" the length of the record's own content."""
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    named = {}
    for line in lines[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        named[name.strip().lower()] = value.strip()
    length = int(named.get("content-length", 0))
    full = named.get("x-payload-length")
    refers = named.get("warc-refers-to")
    return {"page_id": _page(named.get("warc-record-id")), "record_type": named.get("warc-type"), "target_uri": named.get("warc-target-uri"), "payload_digest": named.get("warc-payload-digest", "").removeprefix("sha1:") or None, "payload_bytes": int(full) if full else length, "refers_to": _page(refers), "": length}


class _Plain:
    """Records of an uncompressed file; payloads that nobody wants are sought past."""

    def __init__(self, file):
        self.file = file

    def heads(self):
        at, buffer, size = 0, b"", self.file.size()
        while at < size:
            while END not in buffer and at + len(buffer) < size:
                buffer += self.file.read(65536)
            head, _, buffer = buffer.partition(END)
            self.start, self.rest = at + len(head) + len(END), buffer
            info = header_of(head)
            yield info
            at = self.start + info[""] + len(END)
            skipped = info[""] + len(END)
            if skipped <= len(buffer):
                buffer = buffer[skipped:]
            else:
                self.file.seek(at)
                buffer = b""

    def payload(self, length: int) -> bytes:
        held = self.rest[:length]
        if len(held) < length:
            self.file.seek(self.start + len(held))
            held += self.file.read(length - len(held))
            self.file.seek(self.start + len(self.rest))
        return held


class _Gzip:
    """Records of a file with a gzip member each.

    Where a member's extra field gives its size, the reader inflates the header alone and seeks to
    the next member; of foreign members the rest is inflated to nowhere.
    """

    def __init__(self, file):
        self.file, self.size = file, file.size()
        self.inflated = 0

    def _more(self, most: int = 1 << 18) -> bytes:
        """The next inflated bytes of this member, empty at its end."""
        while not self.member.eof:
            if not self.raw:
                self.raw = self.file.read(1 << 16)
                if not self.raw:
                    raise ValueError("the archive ends inside a record")
            out = self.member.decompress(self.raw, most)
            self.raw = self.member.unconsumed_tail or self.member.unused_data
            if out:
                self.inflated += len(out)
                return out
        return b""

    def heads(self):
        at = 0
        while at < self.size:
            self.file.seek(at)
            self.raw = self.file.read(min(4096, self.size - at))
            skip = None
            if len(self.raw) >= _HEAD and self.raw[:2] == b"\x1f\x8b" and self.raw[3] & 4 and self.raw[12:16] == b"sl\x08\x00":
                skip = struct.unpack_from("<I", self.raw, 16)[0]
            self.member, self.rest = zlib.decompressobj(31), b""
            while END not in self.rest:
                got = self._more(2048)
                if not got:
                    raise ValueError("the archive holds a member without a record")
                self.rest += got
            head, _, self.rest = self.rest.partition(END)
            yield header_of(head)
            self.rest = b""
            if skip is None:
                while self._more():
                    pass
                at = self.file.tell() - len(self.raw)
            else:
                at += skip

    def payload(self, length: int) -> bytes:
        held = [self.rest]
        size = len(self.rest)
        while size < length and (got := self._more()):
            held.append(got)
            size += len(got)
        return b"".join(held)[:length]


_TESTS = {
    ds.EqualTo: lambda v, x: v is not None and v == x.value,
    ds.EqualNullSafe: lambda v, x: v == x.value,
    ds.In: lambda v, x: v is not None and v in x.value,
    ds.GreaterThan: lambda v, x: v is not None and v > x.value,
    ds.GreaterThanOrEqual: lambda v, x: v is not None and v >= x.value,
    ds.LessThan: lambda v, x: v is not None and v < x.value,
    ds.LessThanOrEqual: lambda v, x: v is not None and v <= x.value,
    ds.StringStartsWith: lambda v, x: v is not None and v.startswith(x.value),
    ds.IsNull: lambda v, x: v is None,
    ds.IsNotNull: lambda v, x: v is not None,
}


@dataclass
class Files(ds.InputPartition):
    names: tuple[str, ...]


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.filters: list = []

    def pushFilters(self, filters):
        for x in filters:
            if type(x) in _TESTS and x.attribute[0] in _HEADER:
                self.filters.append(x)
            else:
                yield x

    def partitions(self):
        fs, path = store.file_system(self.path)
        files = [x for x in fs.get_file_info(pafs.FileSelector(path)) if x.is_file]
        listed = set()
        for x in files:
            if os.path.basename(x.path).startswith(LISTED):
                with fs.open_input_file(x.path) as names:
                    listed.update(names.read().decode().split())
        found = sorted((x.path, x.size) for x in files if x.path.endswith((".warc", ".warc.gz")) and (not os.path.basename(x.path).startswith(OWN) or os.path.basename(x.path) in listed))
        parts, own, held = [], [], 0
        for name, size in found:
            if own and held + size > PARTITION_BYTES:
                parts.append(Files(tuple(own)))
                own, held = [], 0
            own.append(name)
            held += size
        return [*parts, Files(tuple(own))]

    def _rows(self, name: str):
        fs, _ = store.file_system(self.path)
        with fs.open_input_file(name) as file:
            records = _Gzip(file) if name.endswith(".gz") else _Plain(file)
            for info in records.heads():
                if not all(_TESTS[type(x)](info[x.attribute[0]], x) for x in self.filters):
                    continue
                payload = records.payload(info[""]) if (self.payload or self.verify) and info["record_type"] != "revisit" else None
                if self.verify and payload is not None and (len(payload) != info["payload_bytes"] or payload_digest(payload) != info["payload_digest"]):
                    raise ValueError(f"{name}: the payload of page {info['page_id']} does not match its header")
                yield info, payload if self.payload else None

    def read(self, partition):
        names = [*_HEADER, *["payload"] * self.payload]
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kinds.get(n, pa.string())) for i, n in enumerate(names)], names)

        for name in partition.names:
            for info, payload in self._rows(name):
                rows.append([*(info[x] for x in _HEADER), payload])
                held += 300 + len(payload or b"")
                if held > BATCH_BYTES:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


@dataclass
class Written(ds.WriterCommitMessage):
    names: tuple[str, ...]


class WarcWriter(ds.DataSourceArrowWriter):
    """Rows of page_id, url, payload, payload_bytes, sha1, record_type and refers_to.

    Tasks write files of names of their own into the archive; the driver then writes one list of
    those of the tasks that succeeded, and a reader passes over files of this writer that no list
    names, so lost or repeated tasks leave no records behind and no file is moved.
    """

    def __init__(self, options: dict):
        self.path = options["path"]
        self.gzip = options.get("compression", "gzip").lower() == "gzip"
        self.level = int(options.get("level", "4"))

    def write(self, batches):
        fs, path = store.file_system(self.path)
        fs.create_dir(path, recursive=True)
        names, out, held, stem = [], None, 0, uuid.uuid4().hex
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"{OWN}{stem}-{len(names):05d}.warc" + ".gz" * self.gzip)
                    out, held = fs.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                digest = row["sha1"] and base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                data = record(row["page_id"], row["url"], row["payload"], digest, row["record_type"], row["refers_to"], row["payload_bytes"])
                data = member(data, self.level) if self.gzip else data
                out.write(data)
                held += len(data)
                if held >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(tuple(names))

    def commit(self, messages):
        fs, path = store.file_system(self.path)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{LISTED}{uuid.uuid4().hex}", compression=None) as out:
            for m in filter(None, messages):
                out.write("".join(f"{x}\n" for x in m.names).encode())

    def abort(self, messages):
        fs, path = store.file_system(self.path)
        for name in [x for m in messages if m for x in m.names]:
            fs.delete_file(f"{path}/{name}")


class WarcSource(ds.DataSource):
    """``spark.read.format("warc").load(folder)``; options payload, verify; for writing compression, level."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return COLUMNS + (", payload binary" if self.options.get("payload", "true").lower() == "true" else "")

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    store.importable(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, sha1, record_type and refers_to of every page.

    A revisit has no payload but its length and SHA-1 in hexadecimal; a response has no SHA-1, as its
    writer takes that from the payload.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    scanned = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    size = F.length("payload").cast("long")
    scanned = scanned.withColumn("key", F.when(size >= min_bytes, F.unhex(F.sha2("payload", 256))))
    own = F.concat_ws("|", F.hex("key"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.when(F.col("url").isNull(), "").otherwise(F.concat(F.lit("u"), "url")))
    scanned = scanned.withColumn("tag", F.unhex(F.md5(own.cast("binary"))))
    rows = store.materialise(scanned.select("page_id", "url", "key", "tag", size.alias("payload_bytes"), F.sha1("payload").alias("sha1")), "pages")
    keyed = rows.where("key IS NOT NULL")
    groups = (keyed.groupBy("key").agg(F.max(F.struct("page_id", "url")).alias("head"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 AND head.page_id IS NOT NULL").select(F.col("key").alias("of"), "head"))
    once = keyed.groupBy("page_id", "url", "key", "tag", "payload_bytes", "sha1").agg(F.count(F.lit(1)).alias("times"))
    found = once.join(groups, once["key"] == groups["of"], "left")
    is_head = F.struct("page_id", "url").eqNullSafe(F.col("head"))
    again = F.when(F.col("head").isNull(), 0).otherwise(F.col("times") - F.when(is_head, 1).otherwise(0))
    settled = store.materialise(found.select("page_id", "url", "key", "tag", "payload_bytes", "sha1", F.col("head.page_id").alias("refers_to"), "times", again.cast("long").alias("again")), "settled")
    copies = settled.where("again > 0")
    # Without copies no row is a revisit, and neither marks nor joins are planned.
    if copies.isEmpty():
        return _responses(scanned)
    revisits = copies.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "again")))
    revisits = revisits.select("page_id", "url", F.lit(None).cast("binary").alias("payload"), "payload_bytes", "sha1", F.lit("revisit").alias("record_type"), "refers_to")
    # Payloads of rows that no revisit looks like are written where they are read.  Of the others only
    # those that may be a response after all move, with the number of responses that they stand for.
    marked = Marks(copies, "tag")
    doubtful = store.materialise(marked.tested(settled.where("times > again"), "tag", "_marked").where("_marked").select("tag", (F.col("times") - F.col("again")).alias("responses")), "doubtful")
    tested = marked.tested(scanned, "tag", "_marked")
    written = _responses(tested.where("key IS NULL OR NOT _marked")).unionByName(revisits)
    if doubtful.isEmpty():
        return written
    moved = Marks(doubtful, "tag").tested(tested.where("key IS NOT NULL AND _marked"), "tag", "_doubtful").where("_doubtful")
    moved = moved.dropDuplicates(["tag"]).join(doubtful, "tag").withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "responses")))
    return written.unionByName(_responses(moved))


def _responses(rows: DataFrame) -> DataFrame:
    size = F.length("payload").cast("long")
    return rows.select("page_id", "url", "payload", size.alias("payload_bytes"), F.lit(None).cast("string").alias("sha1"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, compression: str = "gzip") -> None:
    register(pages.sparkSession)
    planned(pages, min_bytes=min_bytes).write.format("warc").mode("append").option("compression", compression).save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True, verify: bool = False) -> DataFrame:
    """All records below ``path``.

    Spark keeps the predicates last pushed with the loaded frame, so the frame always has one to
    push, which replaces them.  Branches of one query that filter differently need a call each.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).option("verify", str(verify).lower()).load(path).where("record_type IS NOT NULL")


def op6_warc(spark, sf_dir: str) -> DataFrame:
    path = store.fresh_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_archives(spark, path, payload=False, verify=True).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB has no base32; the digits come from the 40-bit groups of the hexadecimal digest.
_GROUP = "('0x' || substr(h, {at}, 10))::BIGINT"
_LETTERS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({_GROUP.format(at=10 * g + 1)}) >> {35 - 5 * i}) & 31)::INT + 1, 1)" for g in range(4) for i in range(8))
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT html, max(page_id) AS head FROM p GROUP BY html)
SELECT p.page_id, octet_length(encode(p.html))::BIGINT AS payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN p.page_id = g.head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> g.head THEN g.head END AS refers_to
FROM p JOIN g ON p.html = g.html
"""
