"""What a source gives by key: its texts and metadata, all its keys, and the keys of a day.

A connector lives in a task.  The data source ``documents`` asks one for the keys of its partition, so texts
are fetched by as many tasks as there are partitions, and a lost task fetches its own again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from typing import Protocol

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from lexloom.session import importable
from lexloom.sources import http


class Connector(Protocol):
    """Texts as they stood on a day, if the source keeps them; used as a context, which closes it."""

    def discover_all(self) -> Iterator[str]: ...
    def discover_daily(self, day: date) -> Iterator[str]: ...
    def get_text(self, key: str) -> bytes: ...
    def get_metadata(self, key: str) -> bytes: ...
    def set_as_of(self, day: date | None) -> None: ...
    def close(self) -> None: ...


class _Context:
    as_of: date | None = None

    def set_as_of(self, day: date | None) -> None:
        self.as_of = day

    def close(self) -> None:
        pass

    def __enter__(self):
        return self

    def __exit__(self, *wrong) -> None:
        self.close()


class Folder(_Context):
    """``<folder>/<key>/<day>.<ending>`` for each version, and ``metadata.json`` beside them."""

    def __init__(self, options: dict):
        path = options["path"]
        local = "://" not in path or path.startswith("file:")
        self.fs, self.path = (pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)) if local else pafs.FileSystem.from_uri(path)

    def _versions(self, key: str) -> list[tuple[date, str]]:
        found = []
        for x in self.fs.get_file_info(pafs.FileSelector(f"{self.path}/{key}", allow_not_found=True)):
            if day := re.match(r"(\d{4}-\d\d-\d\d)\.", x.base_name):
                found.append((date.fromisoformat(day[1]), x.path))
        return sorted(found)

    def discover_all(self) -> Iterator[str]:
        for x in sorted(self.fs.get_file_info(pafs.FileSelector(self.path, allow_not_found=True)), key=lambda x: x.path):
            if x.type == pafs.FileType.Directory:
                yield x.base_name

    def discover_daily(self, day: date) -> Iterator[str]:
        yield from (key for key in self.discover_all() if any(d == day for d, _ in self._versions(key)))

    def get_text(self, key: str) -> bytes:
        """The newest version, or the one that stood on the day asked for; none by then is an error."""
        known = [path for day, path in self._versions(key) if self.as_of is None or day <= self.as_of]
        if not known:
            raise http.Refused(key, 404, f"no version{f' by {self.as_of}' if self.as_of else ''}")
        with self.fs.open_input_file(known[-1]) as file:
            return file.read()

    def get_metadata(self, key: str) -> bytes:
        path = f"{self.path}/{key}/metadata.json"
        if self.fs.get_file_info(path).type != pafs.FileType.File:
            return json.dumps({"key": key, "versions": [str(d) for d, _ in self._versions(key)]}).encode()
        with self.fs.open_input_file(path) as file:
            return file.read()


class Web(_Context):
    """Addresses with {key}, {day} and {as_of} in them, through a client and, if a folder is named, its cache."""

    def __init__(self, options: dict):
        self.options, self.client = options, http.Client(rate=float(options.get("rate", 2)))
        self.cache = http.Cache(options["cache"], float(options.get("hours", 24))) if "cache" in options else None

    def _get(self, name: str, **parts) -> bytes:
        url = self.options[name].format(as_of=self.as_of or "", **parts)
        return (self.client.fresh(url, self.cache) if self.cache else self.client.get(url)).body

    def discover_all(self) -> Iterator[str]:
        yield from self._get("catalogue").decode("utf-8").split()

    def discover_daily(self, day: date) -> Iterator[str]:
        yield from self._get("daily", day=day).decode("utf-8").split()

    def get_text(self, key: str) -> bytes:
        return self._get("text", key=key)

    def get_metadata(self, key: str) -> bytes:
        return self._get("metadata", key=key)


CONNECTORS = {"folder": Folder, "web": Web}


def connect(options: dict) -> Connector:
    found = CONNECTORS[options.get("connector", "folder")](options)
    found.set_as_of(date.fromisoformat(options["asof"]) if options.get("asof") else None)
    return found


@dataclass
class Keys(InputPartition):
    keys: tuple[str, ...]


class DocumentsReader(DataSourceReader):
    """Keys by discovery (all, or of ``day``), less those that a predicate on the key rules out."""

    def __init__(self, options: dict):
        self.options, self.only = options, None

    def pushFilters(self, filters):
        for x in filters:
            wanted = {x.value} if isinstance(x, EqualTo) else set(x.value) if isinstance(x, In) else None
            if wanted is not None and x.attribute == ("norm",):
                self.only = wanted if self.only is None else self.only & wanted
            else:
                yield x

    def partitions(self):
        with connect(self.options) as source:
            found = source.discover_daily(date.fromisoformat(self.options["day"])) if "day" in self.options else source.discover_all()
            keys = [x for x in found if self.only is None or x in self.only]
        size = int(self.options.get("keyspertask", 100))
        return [Keys(tuple(keys[i : i + size])) for i in range(0, len(keys), size)] or [Keys(())]

    def read(self, partition):
        with connect(self.options) as source:
            for key in partition.keys:
                try:
                    yield key, source.get_text(key), source.get_metadata(key).decode("utf-8"), None, None
                except http.Refused as wrong:
                    yield key, None, None, str(wrong), wrong.status


class DocumentsSource(DataSource):
    """``spark.read.format("documents")``; options connector, path or addresses, asof, day, keyspertask.

    A document that the source refuses is a row with its reason and status, as a workspace takes it.
    """

    @classmethod
    def name(cls):
        return "documents"

    def schema(self):
        return "norm string, content binary, metadata string, reason string, status int"

    def reader(self, schema):
        return DocumentsReader(dict(self.options))


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocumentsSource)
