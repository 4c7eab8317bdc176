"""A paged catalogue as a PySpark data source, batch and stream.

A fetcher knows how to get one page; the source plans a partition for each run of pages, so pages
are fetched by as many tasks as the session allows and a lost task fetches its pages again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, InputPartition, SimpleDataSourceStreamReader

from lexloom.session import importable
from lexloom.sources.http import Client

class NumberedPages:
    """A catalogue that a rule makes up: ids 1..total, each with a day; for tests and demonstrations."""

    def __init__(self, options: dict):
        self.total, self.size = int(options.get("total", 1000)), int(options.get("pagesize", 100))

    def count(self) -> int:
        return self.total

    def page(self, offset: int) -> list[tuple[int, str, str]]:
        return [(i, f"norm-{i}", f"2024-01-{i % 28 + 1:02d}") for i in range(offset + 1, min(offset + self.size, self.total) + 1)]


class JsonPages:
    """Pages over HTTP: ``url`` with {offset} and {limit}, answering {"numFound": n, "docs": [{id, name, day}]}."""

    def __init__(self, options: dict):
        self.url, self.size = options["url"], int(options.get("pagesize", 100))
        self.client = Client(rate=float(options.get("rate", 2)))

    def _get(self, offset: int, limit: int) -> dict:
        return json.loads(self.client.get(self.url.format(offset=offset, limit=limit)).body)

    def count(self) -> int:
        return int(self._get(0, 1)["numFound"])

    def page(self, offset: int) -> list[tuple[int, str, str]]:
        return [(x["id"], x["name"], x["day"]) for x in self._get(offset, self.size)["docs"]]


FETCHERS = {"numbered": NumberedPages, "json": JsonPages}


def fetcher(options: dict):
    return FETCHERS[options.get("fetcher", "numbered")](options)


@dataclass
class Pages(InputPartition):
    first: int
    last: int


class CatalogueReader(DataSourceReader):
    """Pages by offset; a lower bound on the id skips the pages before it, an equal id all but one."""

    def __init__(self, options: dict):
        self.options, self.after, self.only = options, 0, None

    def pushFilters(self, filters):
        for x in filters:
            if isinstance(x, GreaterThan) and x.attribute == ("id",):
                self.after = max(self.after, int(x.value))
            elif isinstance(x, EqualTo) and x.attribute == ("id",):
                self.only = int(x.value)
            yield x  # pages hold other rows too, so Spark filters again

    def partitions(self):
        source = fetcher(self.options)
        pages = -(-source.count() // source.size)
        first, last = self.after // source.size, pages - 1
        if self.only is not None:
            first = last = (self.only - 1) // source.size
        step = max(1, int(self.options.get("pagespertask", 4)))
        return [Pages(p, min(p + step - 1, last)) for p in range(first, last + 1, step)] or [Pages(0, -1)]

    def read(self, partition):
        source = fetcher(self.options)
        for page in range(partition.first, partition.last + 1):
            yield from source.page(page * source.size)


class CatalogueStream(SimpleDataSourceStreamReader):
    """A page for each micro-batch, by offset."""

    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self):
        return {"at": 0}

    def read(self, start):
        rows = fetcher(self.options).page(start["at"])
        return iter(rows), {"at": start["at"] + len(rows)}

    def readBetweenOffsets(self, start, end):
        source = fetcher(self.options)
        rows = [x for at in range(start["at"], end["at"], source.size) for x in source.page(at)]
        return iter(rows[: end["at"] - start["at"]])


class CatalogueSource(DataSource):
    """``spark.read.format("catalogue")``; options fetcher, total or url, pagesize, pagespertask."""

    @classmethod
    def name(cls):
        return "catalogue"

    def schema(self):
        return "id long, name string, day string"

    def reader(self, schema):
        return CatalogueReader(dict(self.options))

    def simpleStreamReader(self, schema):
        return CatalogueStream(dict(self.options))


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CatalogueSource)
