"""Which source is read how: formats, where its history comes from, how it says what changed on a day.

A source is a row of this table and not a module: its layout, the plans for its history and its daily
signal are chosen by its values, so a further source is a further row.  What a source needs besides, a
hook, is named here as "module:function" and loaded when it is asked for.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Source:
    code: str
    formats: str
    history: str
    signal: str
    status: str = "mapped"


#: The registered sources, with the format of their texts, the way their histories
#: are found, their daily signal, and whether a status is told at all.
SOURCES = [
    Source("ad", "json html", "as_enacted", "exact", "constant"),
    Source("ar", "csv html", "operations", "exact", "constant"),
    Source("at", "json xml", "parts", "exact"),
    Source("be", "html", "snapshots", "exact"),
    Source("ch", "sparql xml pdf", "snapshots", "exact", "constant"),
    Source("cl", "xml csv", "current", "exact"),
    Source("co", "html", "embedded", "none"),
    Source("cz", "json", "citations", "probe"),
    Source("de", "zip xml", "current", "snapshot", "constant"),
    Source("dk", "xml", "register", "exact"),
    Source("ee", "zip xml", "chain", "exact"),
    Source("es", "xml", "versions", "exact"),
    Source("eu", "sparql html pdf", "snapshots", "exact"),
    Source("fi", "xml", "register", "cumulative"),
    Source("fr", "tar xml", "versions", "exact"),
    Source("gr", "pdf json", "as_enacted", "exact", "constant"),
    Source("ie", "html xml pdf", "effects", "snapshot"),
    Source("it", "json html zip", "versions", "exact", "constant"),
    Source("li", "html", "snapshots", "exact", "constant"),
    Source("lt", "json", "snapshots", "exact"),
    Source("lu", "sparql xml", "snapshots", "exact"),
    Source("lv", "html", "current", "exact"),
    Source("nl", "xml", "snapshots", "cumulative", "constant"),
    Source("no", "tar html", "current", "snapshot", "constant"),
    Source("pl", "json html", "current", "exact"),
    Source("pt", "json", "relations", "exact"),
    Source("ro", "soap html", "snapshots", "exact", "constant"),
    Source("se", "json html", "register", "exact"),
    Source("sk", "json html", "snapshots", "exact"),
    Source("ua", "text json", "register", "exact"),
    Source("uk", "xml atom zip", "snapshots", "exact"),
    Source("us", "zip xml", "current", "snapshot", "constant"),
    Source("uy", "json", "current", "probe", "constant"),
]


#: What a source may bring of its own.
HOOKS = ("bootstrap", "daily", "revised", "versions", "reconstruct", "reforms")
_hooks: dict[tuple[str, str], str] = {}


def hook(code: str, name: str, where: str) -> None:
    """Name the function ("module:function") that does ``name`` for a source."""
    if name not in HOOKS:
        raise ValueError(f"no such hook: {name}")
    _hooks[code, name] = where


@dataclass(frozen=True)
class Plugin:
    """The four parts of a source: how it is asked, what it lists, how its texts and its metadata are read."""

    source: Source

    @property
    def layout(self):
        """Texts and metadata; the table of layouts is loaded when the first one is asked for."""
        return importlib.import_module("lexloom.sources.layout_table").LAYOUTS[self.source.code]

    def client(self, **settings):
        return importlib.import_module("lexloom.sources.http").Client(**settings)

    def changed(self, rows: DataFrame, before: DataFrame, day: str) -> DataFrame:
        return daily(self.source.code, rows, before, day)

    def read(self, docs: DataFrame, **maps) -> DataFrame:
        """The units of documents (norm, content); ``ranks`` and other maps take the place of the layout's."""
        layouts = importlib.import_module("lexloom.sources.layouts")
        return layouts.read(docs, replace(self.layout, **maps))

    def hook(self, name: str) -> Callable | None:
        """The source's own function for a step, or None where the general one serves."""
        if name not in HOOKS:
            raise ValueError(f"no such hook: {name}")
        where = _hooks.get((self.source.code, name))
        if where is None:
            return None
        module, _, function = where.partition(":")
        return getattr(importlib.import_module(module), function)


def plugin(code: str) -> Plugin:
    for source in SOURCES:
        if source.code == code:
            return Plugin(source)
    raise KeyError(f"no such source: {code}")


def table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s.code, s.formats, s.history, s.signal, s.status) for s in SOURCES], "code string, formats string, history string, signal string, status string")


def changed(signal: str, rows: DataFrame, before: DataFrame, day: str) -> DataFrame:
    """The keys that a source reports for ``day``.

    ``rows`` (key, day, digest) is what it lists now, ``before`` what it listed at the last run.
    exact: listed under the day.  cumulative: listed since the day, less since the day after.
    snapshot: new or with another digest.  probe: numbers beyond the last known one.  none: nothing.
    """
    at = F.lit(day).cast("date")
    if signal == "exact":
        found = rows.where(F.col("day") == at)
    elif signal == "cumulative":
        found = rows.where(F.col("day") >= at).join(rows.where(F.col("day") > at).select("key"), "key", "left_anti")
    elif signal == "snapshot":
        found = rows.join(before.select("key", F.col("digest").alias("_old"), F.lit(True).alias("_had")), "key", "left").where(F.col("_had").isNull() | ~F.col("digest").eqNullSafe(F.col("_old")))
    elif signal == "probe":
        last = before.agg(F.coalesce(F.max("key"), F.lit(0)).alias("_last"))
        found = rows.join(F.broadcast(last), F.col("key") > F.col("_last"))
    elif signal == "none":
        found = rows.where("false")
    else:
        raise ValueError(f"no such signal: {signal}")
    return found.select("key").distinct()


@dataclass(frozen=True)
class Daily:
    """How one source tells its changes of a day, over rows (key, day, digest, feed, base, removed).

    ``feeds``: (name, days of lookback) of the lists that it publishes; ``base``: a change counts for the
    law that it amends; ``removed``: rows that are gone do not count; ``latest``: only a key's newest day
    counts; ``scope``: only keys that are published already.
    """

    feeds: tuple[tuple[str, int], ...] = (("published", 0),)
    base: bool = False
    removed: bool = False
    latest: bool = False
    scope: bool = False
    also: str = ""


#: The sources whose daily list differs from one list of the day.
DAILY = {
    "es": Daily((("published", 0), ("consolidated", 1))),
    "eu": Daily((("published", 0), ("consolidated", 0), ("amended", 0)), also="pending"),
    "lu": Daily((("published", 0), ("consolidated", 0))),
    "pt": Daily((("published", 3),), also="snapshot"),
    "se": Daily(base=True),
    "dk": Daily(removed=True),
    "fr": Daily(scope=True),
    "uk": Daily(latest=True),
    "fi": Daily(latest=True),
    "be": Daily(scope=True),
}


def daily(code: str, rows: DataFrame, before: DataFrame, day: str, pending: DataFrame | None = None) -> DataFrame:
    """(key): what a source reports for ``day``, by its signal and its daily rule.

    ``before`` (key, digest) is what is published; ``pending`` (key) is looked at again where the rule says so.
    """
    source, rule, at = plugin(code).source, DAILY.get(code, Daily()), F.lit(day).cast("date")
    if rule.removed:
        rows = rows.where(~F.col("removed"))
    if rule.base:
        rows = rows.withColumn("key", F.coalesce("base", "key"))
    if rule.latest:
        rows = rows.groupBy("key").agg(F.max("day").alias("day"), F.max_by("digest", "day").alias("digest"), F.max_by("feed", "day").alias("feed"))
    if source.signal == "exact":
        found = rows.where("false").select("key")
        for feed, back in rule.feeds:
            found = found.unionAll(rows.where((F.col("feed") == feed) & F.col("day").between(F.date_sub(at, back), at)).select("key"))
        found = found.distinct()
    else:
        found = changed(source.signal, rows, before, day)
    if rule.also == "snapshot":
        found = found.unionAll(changed("snapshot", rows, before, day)).distinct()
    if rule.also == "pending" and pending is not None:
        found = found.unionAll(pending.select("key")).distinct()
    return found.join(before.select("key"), "key", "left_semi") if rule.scope else found
