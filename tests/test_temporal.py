"""Small cases of the point-in-time rules."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from lexloom.operators import temporal as t

SCHEMA = "norm bigint, block int, src bigint, pub date, eff date, txt string, qty int, superseded boolean, expiry date"


def chain(spark, *rows):
    day = lambda x: date.fromisoformat(x) if x else None
    return spark.createDataFrame([(1, 1, i, day(p), day(e), txt, 1, gone, day(x)) for i, (p, e, txt, gone, x) in enumerate(rows)], SCHEMA)


def shown(df, day, strict=False):
    at = F.lit(day).cast("date")
    got = (t.as_of_strict(df, at) if strict else t.as_of(df, at)).collect()
    return got[0]["txt"] if got else None


@pytest.mark.parametrize(("day", "want"), [("2015-08-01", "original"), ("2015-10-01", "amendment")])
def test_effective_date_decides(spark, day, want):
    assert shown(chain(spark, ("1999-01-01", None, "original", False, None), ("2015-06-25", "2015-10-01", "amendment", False, None)), day) == want


def test_retroactive_version_wins(spark):
    assert shown(chain(spark, ("2000-01-01", None, "original", False, None), ("2020-06-01", "2020-03-01", "retroactive", False, None)), "2020-04-01") == "retroactive"


@pytest.mark.parametrize(("day", "want"), [("1999-01-01", None), ("2005-01-01", "a"), ("2015-01-01", "b")])
def test_publication_stands_in(spark, day, want):
    assert shown(chain(spark, ("2000-01-01", None, "a", False, None), ("2010-01-01", None, "b", False, None)), day) == want


def test_printed_later_applies_earlier(spark):
    df = chain(spark, ("2001-01-01", "2001-06-01", "late start", False, None), ("2001-02-01", "2001-03-01", "early start", False, None))
    assert shown(df, "2001-04-01") == "early start"
    assert shown(df, "2001-07-01") == "late start"


@pytest.mark.parametrize(("day", "want"), [("2012-03-05", "live"), ("2012-03-06", None)])
def test_expired_block_is_gone(spark, day, want):
    assert shown(chain(spark, ("2000-01-01", None, "live", False, "2012-03-06")), day, strict=True) == want


def test_tombstone_at_expiry_shows(spark):
    df = chain(spark, ("2000-01-01", None, "live", False, "2012-03-06"), ("2012-03-06", None, "(repealed)", False, "2012-03-06"))
    assert shown(df, "2012-03-06", strict=True) == "(repealed)"


def test_superseded_is_never_read(spark):
    assert shown(chain(spark, ("2000-01-01", None, "a", False, None), ("2001-01-01", None, "b", True, None)), "2002-01-01", strict=True) == "a"


def test_tie_keeps_the_first(spark):
    assert shown(chain(spark, ("2000-01-01", None, "first", False, None), ("2000-01-01", None, "second", False, None)), "2001-01-01") == "first"


def test_history_equals_as_of_at_each_event(spark):
    df = chain(spark, ("2000-01-01", None, "a", False, None), ("2001-01-01", "2003-01-01", "b", False, None), ("2002-01-01", None, "c", False, None))
    assert {r["day"]: r["n_blocks"] for r in t.history(df).collect()} == {date(2000, 1, 1): 1, date(2002, 1, 1): 1, date(2003, 1, 1): 1}
    spans = [(r["txt"], r["ends"]) for r in t.intervals(df).orderBy("starts").collect()]
    assert spans == [("a", date(2002, 1, 1)), ("c", date(2003, 1, 1)), ("b", None)]


def test_empty_chain(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert t.as_of(df, F.lit("2000-01-01").cast("date")).count() == 0
    assert t.history(df).count() == 0
