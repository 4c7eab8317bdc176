"""Ways in which sources list what they hold, over a function that asks for one page.

Each takes the asking function and gives the rows, so the same walk serves HTTP, a test and a partition
of a data source; ``Walk`` below runs one in a task and ``probes`` runs a numbered range in many.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Hashable, Iterable, Iterator
from datetime import date, timedelta

from lexloom.sources import layouts

WITHOUT_NEW, MISSES = 200, 5
Key = Callable[[object], Hashable]


def _same(row):
    return row


def offsets(ask: Callable[[int, int], list], size: int, key: Key = _same) -> Iterator:
    """Pages by offset, whose order may shift between requests: a key counts once, an empty page ends."""
    seen, at = set(), 0
    while rows := ask(at, size):
        for row in rows:
            if key(row) not in seen:
                seen.add(key(row))
                yield row
        at += size


def after(ask: Callable[[object, int], list], size: int, key: Key, start=None) -> Iterator:
    """Pages of rows beyond the last key of the page before; ``key`` may be a pair."""
    last = start
    while rows := ask(last, size):
        yield from rows
        last = key(rows[-1])
        if len(rows) < size:
            return


def whole_groups(ask: Callable[[object, int], list], size: int, key: Key, start=None) -> Iterator[list]:
    """The rows of each key together, from pages that begin at a key and may end inside one.

    The last key of a full page is held back and asked for again; a key that fills a page is an error.
    """
    last = start
    while rows := ask(last, size):
        groups: dict = {}
        for row in rows:
            groups.setdefault(key(row), []).append(row)
        full = len(rows) >= size
        if full and len(groups) == 1:
            raise ValueError(f"{key(rows[-1])!r}: one key fills a page of {size} rows")
        held = key(rows[-1]) if full else None
        yield from (g for k, g in groups.items() if k != held or not full)
        if not full:
            return
        last = held


def numbered(ask: Callable[[int], list], first: int = 1, without_new: int = WITHOUT_NEW, key: Key = _same) -> Iterator:
    """Pages by number until one is empty or so many in a row hold nothing new."""
    seen, page, stale = set(), first, 0
    while stale < without_new and (rows := ask(page)):
        new = [row for row in rows if key(row) not in seen]
        seen.update(map(key, new))
        stale = 0 if new else stale + 1
        yield from dict.fromkeys(new) if key is _same else new
        page += 1


def counted(ask: Callable[[int, int], tuple[int, list]], size: int) -> Iterator:
    """Pages of a catalogue that says how many rows it has; one that then gives fewer is an error."""
    at, total = 0, None
    while total is None or at < total:
        total, rows = ask(at, size)
        if not rows and at < total:
            raise ValueError(f"{at} of {total} rows, then an empty page")
        yield from rows
        at += len(rows)


def listings(ask: Callable[[object, int], list], kinds: Iterable, years: Iterable[int]) -> Iterator[tuple]:
    """(kind, year, row) of a listing for each kind and year."""
    years = list(years)
    for kind in kinds:
        for year in years:
            for row in ask(kind, year):
                yield kind, year, row


def back_to(ask: Callable[[int], tuple[int, list]], since: date, day: Callable[[object], date]) -> Iterator:
    """Rows of a log, newest first, that are not before ``since``; a page that was not asked for is an error."""
    page = 1
    while True:
        served, rows = ask(page)
        if served != page:
            raise ValueError(f"page {served} came for page {page}")
        for row in rows:
            if day(row) >= since:
                yield row
        if not rows or day(rows[-1]) < since:
            return
        page += 1


def feed(ask: Callable[[str], str], url: str) -> Iterator[layouts.Node]:
    """The entries of an Atom feed and of the feeds that it names as next; a feed named twice ends it."""
    seen = set()
    while url and url not in seen:
        seen.add(url)
        root, _ = layouts.tree(ask(url), "xml")
        yield from layouts.find(root, "entry")
        url = layouts.first(root, "link[rel=next]@href")


def sitemap(ask: Callable[[str], str | None], url: str, scope: str = "") -> Iterator[str]:
    """The locations of a sitemap and of those that it lists; one that is gone (None) is passed over."""
    left, seen = [url], set()
    while left:
        at = left.pop()
        text = None if at in seen else ask(at)
        seen.add(at)
        if text is None:
            continue
        found = [x.strip() for x in re.findall(r"<loc>\s*([^<]*?)\s*</loc>", text)]
        if "<sitemapindex" in text:
            left += reversed(found)
        else:
            yield from (x for x in found if re.search(scope, x))


def calendar(ask: Callable[[date], list], start: date, end: date, known: dict[date, list] | None = None, again: int = 3) -> dict[date, list]:
    """What each day lists; days in ``known`` are not asked for, but for the last few."""
    out: dict[date, list] = {}
    for i in range((end - start).days + 1):
        at = start + timedelta(days=i)
        fresh = (end - at).days < again
        out[at] = known[at] if known and at in known and not fresh else ask(at)
    return out


def year_of(number: int, landmarks: list[tuple[int, int]]) -> float:
    """The year in which a number was given, between known (number, year) pairs; beyond them the nearest."""
    marks = sorted(landmarks)
    for (a, first), (b, last) in zip(marks, marks[1:]):
        if a <= number <= b:
            return first + (last - first) * (number - a) / (b - a) if b > a else float(first)
    return float(marks[0][1] if number < marks[0][0] else marks[-1][1])


def candidates(number: int, landmarks: list[tuple[int, int]], last: int | None = None, reach: int = 2) -> list[int]:
    """Years to try for a number: that of the last success, the estimate, then outward from it."""
    middle = round(year_of(number, landmarks))
    tries = [*([] if last is None else [last]), middle, *(middle + s * d for d in range(1, reach + 1) for s in (-1, 1))]
    return list(dict.fromkeys(tries))
