"""Which days a run takes, what it drops, and when its cursor moves.

Two cursors say how far earlier runs came: that of the run state, which moves over clean days only, and
the newest day of the event log, which a failed day or an act scheduled ahead leaves too late.  The earlier
one counts.  A run looks back so many days at most; the days before that which the state's cursor had not
passed are reported as dropped.  Naming the first day lifts the bound.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

LOOKBACK = 10
ONE = timedelta(days=1)


@dataclass(frozen=True)
class Plan:
    days: tuple[date, ...]
    dropped: tuple[date, date] | None = None


def planned(today: date, state: date | None = None, log: date | None = None, since: date | None = None, only: date | None = None, lookback: int = LOOKBACK, skip: Iterable[int] = ()) -> Plan | None:
    """The days to take, in order; None where nothing says where to begin. ``skip`` are weekdays, Monday 0."""
    if only is not None:
        return Plan((only,))
    cursor = min((x for x in (state, log) if x is not None), default=None) if state is not None else log
    if since is None and cursor is None:
        return None
    start, dropped = since or cursor + ONE, None
    earliest = today - timedelta(days=lookback)
    if since is None and start < earliest:
        if state is not None and state + ONE < earliest:
            dropped = (state + ONE, earliest - ONE)
        start = earliest
    days = tuple(start + ONE * i for i in range((today - start).days + 1))
    return Plan(tuple(x for x in days if x.weekday() not in set(skip)), dropped)


@dataclass
class State:
    """What a run leaves for the next: its cursor, the keys that are pending, and its counts.

    Kept as one JSON record a run in the shared folder; the newest counts, so a run that dies while it
    writes leaves the one before.
    """

    path: str
    cursor: date | None = None
    pending: dict[str, str] = field(default_factory=dict)
    runs: int = 0

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> State:
        found = _read(spark, path)
        if found is None:
            return cls(path)
        return cls(path, date.fromisoformat(found["cursor"]) if found["cursor"] else None, found["pending"], found["runs"])

    def save(self, spark: SparkSession) -> None:
        self.runs += 1
        record = json.dumps({"cursor": self.cursor.isoformat() if self.cursor else None, "pending": self.pending, "runs": self.runs})
        fs, root = _fs(spark, self.path)
        part, whole = _path(spark, f"{self.path}/.{uuid.uuid4().hex}"), _path(spark, f"{self.path}/run-{self.runs:08d}.json")
        fs.mkdirs(root)
        out = fs.create(part, True)
        out.write(bytearray(record.encode()))
        out.close()
        if not fs.rename(part, whole):
            raise FileExistsError(f"another run wrote {whole}")

    def finish(self, day: date, clean: bool) -> None:
        """Move the cursor over a clean day, never backwards."""
        if clean and (self.cursor is None or day > self.cursor):
            self.cursor = day


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    at = _path(spark, path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _read(spark: SparkSession, path: str) -> dict | None:
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return None
    names = sorted(x.getPath().getName() for x in fs.listStatus(root) if x.getPath().getName().startswith("run-"))
    return json.loads(spark.read.text(f"{path}/{names[-1]}", wholetext=True).first()[0]) if names else None


@dataclass
class Report:
    """What a run did: its days, counts, what it dropped, failed at and put off."""

    days: list[date] = field(default_factory=list)
    published: int = 0
    errors: list[str] = field(default_factory=list)
    dropped: tuple[date, date] | None = None
    put_off: list[date] = field(default_factory=list)

    def end(self) -> None:
        """Everything that could be published has been; now a run with errors or dropped days fails."""
        said = list(self.errors)
        if self.dropped:
            said.append(f"days dropped: {self.dropped[0]} to {self.dropped[1]}")
        if said:
            raise RuntimeError("; ".join(said))


def run(spark: SparkSession, state: State, today: date, process: Callable[[date, list[str]], tuple[int, dict[str, str], set[str]]], log: date | None = None, clock: Callable[[], float] | None = None, budget: float | None = None, most_failures: int | None = None, **how) -> Report:
    """Take each day: publish, note failures, look at pending keys again, then move the cursor.

    ``process(day, pending keys)`` gives (events published, keys that failed with their reasons, keys that
    are settled); an exception fails the day and not the run.  The cursor stops before the first day that
    failed, and days past it are still published, as their events are known again by their keys.  Days for
    which the time budget does not last are put off, and so are the rest after ``most_failures`` failed days
    in a row.  The state is saved after each day.
    """
    plan, report = planned(today, state.cursor, log, **how), Report()
    if plan is None:
        return report
    report.dropped = plan.dropped
    began, row = clock() if clock else 0.0, 0
    for day in plan.days:
        if budget is not None and clock() - began > budget or most_failures is not None and row >= most_failures:
            report.put_off.append(day)
            continue
        try:
            published, failed, settled = process(day, sorted(state.pending))
        except Exception as wrong:  # a day's failure must not lose the days after it
            report.errors.append(f"{day}: {type(wrong).__name__}: {wrong}")
            row += 1
        else:
            row = 0
            report.published += published
            for key in settled:
                state.pending.pop(key, None)
            state.pending |= failed
            report.errors += [f"{day}: {key}: {reason}" for key, reason in sorted(failed.items())]
            state.finish(day, not report.errors and not report.put_off)
        report.days.append(day)
        state.save(spark)
    return report


def newest_day(events: DataFrame, today: date, last: int = 500, stamped: str | None = None) -> date | None:
    """The newest day among the last entries of a log that is not in the future and not only stamped."""
    rows = events.orderBy(F.desc("n")).limit(last).where(F.col("day") <= F.lit(today))
    if stamped:
        rows = rows.where(~F.col(stamped))
    return rows.agg(F.max("day")).first()[0]


def worked_off(waiting: list, take: Callable[[list], dict], batch: int, clock: Callable[[], float], budget: float) -> tuple[list, list]:
    """(done, left): a queue in batches until it is empty, the time is up, or a whole batch is refused.

    ``take`` gives the refused items of a batch with their reasons; they go to the end of the queue, so the
    next run begins with what has not been tried.  A run in which nothing was done is an error.
    """
    queue, done, refused, until = list(waiting), [], {}, clock() + budget
    while queue and clock() < until:
        own, queue = queue[:batch], queue[batch:]
        failed = take(own)
        done += [x for x in own if x not in failed]
        queue += [x for x in own if x in failed]
        refused |= failed
        if len(failed) == len(own):
            break
    if refused and not done:
        raise RuntimeError(f"everything was refused: {next(iter(refused.values()))}")
    return done, queue
