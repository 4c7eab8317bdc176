"""Requests with a rate, waits and second tries, and a cache of answers in the shared folder.

A client lives in a task: its rate holds for the threads of that task, so a source that takes r
requests a second from n tasks is asked with r / n each.  The cache is files in the folder that all
executors share; a record appears under its name only when it is whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import threading
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow.fs as pafs

#: Answers that are worth another try, and the longest part of an error body that is kept.
RETRIED = frozenset({409, 429, 502, 503, 504})
SNIPPET = 300


def snippet(body: str) -> str:
    """What can be read of an error body."""
    bare = re.sub(r"(?is)<(style|script)\b.*?</\1>|<[^>]+>", " ", body)
    return " ".join(bare.split())[:SNIPPET]


class Refused(Exception):
    """An answer that no further try would change, or the last of the tries."""

    def __init__(self, url: str, status: int | None, reason: str):
        super().__init__(f"{url}: {status or 'no answer'}: {reason}")
        self.url, self.status = url, status

    @property
    def transient(self) -> bool:
        """A later run may fare better: network trouble and server errors, not what the source does not have."""
        return self.status not in (404, 410)


class Rate:
    """At most so many requests a second, over all threads that share it."""

    def __init__(self, per_second: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap = 1 / per_second if per_second > 0 else 0.0
        self.clock, self.sleep, self.lock, self.next = clock, sleep, threading.Lock(), 0.0

    def wait(self) -> None:
        with self.lock:
            now = self.clock()
            start = max(now, self.next)
            self.next = start + self.gap
        if start > now:
            self.sleep(start - now)


@dataclass
class Answer:
    body: bytes
    status: int = 200
    headers: dict[str, str] = field(default_factory=dict)
    cached: bool = False


@dataclass
class Client:
    """GET and POST under one rate; waits double between tries."""

    rate: float = 2.0
    tries: int = 3
    timeout: float = 30.0
    headers: dict[str, str] = field(default_factory=lambda: {"User-Agent": "lexloom"})
    open_url: Callable = urllib.request.urlopen
    sleep: Callable[[float], None] = time.sleep

    def __post_init__(self):
        self._rate = Rate(self.rate, sleep=self.sleep)

    def get(self, url: str, headers: dict[str, str] | None = None) -> Answer:
        return self._ask(url, None, headers)

    def post(self, url: str, body: bytes | dict, headers: dict[str, str] | None = None) -> Answer:
        data, kind = (json.dumps(body).encode(), {"Content-Type": "application/json"}) if isinstance(body, dict) else (body, {})
        return self._ask(url, data, kind | (headers or {}))

    def _ask(self, url: str, data: bytes | None, headers: dict[str, str] | None) -> Answer:
        for attempt in range(self.tries):
            self._rate.wait()
            last = attempt + 1 == self.tries
            try:
                with self.open_url(urllib.request.Request(url, data, self.headers | (headers or {})), timeout=self.timeout) as got:
                    return Answer(got.read(), got.status, dict(got.headers.items()))
            except urllib.error.HTTPError as error:
                if error.code == 304:
                    return Answer(b"", 304, dict(error.headers.items()))
                if last or error.code not in RETRIED:
                    raise Refused(url, error.code, snippet(error.read().decode("utf-8", "replace"))) from error
            except urllib.error.URLError as error:
                if last:
                    raise Refused(url, None, str(error.reason)) from error
            self.sleep(2**attempt)
        raise Refused(url, None, "no try was made")

    def fresh(self, url: str, cache: Cache) -> Answer:
        """From the cache while it is young; then asked for only if it changed since."""
        held = cache.get(url)
        if held is not None:
            return held
        old = cache.get(url, any_age=True)
        known = {name: old.headers[tag] for name, tag in (("If-None-Match", "ETag"), ("If-Modified-Since", "Last-Modified")) if old and old.headers.get(tag)}
        got = self.get(url, known)
        if got.status == 304 and old is not None:
            cache.put(url, old.body, old.headers)
            return Answer(old.body, 304, old.headers, cached=True)
        cache.put(url, got.body, got.headers)
        return got


class Cache:
    """Answers by URL: a body and a record of its headers and time, under sixteen digits of the URL's hash."""

    def __init__(self, folder: str, hours: float = 24, now: Callable[[], float] = time.time):
        self.fs, self.folder = (pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", folder)) if "://" not in folder or folder.startswith("file:") else pafs.FileSystem.from_uri(folder)
        self.seconds, self.now = hours * 3600, now
        self.fs.create_dir(self.folder, recursive=True)

    def _path(self, url: str, kind: str) -> str:
        return f"{self.folder}/{hashlib.sha256(url.encode()).hexdigest()[:16]}.{kind}"

    def _read(self, path: str) -> bytes | None:
        if self.fs.get_file_info(path).type != pafs.FileType.File:
            return None
        with self.fs.open_input_file(path) as file:
            return file.read()

    def _write(self, path: str, data: bytes) -> None:
        part = f"{path}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part, compression=None) as out:
            out.write(data)
        self.fs.move(part, path)

    def get(self, url: str, any_age: bool = False) -> Answer | None:
        record = self._read(self._path(url, "json"))
        about = json.loads(record) if record else None
        if about is None or not any_age and self.now() - about["at"] > self.seconds:
            return None
        body = self._read(self._path(url, about["digest"]))
        return None if body is None else Answer(body, 200, about["headers"], cached=True)

    def put(self, url: str, body: bytes, headers: dict[str, str]) -> None:
        """The body goes first, under its digest; the record that names it then replaces the one before."""
        digest = hashlib.sha256(body).hexdigest()[:16]
        self._write(self._path(url, digest), body)
        self._write(self._path(url, "json"), json.dumps({"url": url, "headers": headers, "at": self.now(), "digest": digest}).encode())

    def invalidate(self, url: str) -> None:
        stem = self._path(url, "")
        for x in self.fs.get_file_info(pafs.FileSelector(self.folder)):
            if x.path.startswith(stem):
                self.fs.delete_file(x.path)

    def clear(self) -> None:
        self.fs.delete_dir_contents(self.folder)


def halved(keys: list, ask: Callable[[list], list], cap: int) -> list:
    """All rows for ``keys`` from a source that cuts its answers at ``cap`` rows.

    A full answer may be a cut one, so its keys are asked for in halves, and a single key whose answer
    is full is an error: its rest cannot be had.
    """
    out, left = [], [keys] if keys else []
    while left:
        own = left.pop()
        rows = ask(own)
        if len(rows) < cap:
            out += rows
        elif len(own) == 1:
            raise ValueError(f"{own[0]!r}: an answer of {cap} rows may be cut")
        else:
            left += [own[len(own) // 2 :], own[: len(own) // 2]]
    return out


def probed(ask: Callable[[int], object | None], start: int = 1, misses: int = 5) -> list:
    """What a numbered source has from ``start`` on, until so many numbers in a row are missing."""
    out, number, missed = [], start, 0
    while missed < misses:
        got = ask(number)
        missed = missed + 1 if got is None else 0
        out += [] if got is None else [got]
        number += 1
    return out
