"""XML that is read as it arrives: headers of large documents, and records of files too large for a tree."""

from __future__ import annotations

import io
from collections.abc import Iterator
from xml.parsers import expat

from pyspark.sql.functions import udtf

CHUNK = 1 << 14


class _Enough(Exception):
    pass


def header(stream, wanted: tuple[str, ...], until: str) -> dict[str, str]:
    """The first text of each wanted element that stands before the element ``until`` begins; no more is read."""
    found, open_, text = {}, [], []
    parser = expat.ParserCreate()

    def start(tag, attrs):
        name = tag.rpartition(":")[2]
        if name == until:
            raise _Enough
        open_.append(name)
        text.clear()

    def end(tag):
        name = open_.pop()
        if name in wanted and name not in found:
            found[name] = " ".join("".join(text).split())
        text.clear()
        if len(found) == len(wanted):
            raise _Enough

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text.append
    try:
        while chunk := stream.read(CHUNK):
            parser.Parse(chunk, False)
    except (_Enough, expat.ExpatError):
        pass
    return found


def records(stream, tag: str) -> Iterator[dict[str, str]]:
    """The attributes of each element ``tag`` and the texts of the elements inside, one record in memory at a time.

    Attributes of inner elements are under ``element@attribute``; of what repeats the first counts.  A broken
    file gives the records before the break.
    """
    ready, depth, text, path = [], [0], [], []
    record: dict[str, str] = {}
    parser = expat.ParserCreate()

    def start(name, attrs):
        name = name.rpartition(":")[2]
        if depth[0] or name == tag:
            depth[0] += 1
            path.append(name)
            text.clear()
            for k, v in attrs.items():
                record.setdefault(k if depth[0] == 1 else f"{name}@{k}", v)

    def end(name):
        if depth[0]:
            depth[0] -= 1
            inner = path.pop()
            value = " ".join("".join(text).split())
            if value:
                record.setdefault(inner if depth[0] else "", value)
            text.clear()
            if not depth[0]:
                ready.append(dict(record))
                record.clear()

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text.append
    broken = False
    while not broken and (chunk := stream.read(CHUNK)):
        try:
            parser.Parse(chunk, False)
        except expat.ExpatError:
            broken = True
        yield from ready
        ready.clear()


@udtf(returnType="record map<string,string>")
class XmlRecords:
    """A row for each element of a name in a file's bytes."""

    def eval(self, content: bytes, tag: str) -> Iterator[tuple[dict[str, str]]]:
        for record in records(io.BytesIO(bytes(content or b"")), tag):
            yield (record,)
