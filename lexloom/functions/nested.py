"""Arrays, maps, JSON, hashes and paths."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, functions as F
from pyspark.sql.functions import udtf


def one_or_many(text: Column, element: str = "string") -> Column:
    """A JSON value that is one element or a list of them."""
    return F.when(F.left(F.trim(text), F.lit(1)) == "[", F.from_json(text, f"array<{element}>")).otherwise(F.array(F.from_json(text, element) if element.startswith("struct") else text))


def merged(core: Column, extra: Column) -> Column:
    """Both maps; keys of ``core`` are not shadowed."""
    return F.map_concat(core, F.map_filter(extra, lambda k, _: ~F.map_contains_key(core, k)))


def present(values: Column) -> Column:
    return F.map_filter(values, lambda _, v: v.isNotNull())


def sha_bucket(key: Column) -> Column:
    return F.left(F.sha1(key.cast("binary")), F.lit(2))


def blob_hash(content: Column) -> Column:
    """The hash a content-addressed store gives a blob: a header with the byte length, then the bytes."""
    raw = content.cast("binary")
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.length(raw).cast("string")), "UTF-8"), F.unhex(F.lit("00")), raw))


def path_of(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places; an empty value, a dot segment or a separator in one is an error."""
    out = F.lit(template)
    for name, value in values.items():
        bad = (value == "") | value.rlike(r"[/\\\x00]") | value.isin(".", "..")
        safe = F.when(bad | value.isNull(), F.raise_error(F.concat(F.lit(f"{name} cannot be part of a path: "), F.coalesce(value, F.lit("null"))))).otherwise(value)
        out = F.replace(out, F.lit("{" + name + "}"), safe)
    return out


@udtf(returnType="path string, value string", useArrow=False)
class JsonPaths:
    """Every scalar of a JSON text with its dotted path; list members share the path of the list."""

    def eval(self, text: str) -> Iterator[tuple[str, str]]:
        import json

        def walk(value, path: str):
            if isinstance(value, dict):
                for k, v in value.items():
                    yield from walk(v, f"{path}.{k}" if path else k)
            elif isinstance(value, list):
                for v in value:
                    yield from walk(v, path)
            elif value is not None and not isinstance(value, bool):
                yield path, str(value)

        if text:
            yield from walk(json.loads(text), "")
