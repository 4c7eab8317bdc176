"""Markdown documents and their headers from ordered blocks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: How a block of each kind is written.
FORMATS = {"h1": "# %s", "h2": "## %s", "h3": "### %s", "li": "- %s", "blockquote": "> %s", "title": "# %s"}


def block(kind: Column, text: Column) -> Column:
    out = None
    for name, form in FORMATS.items():
        lead = F.concat(F.lit(form.replace("%s", "")), text)
        out = F.when(kind == name, lead) if out is None else out.when(kind == name, lead)
    return out.otherwise(text)


def front_matter(**fields: Column) -> Column:
    """Keys in the order given, unknown ones left out, fenced."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v)) for k, v in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---"))
