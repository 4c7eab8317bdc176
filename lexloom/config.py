"""Settings of a run: a YAML file, or JSON, with overrides by dotted name."""

from __future__ import annotations

import json
import os

try:
    import yaml
except ImportError:
    yaml = None

DEFAULTS = {"lookback_days": 10, "chunk_events": 25_000, "slice_events": 2_000, "skip_weekdays": [], "max_pages_without_new": 200}


def set_nested(settings: dict, name: str, value) -> None:
    """``a.b.c`` names a value inside mappings, which are made where they are missing."""
    *path, last = name.split(".")
    for part in path:
        below = settings.get(part)
        if not isinstance(below, dict):
            below = settings[part] = {}
        settings = below
    settings[last] = value


def load(path: str | None = None, overrides: dict | None = None) -> dict:
    """The defaults, what a file says, and the overrides that are not None, in this order; a missing file says nothing."""
    settings = json.loads(json.dumps(DEFAULTS))
    if path and os.path.exists(path):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        said = (json.loads(text) if yaml is None or path.endswith(".json") else yaml.safe_load(text)) or {}
        settings |= said
    for name, value in (overrides or {}).items():
        if value is not None:
            set_nested(settings, name, value)
    return settings


def of_source(settings: dict, code: str) -> dict:
    """The settings of one source: its own over the general ones."""
    general = {k: v for k, v in settings.items() if k != "sources"}
    return general | (settings.get("sources") or {}).get(code, {})
