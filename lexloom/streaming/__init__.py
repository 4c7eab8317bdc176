"""Incremental processing: day cursors, idempotent sinks, late and pending events."""
