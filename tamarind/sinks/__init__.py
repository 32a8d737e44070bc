"""Warehouse loads (K1-K6)."""

from tamarind.sinks.warehouse import align_to_schema, append, load, upsert, upsert_frame  # noqa: F401
