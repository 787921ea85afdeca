"""Increments picked up as they land."""

from .increments import upsert_stream

__all__ = ["upsert_stream"]
