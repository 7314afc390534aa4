"""Extracts that keep arriving."""

from .landing import materialize_stream

__all__ = ["materialize_stream"]
