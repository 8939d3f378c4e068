"""Streaming forms of the jobs (the reference itself is batch only)."""

from .incremental import reports_from_store, start_decoding

__all__ = ["reports_from_store", "start_decoding"]
