"""Inputs: CSV files, the test-table stand-in, and stored warehouse tables."""

from starmart.sources.raw import RawSources

__all__ = ["RawSources"]
