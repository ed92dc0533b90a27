"""Tidemark: layered (raw, clean, serving) data pipelines and analytics on PySpark.

Everything is a function from DataFrames to DataFrames. Clocks, roles and run
identifiers are arguments, never hidden session state.
"""

from tidemark.schemas import FEEDS, Feed

__all__ = ["FEEDS", "Feed"]
