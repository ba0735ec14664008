"""recsmith: batch recommendation and conversion analytics on Spark DataFrames.

Layout
------
sources/    readers for the text layouts, sinks, and the test-table views
functions/  column expressions: packed-list parsing, scoring, boosts
operators/  DataFrame -> DataFrame building blocks (filters, recall, caps, re-rank)
plans/      the four end-to-end jobs (conversion report, three recall routes)
"""

from recsmith.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
