"""Named queries over the test tables, each with an independent SQL statement where SQL can say it."""

from formline.suite import columns, enrichment, evaluation, profiling, quality, selection, series, storage  # noqa: F401
from formline.suite.registry import QUERIES

__all__ = ["QUERIES"]
