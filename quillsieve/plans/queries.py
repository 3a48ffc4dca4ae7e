"""All registered queries and their SQL."""

from quillsieve.plans import news_queries, page_queries  # noqa: F401
from quillsieve.plans.catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
