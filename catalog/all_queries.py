"""Everything that is registered."""

from catalog import model_queries, page_queries, source_queries, review_queries, text_queries  # noqa: F401
from catalog.registry import ORACLE, QUERIES  # noqa: F401
