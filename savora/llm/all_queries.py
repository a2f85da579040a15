"""Everything this package registers."""

from savora.llm import (  # noqa: F401
    alignment_queries, bpe_queries, chat_queries, classifier_queries, decontamination_queries, divergence_queries, license_queries, near_duplicate_queries, quality_queries, repeat_queries, search_queries, secret_queries, warc_queries,
)
from savora.llm.queries import ORACLE, QUERIES  # noqa: F401
