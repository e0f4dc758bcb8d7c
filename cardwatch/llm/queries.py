"""All queries of this package."""

from __future__ import annotations

from cardwatch.llm import (  # noqa: F401
    embedding_dedup,
    hard_negatives,
    langid,
    merkle,
    packing,
    quality_model,
    quality_rules,
    secret_scan,
    sentence_pieces,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
)
from cardwatch.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
