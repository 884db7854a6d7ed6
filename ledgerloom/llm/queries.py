"""All queries of this subpackage, imported for their registration."""

import corpus_pipeline
from ledgerloom.llm import (  # noqa: F401
    queries_conversations,
    queries_native,
    queries_text,
    queries_vectors,
)
from ledgerloom.llm.registry import ORACLES, QUERIES, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

__all__ = ["ORACLES", "QUERIES"]
