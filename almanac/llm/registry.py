"""Names of the corpus queries, their functions and, where SQL can say it, their SQL."""

from __future__ import annotations

import corpus_pipeline
from almanac.llm import (
    byte_bpe,
    conversation_repair,
    fingerprints,
    html_text,
    licenses,
    line_dedup,
    mixing,
    periodic_runs,
    piece_counts,
    quality,
    simhash,
    toxicity,
    vector_search,
)

_MODULES = (
    toxicity, fingerprints, mixing, piece_counts, licenses, html_text, simhash, byte_bpe, vector_search, line_dedup,
    quality, conversation_repair, periodic_runs,
)


def queries() -> dict:
    found = {name: function for module in _MODULES for name, function in module.QUERIES.items()}
    return found | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    found = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
