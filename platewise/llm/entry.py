"""What ``__spark_entry__`` adds to its queries."""

from __future__ import annotations

import corpus_pipeline
import platewise.llm.queries  # noqa: F401  (registers)
from platewise.llm.registry import ORACLES, QUERIES


def llm_queries() -> dict:
    return QUERIES | {"pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
