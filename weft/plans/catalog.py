"""All core queries by name."""

from __future__ import annotations

from weft.plans import linkage, oracle, skew

FLAGSHIP = "candidate_rank"

QUERIES = {**linkage.QUERIES, **skew.QUERIES}
ORACLE = {**oracle.ORACLE, **skew.ORACLE}
