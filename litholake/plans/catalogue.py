"""All core queries by name."""

from __future__ import annotations

from litholake.plans import design_queries, problems_core, reference_queries

FLAGSHIP = "q20_hierarchical_loss"
QUERIES = dict(problems_core.QUERIES) | dict(reference_queries.QUERIES) | dict(design_queries.QUERIES)
ORACLES: dict[str, str] = dict(problems_core.ORACLES) | dict(reference_queries.ORACLES) | dict(design_queries.ORACLES)
