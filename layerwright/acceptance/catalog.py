"""All registered queries."""

from __future__ import annotations

from layerwright.acceptance import daily, feeds, messages, models, relational, runs, scalars

_PARTS = (daily, models, relational, scalars, feeds, messages, runs)

QUERIES = {name: q for part in _PARTS for name, q in part.registry.queries.items()}
SQL = {name: s for part in _PARTS for name, s in part.registry.sql.items()}
