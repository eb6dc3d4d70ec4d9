"""All queries of the engine, by name, and their SQL."""

from __future__ import annotations

from . import cleaning_queries, frame_queries, network_queries, score_queries, slice_queries

_MODULES = (cleaning_queries, slice_queries, score_queries, network_queries, frame_queries)
QUERIES = {n: q for m in _MODULES for n, q in m.QUERIES.items()}
ORACLES = {n: q for m in _MODULES for n, q in m.ORACLES.items()}
