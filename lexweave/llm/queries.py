"""Queries of the problems on texts, and the SQL that checks them where SQL can."""

from __future__ import annotations

from . import q_language, q_leakage, q_texts, q_tokens

_MODULES = [q_tokens, q_texts, q_leakage, q_language]
QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLES", {}).items()}
