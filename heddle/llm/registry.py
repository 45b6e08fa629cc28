"""Queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from heddle.llm import decontaminate, embeddings, lines, mixing, ngrams, pages, pii, simhash, tokens, toxicity

MODULES = (simhash, mixing, embeddings, toxicity, pii, ngrams, decontaminate, pages, tokens, lines)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}
