"""The queries of this package by name, and their SQL where there is one."""

from __future__ import annotations

from ledgersync.llm import byte_language, hard_negatives, licences, mixing, pieces, prefix_trie, quotes, sharding, shingle_join, token_files, topk, vector_dedup, wrappers

_MODULES = (quotes, shingle_join, wrappers, pieces, byte_language, topk, licences, mixing, token_files, vector_dedup, prefix_trie, hard_negatives, sharding)
QUERIES = {name: build for m in _MODULES for name, build in m.QUERIES.items()}
SQL = {name: text for m in _MODULES for name, text in m.SQL.items()}
