"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from tidemark.llm import exact_dedup, lm_scoring, merkle_manifest, mixing, ngram_join, periodic_runs, quality, sentencepieces, simhash, substring_dedup, suffix_dedup, token_files, url_filters

MODULES = (sentencepieces, quality, ngram_join, url_filters, suffix_dedup, exact_dedup, token_files, lm_scoring, mixing, substring_dedup, merkle_manifest, simhash, periodic_runs)

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
