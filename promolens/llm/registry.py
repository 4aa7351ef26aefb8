"""Queries and DuckDB SQL of the training-data operators."""

from __future__ import annotations

from promolens.llm import bpe, graph, jaccard, licenses, lines, mixer, mixing, outliers, phrases, quality, spotsigs, variants, warc

MODULES = (mixer, bpe, licenses, warc, mixing, quality, lines, spotsigs, graph, jaccard, variants, phrases, outliers)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: q for m in MODULES for k, q in m.ORACLES.items()}
