"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from strataloom.llm import chat, clusters, codes, html, leaks, lines, mixing, ngrams, pieces, quantised, simhash, topk, toxicity

_MODULES = [quantised, html, lines, ngrams, pieces, chat, simhash, topk, mixing, toxicity, leaks, clusters, codes]

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in m.ORACLES.items()}
