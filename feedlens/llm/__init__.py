"""Corpus operators for training-data pipelines.  Nothing else in the library imports this."""

from __future__ import annotations

from feedlens.llm import (byte_bpe, fingerprints, licenses, line_crf, mixing, near_dups, packing, pii, prefix_trie, substrings,
                          token_counts, toxicity, whitening)

_MODULES = [pii, line_crf, fingerprints, toxicity, token_counts, mixing, substrings, byte_bpe, near_dups, licenses, packing,
            whitening, prefix_trie]


def queries() -> dict:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
