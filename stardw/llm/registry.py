"""Queries of the subpackage and their SQL counterparts."""

from __future__ import annotations

from stardw.llm import (bpe_tree, chat_format, decontaminate, fp_search, html_extract,
                        jaccard_join, lm_scoring, mixing, quality_rules, suffix_dedup,
                        token_counts, weak_labels, whitening)

_MODULES = [suffix_dedup, quality_rules, token_counts, weak_labels, jaccard_join, html_extract,
            chat_format, decontaminate, lm_scoring, mixing, whitening, bpe_tree,
            fp_search]


def queries() -> dict:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def statements() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLE", {}).items()}
