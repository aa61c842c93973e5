"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from coverlens.llm import (
    chat_format,
    context_tree,
    decontaminate,
    embedding_dedup,
    hard_negatives,
    html_extract,
    language_id,
    line_dedup,
    merkle_manifest,
    mixing,
    ngram_join,
    url_filter,
    warc_fixity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": url_filter.op1_url_filters,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_warc_fixity": warc_fixity.op4_warc_fixity,
    "op5_embedding_dedup": embedding_dedup.op5_embedding_dedup,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_language_id": language_id.op7_language_id,
    "op8_ngram_jaccard": ngram_join.op8_ngram_jaccard,
    "op9_html_extract": html_extract.op9_html_extract,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_merkle_manifest": merkle_manifest.op11_merkle_manifest,
    "op12_lm_scoring": context_tree.op12_lm_scoring,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

#: Queries whose rows SQL can state; the others are tested against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op1_url_filters": url_filter.OP1_SQL,
    "op2_chat_format": chat_format.OP2_SQL,
    "op4_warc_fixity": warc_fixity.OP4_SQL,
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op10_decontamination": decontaminate.OP10_SQL,
    "op11_merkle_manifest": merkle_manifest.OP11_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
