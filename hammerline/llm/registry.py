"""The named queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversation_trie, decontam, html_text, langid, license_scan, line_runs, packing, pii, simhash, token_alignment, topk, toxicity, url_cascade
from .shared import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_url_filter": lambda s, d: url_cascade.op1_url_filter(table(s, d, "pages")),
        "op2_toxicity": lambda s, d: toxicity.op2_toxicity(table(s, d, "documents"), table(s, d, "labels")),
        "op3_best_fit_packing": lambda s, d: packing.op3_best_fit_packing(table(s, d, "documents")),
        "op4_personal_data": lambda s, d: pii.op4_personal_data(table(s, d, "documents")),
        "op5_simhash": lambda s, d: simhash.op5_simhash(table(s, d, "documents")),
        "op6_line_dedup": lambda s, d: line_runs.op6_line_dedup(table(s, d, "documents")),
        "op7_html_text": lambda s, d: html_text.op7_html_text(table(s, d, "pages")),
        "op8_decontamination": lambda s, d: decontam.op8_decontamination(
            table(s, d, "documents"), table(s, d, "benchmark")
        ),
        "op9_exact_topk": lambda s, d: topk.op9_exact_topk(table(s, d, "embeddings")),
        "op10_language_id": lambda s, d: langid.op10_language_id(table(s, d, "documents")),
        "op11_token_alignment": lambda s, d: token_alignment.op11_token_alignment(table(s, d, "documents")),
        "op12_license_scan": lambda s, d: license_scan.op12_license_scan(table(s, d, "documents")),
        "op13_conversation_trie": lambda s, d: conversation_trie.op13_conversation_trie(table(s, d, "conversations")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": url_cascade.OP1_SQL,
        "op6_line_dedup": line_runs.OP6_SQL,
        "op9_exact_topk": topk.OP9_SQL,
        "op12_license_scan": license_scan.OP12_SQL,
        "op13_conversation_trie": conversation_trie.OP13_SQL,
    }
