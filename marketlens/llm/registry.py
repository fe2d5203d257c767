"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from . import (
    bpe, chat_format, html_extract, knn_join, language_id, order_minhash, packing, quality_rules, ranked_search,
    repeated_windows, source_divergence, toxicity, url_filters,
)

OPERATORS = {
    "op1_order_minhash": order_minhash,
    "op2_bpe": bpe,
    "op3_language_id": language_id,
    "op4_url_filters": url_filters,
    "op5_repeated_windows": repeated_windows,
    "op6_knn_join": knn_join,
    "op7_html_extract": html_extract,
    "op8_chat_format": chat_format,
    "op9_quality_rules": quality_rules,
    "op10_packing": packing,
    "op11_ranked_search": ranked_search,
    "op12_source_divergence": source_divergence,
    "op13_toxicity": toxicity,
}


def queries() -> dict:
    return {name: module.query for name, module in OPERATORS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.oracle() for name, module in OPERATORS.items() if hasattr(module, "oracle")}
