"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

from ..ship import shipped

_MODULES = {
    "op1_packing": "packing",
    "op2_html_extraction": "html_extraction",
    "op3_ngram_jaccard_join": "jaccard_join",
    "op4_token_counts": "token_counts",
    "op5_benchmark_decontamination": "decontamination",
    "op6_quality_rules": "quality_rules",
    "op7_sharding": "sharding",
    "op8_token_store": "token_store",
    "op9_suffix_array_dedup": "suffix_dedup",
    "op10_lm_scoring": "lm_scoring",
    "op11_nearest_neighbours": "nearest_neighbours",
    "op12_fill_in_middle": "fill_in_middle",
    "op13_conversation_trie": "conversation_trie",
}


def queries() -> dict:
    return {name: shipped(getattr(importlib.import_module(f"{__package__}.{module}"), name)) for name, module in _MODULES.items()}


def oracle_sql() -> dict:
    from . import conversation_trie, decontamination, fill_in_middle

    return {"op5_benchmark_decontamination": decontamination.ORACLE_SQL, "op12_fill_in_middle": fill_in_middle.ORACLE_SQL, "op13_conversation_trie": conversation_trie.ORACLE_SQL}
