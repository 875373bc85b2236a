"""The queries of this subpackage and the SQL that some of them are held against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from aridspan.llm import decontamination, language_id, license_scan, line_rules, near_duplicates, oracles, packing, prefix_trie, private_data, quality_model, repeated_text, structure_repair, token_counts, url_filter
from aridspan.llm.common import prepared


def shipped(query: Callable) -> Callable:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepared(spark), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = {
        "op1_token_counts": token_counts.query,
        "op2_line_rules": line_rules.query,
        "op3_packing": packing.query,
        "op4_private_data": private_data.query,
        "op5_language_id": language_id.query,
        "op6_url_filter": url_filter.query,
        "op7_decontamination": decontamination.query,
        "op8_repeated_text": repeated_text.query,
        "op9_near_duplicates": near_duplicates.query,
        "op10_license_scan": license_scan.query,
        "op11_quality_model": quality_model.query,
        "op12_prefix_trie": prefix_trie.query,
        "op13_structure_repair": structure_repair.query,
    }
    return {name: shipped(query) for name, query in every.items()}


def oracle_sql() -> dict[str, str]:
    """Trained, fuzzy and tokenizer-based operators, and those whose results depend on a place of one's choice, have none."""
    rules = oracles.line_rules(
        line_rules.SEPARATORS.pattern.decode(),
        line_rules.PHRASES.pattern.decode(),
        [w.decode() for w in line_rules.MENU_WORDS],
        line_rules.ENDS.decode() + "".join(w.decode() for w in line_rules.WIDE_ENDS),
    )
    return {
        "op1_token_counts": token_counts.ORACLE_SQL,
        "op2_line_rules": rules,
        "op6_url_filter": url_filter.ORACLE_SQL,
        "op7_decontamination": oracles.DECONTAMINATION,
        "op8_repeated_text": oracles.REPEATED_TEXT,
        "op9_near_duplicates": oracles.NEAR_DUPLICATES,
        "op12_prefix_trie": oracles.PREFIX_TRIE,
        "op13_structure_repair": oracles.STRUCTURE_REPAIR,
    }
