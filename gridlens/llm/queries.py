"""Queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from gridlens.llm import chat_format, decontaminate, license_scan, mixing, quality_nb, quality_rules, simhash, suffix_dedup, token_counts, url_filter


def queries() -> dict:
    return {
        "op1_license_scan": license_scan.query,
        "op2_chat_format": chat_format.query,
        "op3_token_counts": token_counts.query,
        "op4_suffix_dedup": suffix_dedup.query,
        "op5_simhash": simhash.query,
        "op6_quality_nb": quality_nb.query,
        "op7_decontamination": decontaminate.query,
        "op8_url_filter": url_filter.query,
        "op9_mixing": mixing.query,
        "op10_quality_rules": quality_rules.query,
    }


def oracle_sql() -> dict:
    return {
        "op2_chat_format": chat_format.ORACLE,
        "op8_url_filter": url_filter.ORACLE,
        "op9_mixing": mixing.ORACLE,
    }
