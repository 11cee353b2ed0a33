"""Operators of a training-data pipeline and their registered queries."""

from __future__ import annotations

from rastertab.llm import (decontamination, fill_middle, mixing, packing, quality_rules, simhash, substring_dedup, suffix_dedup,
                           token_files, top_k, toxicity, url_filter, whitening)

QUERIES = {
    "op1_top_k": top_k.query,
    "op2_token_files": token_files.query,
    "op3_quality_rules": quality_rules.query,
    "op4_substring_dedup": substring_dedup.query,
    "op5_suffix_dedup": suffix_dedup.query,
    "op6_simhash": simhash.query,
    "op7_toxicity": toxicity.query,
    "op8_url_filter": url_filter.query,
    "op9_packing": packing.query,
    "op10_mixing": mixing.query,
    "op11_fill_middle": fill_middle.query,
    "op12_whitening": whitening.query,
    "op13_decontamination": decontamination.query,
}

ORACLES = {
    "op1_top_k": top_k.ORACLE,
    "op3_quality_rules": quality_rules.ORACLE,
    "op4_substring_dedup": substring_dedup.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_fill_middle": fill_middle.ORACLE,
    "op13_decontamination": decontamination.ORACLE,
}
