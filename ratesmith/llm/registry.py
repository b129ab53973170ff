"""Queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from . import alignment, chosen_path, decontaminate, html_extract, jaccard_join, license_scan, mixing, phrases, quality, substring_dedup, token_output, topk_search, warc

QUERIES = {
    "op1_importance_resampling": quality.op1_importance_resampling,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_html_extraction": html_extract.op3_html_extraction,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_temperature_mixing": mixing.op5_temperature_mixing,
    "op6_token_output": token_output.op6_token_output,
    "op7_warc": warc.op7_warc,
    "op8_license_scan": license_scan.op8_license_scan,
    "op9_topk_search": topk_search.op9_topk_search,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_tokenizer_alignment": alignment.op11_tokenizer_alignment,
    "op12_minhash_near_dedup": chosen_path.op12_minhash_near_dedup,
    "op13_phrase_collocations": phrases.op13_phrase_collocations,
}
ORACLES = {**substring_dedup.ORACLE, **warc.ORACLE, **topk_search.ORACLE, **decontaminate.ORACLE, **phrases.ORACLE}
