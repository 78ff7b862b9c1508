"""Queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from . import (decontaminate, html_text, language, lines, mixing, near, period_runs, pii, quality, search,
               secret_scan, suffixes, token_counts)

QUERIES = {
    "op1_line_dedup": lines.op1_line_dedup,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_ngram_jaccard_join": near.op3_ngram_jaccard_join,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_personal_data": pii.op5_personal_data,
    "op6_suffix_dedup": suffixes.op6_suffix_dedup,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op8_html_extraction": html_text.op8_html_extraction,
    "op9_mixing": mixing.op9_mixing,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_language_id": language.op11_language_id,
    "op12_lexical_search": search.op12_lexical_search,
    "op13_period_runs": period_runs.op13_period_runs,
}

#: The others have no statement: they are tested by brute force or held-out rows.
ORACLES = {
    "op1_line_dedup": lines.ORACLE,
    "op2_quality_rules": quality.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op12_lexical_search": search.ORACLE,
}
