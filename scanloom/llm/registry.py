"""Queries of the text operators and their SQL."""

from __future__ import annotations

from scanloom.llm import bpe, ctw, decontaminate, fingerprints, jaccard, licenses, lines, quality, runs, search, sequences, substrings, toxicity

QUERIES = {
    "op1_fingerprints": fingerprints.op1,
    "op2_line_dedup": lines.op2,
    "op3_jaccard_join": jaccard.op3,
    "op4_bpe": bpe.op4,
    "op5_decontamination": decontaminate.op5,
    "op6_substring_dedup": substrings.op6,
    "op7_ctw": ctw.op7,
    "op8_toxicity": toxicity.op8,
    "op9_license_scan": licenses.op9,
    "op10_quality": quality.op10,
    "op11_periodic_runs": runs.op11,
    "op12_ranked_search": search.op12,
    "op13_token_sequences": sequences.op13,
}
ORACLE: dict[str, str] = {
    "op2_line_dedup": lines.OP2_SQL,
    "op3_jaccard_join": jaccard.OP3_SQL,
    "op6_substring_dedup": substrings.OP6_SQL,
    "op12_ranked_search": search.OP12_SQL,
}
