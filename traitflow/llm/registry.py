"""Registered queries and DuckDB SQL of the training-data operators."""

from traitflow.llm import op1_substrings, op2_decontamination, op3_licenses, op4_jaccard, op5_html, op6_rules, op7_mixing, op8_secrets, op9_quality, op10_lm, op11_alignment, op12_bpe, op13_phrases

QUERIES = {
    "op1_substrings": op1_substrings.query,
    "op2_decontamination": op2_decontamination.query,
    "op3_licenses": op3_licenses.query,
    "op4_jaccard": op4_jaccard.query,
    "op5_html": op5_html.query,
    "op6_rules": op6_rules.query,
    "op7_mixing": op7_mixing.query,
    "op8_secrets": op8_secrets.query,
    "op9_quality": op9_quality.query,
    "op10_lm": op10_lm.query,
    "op11_alignment": op11_alignment.query,
    "op12_bpe": op12_bpe.query,
    "op13_phrases": op13_phrases.query,
}

ORACLE = {
    "op1_substrings": op1_substrings.ORACLE,
    "op2_decontamination": op2_decontamination.ORACLE,
    "op4_jaccard": op4_jaccard.ORACLE,
    "op7_mixing": op7_mixing.ORACLE,
    "op13_phrases": op13_phrases.ORACLE,
}
