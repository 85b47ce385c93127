"""The registered query of each training-data operator, and its SQL where SQL can express it."""

from __future__ import annotations

from vecflow.llm import decontam, html_text, jaccard_join, langid, order_minhash, packing, pii, secrets, spelling, suffix_dedup, token_store, urlfilter, vector_codes

_QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_token_files": token_store.op2_token_files,
    "op3_order_minhash": order_minhash.op3_order_minhash,
    "op4_pii": pii.op4_pii,
    "op5_decontamination": decontam.op5_decontamination,
    "op6_secret_scans": secrets.op6_secret_scans,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_language_id": langid.op8_language_id,
    "op9_packing": packing.op9_packing,
    "op10_url_filters": urlfilter.op10_url_filters,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_html_text": html_text.op13_html_text,
}
_SQL: dict[str, str] = {"op5_decontamination": decontam.OP5_SQL, "op6_secret_scans": secrets.OP6_SQL, "op10_url_filters": urlfilter.OP10_SQL}


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
