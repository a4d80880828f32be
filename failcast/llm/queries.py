"""The subpackage's queries and their DuckDB SQL."""

from __future__ import annotations

from failcast.llm import fingerprints, lexical, licenses, line_dedup, media, mixing, packing, personal, simhash, suffix_dedup, token_counts, toxicity, vector_codes

QUERIES = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_licenses": licenses.op2_licenses,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_media": media.op4_media,
    "op5_packing": packing.op5_packing,
    "op6_simhash": simhash.op6_simhash,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_mixing": mixing.op9_mixing,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_pii": personal.op12_pii,
    "op13_search": lexical.op13_search,
    "conversation_packing": packing.conversation_packing,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_licenses": licenses.oracle_sql(),
        "op3_suffix_dedup": suffix_dedup.OP3_SQL,
        "op10_line_dedup": line_dedup.OP10_SQL,
        "op11_vector_codes": vector_codes.oracle_sql(),
        "op12_pii": personal.oracle_sql(),
        "op13_search": lexical.OP13_SQL,
    }
