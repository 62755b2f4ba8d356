"""The operators' queries and, where SQL can express them, their SQL."""

from tidepool.llm import bpe, decontamination, exact_dedup, filter_audit, hard_negatives, jaccard_join, language_id, line_dedup, mixing, pii, repeated_bytes, sharding, url_filter

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_pii": pii.op2_pii,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_sharding": sharding.op4_sharding,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_language_id": language_id.op7_language_id,
    "op8_mixing": mixing.op8_mixing,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_repeated_bytes": repeated_bytes.op10_repeated_bytes,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_bpe": bpe.op12_bpe,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLE = {
    "op1_url_filter": url_filter.OP1_SQL,
    "op3_line_dedup": line_dedup.OP3_SQL,
    "op5_jaccard_join": jaccard_join.OP5_SQL,
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
