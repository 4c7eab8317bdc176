"""The corpus queries by name, and the SQL of those that SQL can express."""

from lexloom.llm import byte_bpe, exact_dedup, license_scan, line_dedup, packing, quality_model, quality_rules, simhash, token_counts, warc

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_packing": packing.op2_packing,
    "op3_quality_model": quality_model.op3_quality_model,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_warc": warc.op6_warc,
    "op7_simhash_near_dedup": simhash.op7_simhash_near_dedup,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_byte_bpe": byte_bpe.op9_byte_bpe,
    "op10_quality_rules": quality_rules.op10_quality_rules,
}

ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op4_exact_dedup": exact_dedup.ORACLE_SQL,
    "op6_warc": warc.ORACLE_SQL,
}
