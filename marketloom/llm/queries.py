"""The queries of this subpackage, and their SQL where SQL can express them."""

from marketloom.llm import conversations, hard_negatives, licenses, media, mixing, near_dedup, packing, quality_rules, secret_scans, sharding, token_counts, toxicity, warc

QUERIES = {
    f.__name__: f
    for f in (
        media.op1_media_columns, packing.op2_packing, licenses.op3_license_scans, mixing.op4_mixing, warc.op5_warc,
        token_counts.op6_token_counts, sharding.op7_sharding, near_dedup.op8_near_dedup, toxicity.op9_toxicity, quality_rules.op10_quality_rules,
        conversations.op11_conversation_repair, hard_negatives.op12_hard_negatives,
        secret_scans.op13_secret_scans,
    )
}
ORACLES = {"op4_mixing": mixing.OP4_SQL, "op10_quality_rules": quality_rules.OP10_SQL, "op12_hard_negatives": hard_negatives.OP12_SQL}
