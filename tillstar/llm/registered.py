"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from tillstar.llm import op01, op02, op03, op04, op05, op06, op07, op08, op09, op10, op11, op12, op13

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_kneser_ney_quality": op01.op1_kneser_ney_quality,
    "op2_token_counts": op02.op2_token_counts,
    "op3_pivot_near_duplicates": op03.op3_pivot_near_duplicates,
    "op4_chat_prefix_targets": op04.op4_chat_prefix_targets,
    "op5_pii_sanitisation": op05.op5_pii_sanitisation,
    "op6_source_mixture": op06.op6_source_mixture,
    "op7_ans_token_files": op07.op7_ans_token_files,
    "op8_configuration_packing": op08.op8_configuration_packing,
    "op9_quality_rules": op09.op9_quality_rules,
    "op10_minhash_near_duplicates": op10.op10_minhash_near_duplicates,
    "op11_warc_archives": op11.op11_warc_archives,
    "op12_spelling_variants": op12.op12_spelling_variants,
    "op13_merkle_manifest": op13.op13_merkle_manifest,
}
ORACLES = {
    "op3_pivot_near_duplicates": op03.SQL,
    "op4_chat_prefix_targets": op04.SQL,
    "op10_minhash_near_duplicates": op10.SQL,
    "op11_warc_archives": op11.SQL,
    "op12_spelling_variants": op12.SQL,
    "op13_merkle_manifest": op13.SQL,
}
