"""The registered queries of this package: one for each operator, and the pipeline."""

from __future__ import annotations

from . import (byte_bpe, decontaminate, jaccard_join, kn_quality, lm_scoring, quality_rules, secrets, simhash_cover, spelling,
               suffix_dedup, token_orc, toxicity, whitening)
from .oracle_sql import ORACLE_SQL  # noqa: F401

QUERIES = {
    "op1_byte_bpe": byte_bpe.op1_byte_bpe,
    "op2_token_orc": token_orc.op2_token_orc,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_lm_scoring": lm_scoring.op5_lm_scoring,
    "op6_jaccard_join": jaccard_join.op6_jaccard_join,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_kn_quality": kn_quality.op9_kn_quality,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_simhash_cover": simhash_cover.op11_simhash_cover,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_spelling_groups": spelling.op13_spelling_groups,
}
