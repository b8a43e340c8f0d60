"""Queries of the training-data operators, by name."""

from __future__ import annotations

from inkmill.llm.decontam import op10_decontamination
from inkmill.llm.langid import op2_language_id
from inkmill.llm.lmscore import op4_lm_scoring
from inkmill.llm.neardup import op5_near_duplicates
from inkmill.llm.oracle import ORACLE
from inkmill.llm.packing import op1_best_fit_packing
from inkmill.llm.pii import op3_pii
from inkmill.llm.quality import op7_quality
from inkmill.llm.sharding import op9_kd_sharding
from inkmill.llm.substrings import op6_substring_dedup
from inkmill.llm.tokencount import op8_token_counts

QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_language_id,
        op3_pii,
        op4_lm_scoring,
        op5_near_duplicates,
        op6_substring_dedup,
        op7_quality,
        op8_token_counts,
        op9_kd_sharding,
        op10_decontamination,
    )
}

__all__ = ["ORACLE", "QUERIES"]
