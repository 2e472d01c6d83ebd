"""The registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from care_measures.llm import decontamination, exact_dedup, language_id, language_model, near_dedup, packing, periodic_runs, personal_data, sharding, suffix_dedup, token_counts, toxicity, whitening

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_language_model": language_model.op4_language_model,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_sharding": sharding.op6_sharding,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_packing": packing.op8_packing,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_personal_data": personal_data.op12_personal_data,
    "op13_whitening": whitening.op13_whitening,
}

SQL = {"op9_exact_dedup": exact_dedup.SQL, "op12_personal_data": personal_data.SQL}
