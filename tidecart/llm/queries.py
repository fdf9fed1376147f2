"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidecart.llm import (
    chat_tools, collocations, decontamination, hard_negatives, langid, line_templates, minhash, mixing, packing, quality, repetition, simhash,
    toxicity,
)

QUERIES = {
    "op1_language_id": langid.language_id,
    "op2_poisson_mixing": mixing.poisson_mixing,
    "op3_line_template_dedup": line_templates.line_dedup,
    "op4_tool_call_linking": chat_tools.tool_call_linking,
    "op5_toxicity_chain": toxicity.toxicity_chain,
    "op6_minhash_fingerprints": minhash.minhash_fingerprints,
    "op7_quality_classifier": quality.quality_classifier,
    "op8_simhash_near_dedup": simhash.fingerprint_links,
    "op9_best_fit_packing": packing.best_fit_packing,
    "op10_repetition_rules": repetition.repetition_rules,
    "op11_benchmark_decontamination": decontamination.benchmark_decontamination,
    "op12_hard_negatives": hard_negatives.hard_negatives,
    "op13_phrase_collocations": collocations.phrase_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op2_poisson_mixing": mixing.POISSON_MIXING_SQL,
    "op3_line_template_dedup": line_templates.LINE_DEDUP_SQL,
    "op4_tool_call_linking": chat_tools.TOOL_CALL_SQL,
    "op11_benchmark_decontamination": decontamination.DECONTAMINATION_SQL,
    "op12_hard_negatives": hard_negatives.HARD_NEGATIVES_SQL,
    "op13_phrase_collocations": collocations.COLLOCATIONS_SQL,
}
