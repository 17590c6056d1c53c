"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from quayload.llm import (
    byte_bpe,
    decontamination,
    divergence,
    exact_dedup,
    language_id,
    lattice,
    minhash,
    mixing,
    periodic_runs,
    quality,
    resharding,
    substring_dedup,
    suffix_dedup,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_language_id": language_id.op3_language_id,
    "op6_reshard": resharding.op6_reshard,
    "op4_minhash": minhash.op4_minhash,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_quality": quality.op8_quality,
    "op9_byte_bpe": byte_bpe.op9_byte_bpe,
    "op10_embedding_dedup": lattice.op10_embedding_dedup,
    "op11_decontaminate": decontamination.op11_decontaminate,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_divergence": divergence.op13_divergence,
}
SQL = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op2_mix_sources": mixing.SQL,
    "op11_decontaminate": decontamination.SQL,
    "op13_divergence": divergence.SQL,
}
