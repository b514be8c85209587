"""Queries and oracle SQL of this subpackage, for __spark_entry__."""

from __future__ import annotations

from .bpe import op8_transducer_bpe
from .decontaminate import OP4_SQL, op4_spaced_seed_decontamination
from .exponion import OP13_SQL, op13_exponion_kmeans
from .partenum import OP6_SQL, op6_partenum_jaccard
from .periodic import op12_periodic_runs
from .quality import op3_ngram_logistic_quality
from .resample import op10_importance_resampling
from .scanbpe import op11_scan_byte_bpe
from .sharding import op5_jump_hash_sharding
from .substring import OP7_SQL, op7_rabin_karp_repeats
from .surrogates import op9_pii_surrogates
from .toolcalls import op2_tool_call_linking
from .warc import OP1_SQL, op1_external_index_merge

QUERIES = {
    "op1_external_index_merge": op1_external_index_merge,
    "op2_tool_call_linking": op2_tool_call_linking,
    "op3_ngram_logistic_quality": op3_ngram_logistic_quality,
    "op4_spaced_seed_decontamination": op4_spaced_seed_decontamination,
    "op5_jump_hash_sharding": op5_jump_hash_sharding,
    "op6_partenum_jaccard": op6_partenum_jaccard,
    "op7_rabin_karp_repeats": op7_rabin_karp_repeats,
    "op8_transducer_bpe": op8_transducer_bpe,
    "op9_pii_surrogates": op9_pii_surrogates,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_scan_byte_bpe": op11_scan_byte_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_exponion_kmeans": op13_exponion_kmeans,
}
ORACLE_SQL: dict[str, str] = {
    "op1_external_index_merge": OP1_SQL,
    "op4_spaced_seed_decontamination": OP4_SQL,
    "op6_partenum_jaccard": OP6_SQL,
    "op7_rabin_karp_repeats": OP7_SQL,
    "op13_exponion_kmeans": OP13_SQL,
}
