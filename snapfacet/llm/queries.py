"""The registered queries of this subpackage: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from .benchmark_decontamination import op7_benchmark_decontamination
from .hamming_search import OP6_SQL, op6_exact_top_k
from .hard_negatives import OP12_SQL, op12_hard_negatives
from .interpolation import op9_deleted_interpolation
from .lexical_search import OP11_SQL, op11_dual_tree_search
from .license_scan import OP3_SQL, op3_license_scan
from .minhash import OP13_SQL, op13_minhash_near_dedup
from .packing import op4_harmonic_packing
from .revisits import OP5_SQL, op5_not_modified_revisits
from .simhash import op10_simhash_near_dedup
from .substring_dedup import op1_substring_dedup
from .suffix_dedup import op8_suffix_array_dedup
from .toxicity import op2_toxicity


def pipeline(spark, sf_dir):
    """All stages of ``corpus_pipeline`` (at the top of the repository) over ``documents``; no SQL can express them."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_substring_dedup": (op1_substring_dedup, None),
    "op2_toxicity": (op2_toxicity, None),
    "op3_license_scan": (op3_license_scan, OP3_SQL),
    "op4_harmonic_packing": (op4_harmonic_packing, None),
    "op5_not_modified_revisits": (op5_not_modified_revisits, OP5_SQL),
    "op6_exact_top_k": (op6_exact_top_k, OP6_SQL),
    "op7_benchmark_decontamination": (op7_benchmark_decontamination, None),
    "op8_suffix_array_dedup": (op8_suffix_array_dedup, None),
    "op9_deleted_interpolation": (op9_deleted_interpolation, None),
    "op10_simhash_near_dedup": (op10_simhash_near_dedup, None),
    "op11_dual_tree_search": (op11_dual_tree_search, OP11_SQL),
    "op12_hard_negatives": (op12_hard_negatives, OP12_SQL),
    "op13_minhash_near_dedup": (op13_minhash_near_dedup, OP13_SQL),
    "pipeline": (pipeline, None),
}
