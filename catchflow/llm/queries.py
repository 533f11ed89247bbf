"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .collision_search import op11_collision_search
from .divergence import OP13_SQL, op13_run_columns
from .hard_negatives import OP12_SQL, op12_multi_index
from .metric_join import OP2_SQL, op2_pivot_cells
from .mixing import OP8_SQL, op8_systematic_mix
from .ngram_join import OP7_SQL, op7_signature_trees
from .packing import op1_nnls_packing
from .quality_classifier import op10_zstd_quality
from .quality_rules import op5_ngram_ratio
from .suffix_dedup import op3_previous_factors
from .token_files import op9_simple8b_files
from .toxicity import op6_bigru_toxicity
from .url_filters import op4_host_trust

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nnls_packing": op1_nnls_packing,
    "op2_pivot_cells": op2_pivot_cells,
    "op3_previous_factors": op3_previous_factors,
    "op4_host_trust": op4_host_trust,
    "op5_ngram_ratio": op5_ngram_ratio,
    "op6_bigru_toxicity": op6_bigru_toxicity,
    "op7_signature_trees": op7_signature_trees,
    "op8_systematic_mix": op8_systematic_mix,
    "op9_simple8b_files": op9_simple8b_files,
    "op10_zstd_quality": op10_zstd_quality,
    "op11_collision_search": op11_collision_search,
    "op12_multi_index": op12_multi_index,
    "op13_run_columns": op13_run_columns,
}
ORACLES: dict[str, str] = {"op2_pivot_cells": OP2_SQL, "op7_signature_trees": OP7_SQL, "op8_systematic_mix": OP8_SQL, "op12_multi_index": OP12_SQL, "op13_run_columns": OP13_SQL}
