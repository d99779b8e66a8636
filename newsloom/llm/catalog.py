"""The subpackage's queries and SQL by name."""

from __future__ import annotations

from .bottom_k import op12_bottom_k
from .bpe import op6_bpe_codec
from .exact_dedup import OP9_SQL, op9_exact_dedup
from .fingerprints import op8_order_minhash
from .jaccard_join import op3_jaccard_join
from .language import op4_language_crf
from .packing import op7_best_fit_packing
from .panes import OP11_SQL, op11_window_panes
from .periodic_runs import op13_periodic_runs
from .quality import op2_quality_nbsvm
from .sharding import op5_shard_tree
from .substrings import OP10_SQL, op10_substring_dedup
from .token_output import op1_token_files


def queries() -> dict:
    return {
        "op1_token_files": op1_token_files,
        "op2_quality_nbsvm": op2_quality_nbsvm,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_language_crf": op4_language_crf,
        "op5_shard_tree": op5_shard_tree,
        "op6_bpe_codec": op6_bpe_codec,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_order_minhash": op8_order_minhash,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_window_panes": op11_window_panes,
        "op12_bottom_k": op12_bottom_k,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_dedup": OP9_SQL, "op10_substring_dedup": OP10_SQL, "op11_window_panes": OP11_SQL}
