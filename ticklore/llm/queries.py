"""Queries of the corpus operators over the given tables, and the SQL that says the same."""

from __future__ import annotations

import corpus_pipeline

from .chat_format import OP6_SQL, op6
from .decontaminate import op1
from .hard_negatives import OP11_SQL, op11
from .interpolation import op9
from .packing import op7
from .sharding import op13
from .line_dedup import OP3_SQL, op3
from .simhash_dedup import op4
from .substring_dedup import op5
from .suffix_dedup import op10
from .topk import op2
from .toxicity import op8
from .whitening import op12

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_decontamination": op1,
    "op2_top_k": op2,
    "op3_line_dedup": op3,
    "op4_simhash_dedup": op4,
    "op5_substring_dedup": op5,
    "op6_chat_format": op6,
    "op7_curve_packing": op7,
    "op8_toxicity": op8,
    "op9_deleted_interpolation": op9,
    "op10_suffix_dedup": op10,
    "op11_hard_negatives": op11,
    "op12_embedding_whitening": op12,
    "op13_sharding": op13,
}
ORACLES = {"op3_line_dedup": OP3_SQL, "op6_chat_format": OP6_SQL, "op11_hard_negatives": OP11_SQL}
