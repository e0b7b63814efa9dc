"""Queries of this subpackage by name, and SQL for those that SQL expresses."""

from __future__ import annotations

import corpus_pipeline

from larder.llm.bktree import op10_query
from larder.llm.hashtree import op9_query
from larder.llm.licenses import op1_query
from larder.llm.mincut import op7_query
from larder.llm.mixing import op3_query
from larder.llm.negatives import OP11_SQL, op11_query
from larder.llm.onebit import op6_query
from larder.llm.outliers import op4_query
from larder.llm.packing import op5_query
from larder.llm.personal import op13_query
from larder.llm.toxicity import op8_query
from larder.llm.warc import OP2_SQL, op2_query
from larder.llm.whitening import op12_query

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_license_scan": op1_query,
    "op2_warc_index": op2_query,
    "op3_temperature_mix": op3_query,
    "op4_mcd_outliers": op4_query,
    "op5_deficit_packing": op5_query,
    "op6_one_bit_search": op6_query,
    "op7_mincut_text": op7_query,
    "op8_noisy_or_toxicity": op8_query,
    "op9_hash_tree_shards": op9_query,
    "op10_simhash_bktree": op10_query,
    "op11_slot_negatives": op11_query,
    "op12_cholesky_whitening": op12_query,
    "op13_semi_markov_pii": op13_query,
}
ORACLES: dict[str, str] = {"op2_warc_index": OP2_SQL, "op11_slot_negatives": OP11_SQL}
