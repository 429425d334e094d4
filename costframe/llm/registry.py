"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from costframe.llm.chat import OP6_SQL, op6_fingerprint_chat
from costframe.llm.decontaminate import op9_smith_waterman
from costframe.llm.exact_dedup import OP2_SQL, op2_block_naming
from costframe.llm.languages import op13_subword_embeddings
from costframe.llm.lm_scores import OP1_SQL, op1_stupid_backoff
from costframe.llm.mixing import op10_pivotal_mix
from costframe.llm.near_dedup import op5_coordinate_join
from costframe.llm.phrases import OP11_SQL, op11_count_streams
from costframe.llm.quality import op4_factorisation_machine
from costframe.llm.sharding import op7_jump_shards
from costframe.llm.token_counts import op3_transducer_counts
from costframe.llm.warc import OP8_SQL, op8_warc_captures
from costframe.llm.whitening import op12_spectrum_slicing

QUERIES = {f.__name__: f for f in (
    op1_stupid_backoff, op2_block_naming, op3_transducer_counts, op4_factorisation_machine, op5_coordinate_join,
    op6_fingerprint_chat, op7_jump_shards, op8_warc_captures, op9_smith_waterman, op10_pivotal_mix,
    op11_count_streams, op12_spectrum_slicing, op13_subword_embeddings)}
SQL = {"op1_stupid_backoff": OP1_SQL, "op2_block_naming": OP2_SQL, "op6_fingerprint_chat": OP6_SQL, "op8_warc_captures": OP8_SQL,
       "op11_count_streams": OP11_SQL}
