"""The registered queries of this subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from flowtable.llm.chat import OP13_SQL, op13_chat_format
from flowtable.llm.clustering import OP12_SQL, op12_orchard_clusters
from flowtable.llm.common import shipped
from flowtable.llm.htmltext import op10_site_templates
from flowtable.llm.langid import op8_language_id
from flowtable.llm.minhash import op7_minhash_dedup
from flowtable.llm.ngram_bloom import op4_bloom_lm
from flowtable.llm.packing import op3_lexical_packing
from flowtable.llm.piece_codec import op5_piece_codec
from flowtable.llm.rules import op9_decision_list
from flowtable.llm.sharding import op6_ring_shards
from flowtable.llm.token_counts import op1_token_counts
from flowtable.llm.topk import OP2_SQL, op2_va_topk
from flowtable.llm.whitening import op11_whitening

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_va_topk": op2_va_topk,
    "op3_lexical_packing": op3_lexical_packing,
    "op4_bloom_lm": op4_bloom_lm,
    "op5_piece_codec": op5_piece_codec,
    "op6_ring_shards": op6_ring_shards,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_language_id": op8_language_id,
    "op9_decision_list": op9_decision_list,
    "op10_site_templates": op10_site_templates,
    "op11_whitening": op11_whitening,
    "op12_orchard_clusters": op12_orchard_clusters,
    "op13_chat_format": op13_chat_format,
}

QUERIES = {name: shipped(query) for name, query in QUERIES.items()}

ORACLE = {
    "op2_va_topk": OP2_SQL,
    "op12_orchard_clusters": OP12_SQL,
    "op13_chat_format": OP13_SQL,
}
