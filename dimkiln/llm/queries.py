"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from dimkiln.llm.chat_format import OP9_SQL, op9_chat_format
from dimkiln.llm.collocations import OP12_SQL, op12_collocations
from dimkiln.llm.decontaminate import op7_decontaminate
from dimkiln.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from dimkiln.llm.mixing import OP4_SQL, op4_mixing
from dimkiln.llm.piece_codec import op11_piece_codec
from dimkiln.llm.pii import op6_pii
from dimkiln.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from dimkiln.llm.quality import op2_quality
from dimkiln.llm.sharding import op8_sharding
from dimkiln.llm.simhash import op1_simhash
from dimkiln.llm.token_output import op10_token_output
from dimkiln.llm.url_filter import OP3_SQL, op3_url_filter

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_url_filter": op3_url_filter,
    "op4_mixing": op4_mixing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_pii": op6_pii,
    "op7_decontaminate": op7_decontaminate,
    "op8_sharding": op8_sharding,
    "op9_chat_format": op9_chat_format,
    "op10_token_output": op10_token_output,
    "op11_piece_codec": op11_piece_codec,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE = {
    "op3_url_filter": OP3_SQL,
    "op4_mixing": OP4_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op9_chat_format": OP9_SQL,
    "op12_collocations": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
