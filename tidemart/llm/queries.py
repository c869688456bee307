"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm.ann import op7_nearest
from tidemart.llm.conversation_repair import OP11_SQL, op11_conversation_repair
from tidemart.llm.decontamination import OP12_SQL, op12_decontamination
from tidemart.llm.filter_audit import OP13_SQL, op13_filter_audit
from tidemart.llm.html_text import op4_html_text
from tidemart.llm.language import op9_language_id
from tidemart.llm.mixing import OP6_SQL, op6_mixing
from tidemart.llm.ngram_join import OP3_SQL, op3_ngram_join
from tidemart.llm.packing import op2_packing
from tidemart.llm.pii import op5_pii
from tidemart.llm.sharding import op10_sharding
from tidemart.llm.token_counts import op8_token_counts
from tidemart.llm.topk import OP1_SQL, op1_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_packing": op2_packing,
    "op3_ngram_join": op3_ngram_join,
    "op4_html_text": op4_html_text,
    "op5_pii": op5_pii,
    "op6_mixing": op6_mixing,
    "op7_nearest": op7_nearest,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_sharding": op10_sharding,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_decontamination": op12_decontamination,
    "op13_filter_audit": op13_filter_audit,
}
# The others need token ids, hashes or fitted models; they are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_top_k": OP1_SQL,
    "op3_ngram_join": OP3_SQL,
    "op6_mixing": OP6_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_decontamination": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
