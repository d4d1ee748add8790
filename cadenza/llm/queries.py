"""Registered queries of the training-data operators, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm.binary_tokens import op5_token_binary
from cadenza.llm.byte_bpe import op13_byte_bpe
from cadenza.llm.chat_format import OP8_SQL, op8_chat_format
from cadenza.llm.decontamination import op3_decontamination
from cadenza.llm.divergence import OP12_SQL, op12_divergence
from cadenza.llm.language import op9_language
from cadenza.llm.packing import op2_packing
from cadenza.llm.resampling import op11_importance
from cadenza.llm.simhash import op4_simhash
from cadenza.llm.token_counts import op10_token_counts
from cadenza.llm.toxicity import op6_toxicity
from cadenza.llm.url_filters import OP1_SQL, op1_url_filters
from cadenza.llm.winnowing import op7_winnowing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_simhash": op4_simhash,
    "op5_token_binary": op5_token_binary,
    "op6_toxicity": op6_toxicity,
    "op7_winnowing": op7_winnowing,
    "op8_chat_format": op8_chat_format,
    "op9_language": op9_language,
    "op10_token_counts": op10_token_counts,
    "op11_importance": op11_importance,
    "op12_divergence": op12_divergence,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLES: dict[str, str] = {
    "op1_url_filters": OP1_SQL,
    "op8_chat_format": OP8_SQL,
    "op12_divergence": OP12_SQL,
}
