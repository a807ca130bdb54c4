"""Registered queries of the subpackage, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retalia.llm.chat import CHAT_SQL, op13_chat_formatting
from retalia.llm.collocations import COLLOCATIONS_SQL, op11_collocations
from retalia.llm.embeddings import EMBEDDINGS_SQL, op6_embeddings
from retalia.llm.language import op5_language
from retalia.llm.lexical import LEXICAL_SQL, op12_lexical_search
from retalia.llm.lm import op8_lm_scoring
from retalia.llm.mixing import op9_mixing
from retalia.llm.packing import op2_packing
from retalia.llm.quality import op7_quality
from retalia.llm.sharding import op4_sharding
from retalia.llm.simhash import op1_simhash
from retalia.llm.substrings import op3_substrings
from retalia.llm.topk import TOPK_SQL, op10_topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_substrings": op3_substrings,
    "op4_sharding": op4_sharding,
    "op5_language": op5_language,
    "op6_embeddings": op6_embeddings,
    "op7_quality": op7_quality,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_mixing": op9_mixing,
    "op10_topk": op10_topk,
    "op11_collocations": op11_collocations,
    "op12_lexical_search": op12_lexical_search,
    "op13_chat_formatting": op13_chat_formatting,
}

ORACLE_SQL: dict[str, str] = {
    "op6_embeddings": EMBEDDINGS_SQL,
    "op10_topk": TOPK_SQL,
    "op11_collocations": COLLOCATIONS_SQL,
    "op12_lexical_search": LEXICAL_SQL,
    "op13_chat_formatting": CHAT_SQL,
}
