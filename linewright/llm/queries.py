"""The registered queries of this subpackage and their SQL answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import OP1_SQL, op1_chat
from .decontaminate import OP7_SQL, op7_decontaminate
from .factors import op11_quality_classifier
from .language import op3_language
from .negatives import OP12_SQL, op12_negatives
from .pieces import op5_pieces
from .quality import OP6_SQL, op6_quality
from .simhash import op4_simhash
from .substring import OP2_SQL, op2_substring_dedup
from .tokens import op8_tokens
from .toxicity import op10_toxicity
from .urls import OP9_SQL, op9_urls
from .variants import OP13_SQL, op13_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language": op3_language,
    "op4_simhash": op4_simhash,
    "op5_pieces": op5_pieces,
    "op6_quality": op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_tokens": op8_tokens,
    "op9_urls": op9_urls,
    "op10_toxicity": op10_toxicity,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_negatives": op12_negatives,
    "op13_variants": op13_variants,
}

#: What SQL cannot express, or not over whole tables, is compared with brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op1_chat": OP1_SQL,
    "op2_substring_dedup": OP2_SQL,
    "op6_quality": OP6_SQL,
    "op7_decontaminate": OP7_SQL,
    "op9_urls": OP9_SQL,
    "op12_negatives": OP12_SQL,
    "op13_variants": OP13_SQL,
}
