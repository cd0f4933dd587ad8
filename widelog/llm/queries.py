"""The queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import mixing, secrets, sql
from .decontaminate import op5_decontaminate
from .html_text import op2_html_text
from .kneser_ney import op7_kneser_ney
from .language_id import op10_language_id
from .mixing import op8_mixing
from .near_dup import op4_near_dup
from .quality import op1_quality
from .secrets import op6_secrets
from .substring_dup import op3_substring_dedup
from .vector_dup import op9_near_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_html_text": op2_html_text,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_near_dup": op4_near_dup,
    "op5_decontaminate": op5_decontaminate,
    "op6_secrets": op6_secrets,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_mixing": op8_mixing,
    "op9_near_vectors": op9_near_vectors,
    "op10_language_id": op10_language_id,
}
ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": sql.SUBSTRING_DEDUP,
    "op4_near_dup": sql.NEAR_DUP,
    "op5_decontaminate": sql.DECONTAMINATE,
    "op6_secrets": secrets.SQL,
    "op8_mixing": mixing.SQL,
    "op9_near_vectors": sql.NEAR_VECTORS,
}
