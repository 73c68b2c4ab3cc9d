"""Queries of this subpackage by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.bpe import op3_bpe
from tessera.llm.decontaminate import ORACLE_SQL as OP8_SQL
from tessera.llm.decontaminate import op8_decontaminate
from tessera.llm.hard_negatives import ORACLE_SQL as OP11_SQL
from tessera.llm.hard_negatives import op11_hard_negatives
from tessera.llm.html_text import op5_html
from tessera.llm.langid import op2_langid
from tessera.llm.maxscore import ORACLE_SQL as OP9_SQL
from tessera.llm.maxscore import op9_maxscore
from tessera.llm.mixing import ORACLE_SQL as OP12_SQL
from tessera.llm.mixing import op12_mixing
from tessera.llm.ngram_join import op4_ngram_join
from tessera.llm.pii import op6_pii
from tessera.llm.quality import op1_quality
from tessera.llm.secrets import op10_secrets
from tessera.llm.substring_dedup import ORACLE_SQL as OP7_SQL
from tessera.llm.substring_dedup import op7_substring_dedup
from tessera.llm.variants import ORACLE_SQL as OP13_SQL
from tessera.llm.variants import op13_variants


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_langid": op2_langid,
        "op3_bpe": op3_bpe,
        "op4_ngram_join": op4_ngram_join,
        "op5_html": op5_html,
        "op6_pii": op6_pii,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_decontaminate": op8_decontaminate,
        "op9_maxscore": op9_maxscore,
        "op10_secrets": op10_secrets,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_mixing": op12_mixing,
        "op13_variants": op13_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_substring_dedup": OP7_SQL,
        "op8_decontaminate": OP8_SQL,
        "op9_maxscore": OP9_SQL,
        "op11_hard_negatives": OP11_SQL,
        "op12_mixing": OP12_SQL,
        "op13_variants": OP13_SQL,
    }
