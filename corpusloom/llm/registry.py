"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import alignment, ann, divergence, language, line_dedup, lm, media, minmax, mixing, pieces, quality, simhash, toolcalls
from corpusloom.llm.common import table


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_recurrent_lm": lambda s, d: lm.query(table(s, d, "documents")),
        "op2_tool_calls": lambda s, d: toolcalls.query(table(s, d, "conversations")),
        "op3_media_shards": lambda s, d: media.query(table(s, d, "documents")),
        "op4_simhash_dedup": lambda s, d: simhash.query(table(s, d, "documents")),
        "op5_forest_neighbours": lambda s, d: ann.query(table(s, d, "embeddings")),
        "op6_source_mixing": lambda s, d: mixing.query(table(s, d, "documents")),
        "op7_line_dedup": lambda s, d: line_dedup.query(table(s, d, "documents")),
        "op8_piece_sampling": lambda s, d: pieces.query(table(s, d, "documents")),
        "op9_quality_rules": lambda s, d: quality.query(table(s, d, "documents"), table(s, d, "labels")),
        "op10_language_id": lambda s, d: language.query(table(s, d, "documents")),
        "op11_minmax_dedup": lambda s, d: minmax.query(table(s, d, "documents")),
        "op12_divergence_audit": lambda s, d: divergence.query(table(s, d, "documents")),
        "op13_token_alignment": lambda s, d: alignment.query(table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_tool_calls": toolcalls.SQL, "op6_source_mixing": mixing.SQL, "op7_line_dedup": line_dedup.SQL, "op12_divergence_audit": divergence.SQL}
