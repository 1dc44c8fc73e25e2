"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    conversations, decontaminate, langid, merkle, mixing, neighbours, packing, pii, quality, secrets, simhash, suffixes,
    toxicity,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours_multiprobe": lambda s, d: neighbours.digest(table(s, d, "embeddings")),
    "op2_quality_cascade": lambda s, d: quality.digest(table(s, d, "documents")),
    "op3_simhash_components": lambda s, d: simhash.digest(table(s, d, "documents")),
    "op4_secret_forest": lambda s, d: secrets.digest(table(s, d, "documents")),
    "op5_pii_disclosure": lambda s, d: pii.digest(table(s, d, "documents"), everywhere=True),
    "op6_suffix_dedup": lambda s, d: suffixes.digest(table(s, d, "documents")),
    "op7_pack_sum_of_squares": lambda s, d: packing.digest(table(s, d, "documents")),
    "op8_language_id": lambda s, d: langid.digest(table(s, d, "documents")),
    "op9_toxicity_trees": lambda s, d: toxicity.digest(table(s, d, "documents"), table(s, d, "labels")),
    "op10_mix_sources": lambda s, d: mixing.mix_sizes(table(s, d, "documents")),
    "op11_decontaminate_automaton": lambda s, d: decontaminate.digest(table(s, d, "documents"), table(s, d, "benchmark")),
    "op12_merkle_manifest": lambda s, d: merkle.digest(table(s, d, "documents")),
    "op13_conversation_repair": lambda s, d: conversations.digest(table(s, d, "conversations")),
}

ORACLE: dict[str, str] = {
    "op2_quality_cascade": quality.ORACLE,
    "op10_mix_sources": mixing.ORACLE,
    "op11_decontaminate_automaton": decontaminate.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_conversation_repair": conversations.ORACLE,
}
