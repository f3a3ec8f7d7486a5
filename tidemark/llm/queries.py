"""The queries of this subpackage and their SQL, for the driver's registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontamination import OP9_SQL, op9_decontamination
from tidemark.llm.filter_audit import OP11_SQL, op11_filter_audit
from tidemark.llm.line_dedup import op5_line_dedup
from tidemark.llm.manifest import OP13_SQL, op13_merkle_manifest
from tidemark.llm.media import op12_media_columns
from tidemark.llm.nearest import op6_nearest
from tidemark.llm.packing import op7_best_fit_packing
from tidemark.llm.simhash import op8_simhash
from tidemark.llm.substring_dedup import op2_substring_dedup
from tidemark.llm.suffix_dedup import op1_suffix_dedup
from tidemark.llm.token_counts import op10_token_counts
from tidemark.llm.token_store import op4_token_store
from tidemark.llm.toxicity import op3_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_suffix_dedup, op2_substring_dedup, op3_toxicity, op4_token_store, op5_line_dedup, op6_nearest, op7_best_fit_packing, op8_simhash, op9_decontamination, op10_token_counts, op11_filter_audit, op12_media_columns, op13_merkle_manifest)}

ORACLE_SQL: dict[str, str] = {"op9_decontamination": OP9_SQL, "op11_filter_audit": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
