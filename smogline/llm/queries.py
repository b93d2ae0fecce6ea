"""The corpus queries by name, and their DuckDB SQL where SQL can express them on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, ctw, decontam, forest, lines, order, periods, quality, secrets, simhash, substrings, topk, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_training_order": order.op1_training_order,
    "op2_decontamination": decontam.op2_decontamination,
    "op3_quality": quality.op3_quality,
    "op4_bpe": bpe.op4_bpe,
    "op5_topk": topk.op5_topk,
    "op6_simhash": simhash.op6_simhash,
    "op7_ctw": ctw.op7_ctw,
    "op8_secrets": secrets.op8_secrets,
    "op9_line_dedup": lines.op9_line_dedup,
    "op10_substrings": substrings.op10_substrings,
    "op11_periodic_runs": periods.op11_periodic_runs,
    "op12_embedding_near_dedup": forest.op12_embedding_near_dedup,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES: dict[str, str] = {
    "op5_topk": topk.ORACLE,
    "op9_line_dedup": lines.ORACLE,
}
