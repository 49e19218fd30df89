"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (conversation_repair, dom_model, hard_negatives, jaccard_join, lattice, license_scan, line_index,
               lsh_forest, maglev, piece_counts, raking, toxicity, winnowing)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_jaccard_join": jaccard_join.op1_jaccard_join,
        "op2_winnowing": winnowing.op2_winnowing,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_piece_counts": piece_counts.op4_piece_counts,
        "op5_raking": raking.op5_raking,
        "op6_line_index": line_index.op6_line_index,
        "op7_maglev_sharding": maglev.op7_maglev_sharding,
        "op8_lsh_forest": lsh_forest.op8_lsh_forest,
        "op9_dom_model": dom_model.op9_dom_model,
        "op10_lattice": lattice.op10_lattice,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_conversation_repair": conversation_repair.op12_conversation_repair,
        "op13_license_scan": license_scan.op13_license_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_winnowing": winnowing.OP2_SQL,
        "op5_raking": raking.op5_sql(),
        "op6_line_index": line_index.OP6_SQL,
        "op7_maglev_sharding": maglev.op7_sql(),
        "op11_hard_negatives": hard_negatives.OP11_SQL,
        "op12_conversation_repair": conversation_repair.OP12_SQL,
        "op13_license_scan": license_scan.op13_sql(),
    }
