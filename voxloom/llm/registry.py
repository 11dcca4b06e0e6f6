"""Queries and SQL of the training-data operators, by registered name."""

from __future__ import annotations

from voxloom.llm import context_mixing, decontaminate, line_dedup, media_chunks, packing, quality_gam, secret_scan, shard_store, simhash_dedup, toxicity_zstd


def queries() -> dict:
    return {
        "op1_context_mixing": context_mixing.query,
        "op2_simhash_dedup": simhash_dedup.query,
        "op3_secret_scan": secret_scan.query,
        "op4_media_chunks": media_chunks.query,
        "op5_packing": packing.query,
        "op6_toxicity_zstd": toxicity_zstd.query,
        "op7_decontaminate": decontaminate.query,
        "op8_shard_store": shard_store.query,
        "op9_line_dedup": line_dedup.query,
        "op10_quality_gam": quality_gam.query,
    }


def oracle_sql() -> dict[str, str]:
    return {}
