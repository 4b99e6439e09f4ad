"""The queries of this subpackage by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import (
    bigru, chat, decontaminate, imatch, licenses, linededup, merkle, mixing, secretscan, shards, simhash, webpages, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid_bigru": bigru.op1_langid_bigru,
    "op2_decontaminate_fmindex": decontaminate.op2_decontaminate_fmindex,
    "op3_secrets_blob_ledger": secretscan.op3_secrets_blob_ledger,
    "op4_mix_sainte_lague": mixing.op4_mix_sainte_lague,
    "op5_fingerprints_imatch": imatch.op5_fingerprints_imatch,
    "op6_licenses_set_join": licenses.op6_licenses_set_join,
    "op7_chat_templates": chat.op7_chat_templates,
    "op8_pages_host_paths": webpages.op8_pages_host_paths,
    "op9_shards_size_tiered": shards.op9_shards_size_tiered,
    "op10_simhash_bktree": simhash.op10_simhash_bktree,
    "op11_lines_keep_bitmaps": linededup.op11_lines_keep_bitmaps,
    "op12_whitening_welford_qr": whitening.op12_whitening_welford_qr,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate_fmindex": decontaminate.OP2_SQL,
    "op3_secrets_blob_ledger": secretscan.OP3_SQL,
    "op4_mix_sainte_lague": mixing.OP4_SQL,
    "op6_licenses_set_join": licenses.OP6_SQL,
    "op7_chat_templates": chat.OP7_SQL,
    "op11_lines_keep_bitmaps": linededup.OP11_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
