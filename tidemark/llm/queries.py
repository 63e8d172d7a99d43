"""The queries of this folder and the SQL that must agree with them, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, chat, decontaminate, hardneg, langid, neardup, pii, substrings, token_files, topk, toxicity, warc, whitening

RUNS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": langid.op1_language_id,
    "op2_chat": chat.op2_chat,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_warc_fixity": warc.op4_warc_fixity,
    "op5_bpe": bpe.op5_bpe,
    "op6_near_duplicates": neardup.op6_near_duplicates,
    "op7_substrings": substrings.op7_substrings,
    "op8_top_k": topk.op8_top_k,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_token_files": token_files.op10_token_files,
    "op11_hard_negatives": hardneg.op11_hard_negatives,
    "op12_whitening": whitening.op12_whitening,
    "op13_pii": pii.op13_pii,
}

ORACLES: dict[str, str] = {
    "op2_chat": chat.OP2_SQL,
    "op4_warc_fixity": warc.OP4_SQL,
    "op7_substrings": substrings.OP7_SQL,
    "op8_top_k": topk.OP8_SQL,
    "op9_decontaminate": decontaminate.OP9_SQL,
    "op11_hard_negatives": hardneg.OP11_SQL,
}
