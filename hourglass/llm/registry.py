"""Registered queries of the operators, and their DuckDB SQL where SQL can
express them on whole tables."""

from __future__ import annotations

from hourglass.llm import (ann, bpe, chat_format, decontaminate, fill_in_middle, hard_negatives, language_id,
                           pii, secret_scan, simhash, suffix_dedup, token_count, warc)


def queries():
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_decontaminate": decontaminate.op2_decontaminate,
        "op3_ann": ann.op3_ann,
        "op4_bpe": bpe.op4_bpe,
        "op5_chat_format": chat_format.op5_chat_format,
        "op6_language_id": language_id.op6_language_id,
        "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
        "op8_secret_scan": secret_scan.op8_secret_scan,
        "op9_warc": warc.op9_warc,
        "op10_token_count": token_count.op10_token_count,
        "op11_pii": pii.op11_pii,
        "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
        "op13_hard_negatives": hard_negatives.op13_hard_negatives,
    }


def oracle_sql():
    return {
        "op2_decontaminate": decontaminate.ORACLE_SQL,
        "op5_chat_format": chat_format.ORACLE_SQL,
        "op9_warc": warc.ORACLE_SQL,
        "op12_fill_in_middle": fill_in_middle.ORACLE_SQL,
        "op13_hard_negatives": hard_negatives.ORACLE_SQL,
    }
