"""The corpus queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from barloom.llm import bpe, chat, divergence, language, mixing, neardup, oracles, pages, quality, secrets, sharding, spans, spelling, vectors
from barloom.session import ship_package


def _shipped(f):
    def query(spark, sf_dir):
        ship_package(spark)
        return f(spark, sf_dir)

    return query


def queries():
    found = {
        "op1_substring_dedup": spans.op1_substring_dedup,
        "op2_minhash_near_dedup": neardup.op2_minhash_near_dedup,
        "op3_chat_formatting": chat.op3_chat_formatting,
        "op4_byte_bpe": bpe.op4_byte_bpe,
        "op5_sharding": sharding.op5_sharding,
        "op6_secret_scan": secrets.op6_secret_scan,
        "op7_quality_rules": quality.op7_quality_rules,
        "op8_mixing": mixing.op8_mixing,
        "op9_embedding_near_dedup": vectors.op9_embedding_near_dedup,
        "op10_html_extraction": pages.op10_html_extraction,
        "op11_source_divergence": divergence.op11_source_divergence,
        "op12_language_id": language.op12_language_id,
        "op13_spelling_variants": spelling.op13_spelling_variants,
    }
    return {name: _shipped(f) for name, f in found.items()}


def oracle_sql():
    return dict(oracles.SQL)
