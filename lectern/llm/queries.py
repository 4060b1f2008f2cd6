"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import ann, bpe, chat, media, minhash, mixing, phrases, quality, suffixes, toxicity, url_rules, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": ann.op1_ann,
    "op2_mixing": mixing.op2_mixing,
    "op3_media": media.op3_media,
    "op4_bpe": bpe.op4_bpe,
    "op5_warc_fixity": warc.op5_warc_fixity,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_suffixes": suffixes.op7_suffixes,
    "op8_url_rules": url_rules.op8_url_rules,
    "op9_quality": quality.op9_quality,
    "op10_minhash": minhash.op10_minhash,
    "op11_chat": chat.op11_chat,
    "op12_phrases": phrases.op12_phrases,
    "op13_whitening": whitening.op13_whitening,
}

SQL: dict[str, str] = {
    "op2_mixing": mixing.SQL,
    "op5_warc_fixity": warc.SQL,
    "op8_url_rules": url_rules.SQL,
    "op11_chat": chat.SQL,
    "op12_phrases": phrases.SQL,
}
