"""Registered queries of the subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (ann, bpe, cross_parsing, html_text, merkle, ngram_join, packing, quality, suffix_dedup, toxicity,
               url_filter, warc, whitening)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packing.op1_packing,
    "op2_ann": ann.op2_ann,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_html_text": html_text.op4_html_text,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_bpe": bpe.op6_bpe,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op8_warc": warc.op8_warc,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_quality": quality.op10_quality,
    "op11_language": cross_parsing.op11_language,
    "op12_merkle": merkle.op12_merkle,
    "op13_whitening": whitening.op13_whitening,
}

SQL: dict[str, str] = {**warc.SQL, **quality.SQL, **merkle.SQL}
