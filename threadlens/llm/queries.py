"""Registered queries of this subpackage: ``fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from threadlens.llm import common as C
from threadlens.llm.anchors import substring_dedup
from threadlens.llm.audit import ORACLE as AUDIT_SQL
from threadlens.llm.audit import filter_audit
from threadlens.llm.bpe import round_trip
from threadlens.llm.brown import class_scores
from threadlens.llm.lemp import ORACLE as SEARCH_SQL
from threadlens.llm.lemp import lexical_search
from threadlens.llm.licenses import license_scan
from threadlens.llm.merkle import document_fingerprints
from threadlens.llm.packing import pack
from threadlens.llm.parsing import suffix_dedup
from threadlens.llm.sketches import near_duplicates
from threadlens.llm.topk import top_inner_products
from threadlens.llm.toxicity import toxicity
from threadlens.llm.viterbi import sentencepiece_ids

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@_register("op8_substring_dedup")
def op8_substring_dedup(spark, sf_dir):
    return substring_dedup(C.documents(spark, sf_dir))


@_register("op10_suffix_dedup")
def op10_suffix_dedup(spark, sf_dir):
    return suffix_dedup(C.documents(spark, sf_dir))


@_register("op7_minhash_near_dedup")
def op7_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(C.documents(spark, sf_dir))


@_register("op6_brown_lm_score")
def op6_brown_lm_score(spark, sf_dir):
    return class_scores(C.documents(spark, sf_dir))


@_register("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity(C.documents(spark, sf_dir), labels)


@_register("op3_packing")
def op3_packing(spark, sf_dir):
    return pack(C.documents(spark, sf_dir))


@_register("op4_fingerprints")
def op4_fingerprints(spark, sf_dir):
    return document_fingerprints(C.documents(spark, sf_dir))


@_register("op1_top_inner_products")
def op1_top_inner_products(spark, sf_dir):
    return top_inner_products(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


@_register("op5_sentencepiece")
def op5_sentencepiece(spark, sf_dir):
    return sentencepiece_ids(C.documents(spark, sf_dir))


@_register("op9_license_scan")
def op9_license_scan(spark, sf_dir):
    return license_scan(C.documents(spark, sf_dir))


@_register("op13_filter_audit", AUDIT_SQL)
def op13_filter_audit(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return filter_audit(C.documents(spark, sf_dir), labels)


@_register("op11_lexical_search", SEARCH_SQL)
def op11_lexical_search(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return lexical_search(C.documents(spark, sf_dir), items)


@_register("op12_byte_bpe")
def op12_byte_bpe(spark, sf_dir):
    return round_trip(C.documents(spark, sf_dir))
