"""Registered queries of the training-data operators (name -> (spark, sf_dir))."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline

from . import decontaminate, digest, manifest, neural_lm, oracles, packing, passages, quality, repeats, sharding, simhash, toxicity, urls, whitening
from .common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@register("op9_simhash_near_dedup")
def op9(spark, sf_dir):
    out = simhash.components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op10_benchmark_decontamination", oracles.CONTAINED_ITEMS)
def op10(spark, sf_dir):
    out = decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "containment")


@register("op8_best_fit_packing")
def op8(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@register("op5_byte_sharding", oracles.BYTE_SHARDS)
def op5(spark, sf_dir):
    out = sharding.byte_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op2_quality_classifier")
def op2(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(quality.labelled_sample(docs, labels, "quality", crc_mod("doc_id", 5) != 0, quality.SAMPLE))
    return quality.scored(docs, model).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@register("op3_toxicity")
def op3(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    admitted = crc_mod("doc_id", 4) != 2
    model = toxicity.fit(toxicity.sample(docs, labels, admitted), toxicity.label_counts(labels, admitted))
    return toxicity.scored(docs, model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "spans")


@register("op7_url_filter")
def op7(spark, sf_dir):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    return urls.judged(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict", "score")


@register("op6_improbable_feature_digest")
def op6(spark, sf_dir):
    return digest.compared(table(spark, sf_dir, "documents"))


@register("op4_suffix_array_dedup", oracles.REPEATED_STRINGS)
def op4(spark, sf_dir):
    return repeats.report(table(spark, sf_dir, "documents"))


@register("op1_fuzzy_passages")
def op1(spark, sf_dir):
    return passages.fuzzy_passages(table(spark, sf_dir, "documents"))


@register("op11_embedding_whitening")
def op11(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@register("op12_log_bilinear_scores")
def op12(spark, sf_dir):
    return neural_lm.scored(table(spark, sf_dir, "documents"), crc_mod("doc_id", 10) == 0)


@register("op13_merkle_manifest", oracles.MERKLE_MANIFEST)
def op13(spark, sf_dir):
    return manifest.manifest(table(spark, sf_dir, "documents"))


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
