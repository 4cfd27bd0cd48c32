"""Training corpus in five stages: quality filter, near-dedup, repeated strings,
benchmark decontamination, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame.  All but the last return the
columns of documents; ``run`` writes every stage's result to the shared
checkpoint folder and rereads it, so a later stage never recomputes an earlier
one and survives the loss of the executors that made it.

Rows with a null or empty text are scored like any other, near-duplicates of
each other, untouched by the next two stages, and packed as one token.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, packing, quality, repeats, simhash
from shelfwise.llm.common import crc_mod, saved, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts (score 0.3 or more)."""
    sample = quality.labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", crc_mod("doc_id", 5) != 0, quality.SAMPLE)
    return quality.kept(docs, quality.fit(sample))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked at three or fewer SimHash bits."""
    return simhash.deduplicated(docs, simhash.SHINGLE, simhash.MAX_BITS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 50 bytes that a smaller doc_id has."""
    return repeats.removed(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Trained weights, Hamming components and tokenizer ids have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = saved(spark, stage(spark, out, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, out, sf_dir)
