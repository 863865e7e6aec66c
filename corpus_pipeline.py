"""Corpus pipeline: quality filter, line dedup, near-duplicates, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
works on all rows that the stage before kept. All but the last return the
columns of ``docs``. ``run`` writes each stage's rows as Parquet below the shared
folder and rereads them, so a stage is never recomputed for the next one.

Defined results (see the operators for the details): null and empty texts are
scored like any other and, where kept, packed as the end id alone; rows that
repeat a doc_id count as one document from the near-duplicate stage on; a null
doc_id passes the filters on its text alone; empty tables give an empty result;
further columns pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.llm import hilbert_pack, latent_decon, line_runs, parity_join, quality_trees, tokens
from settlekit.llm.folds import read
from settlekit.session import stage_table

# near duplicates in the pipeline: five words, similarity 0.8
NEAR = parity_join.Rule(5, 80, 100)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the boosted trees accept (fitted on the labelled documents of the learning fold)."""
    forest = quality_trees.train(docs, read(spark, sf_dir, "labels"))
    return quality_trees.keep_good(docs, forest)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; ``n_chars`` follows the text."""
    out = line_runs.dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each linked group."""
    return parity_join.keep_first(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages or paraphrases of them."""
    return latent_decon.clean(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens, neighbours along a Hilbert curve."""
    return hilbert_pack.pack(docs, tokens.vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("packing", packing),
]

# trained trees, a tokenizer and a sketch join can't be written in SQL: tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
