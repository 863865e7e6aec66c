"""Registered queries of the subpackage: ``name -> f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from settlekit.llm import (
    conversation_dawg,
    decision_lists,
    hilbert_pack,
    latent_decon,
    line_runs,
    parity_join,
    quality_trees,
    site_templates,
    suffix_cover,
    token_align,
    token_files,
    tokens,
    toxic_pu,
    warc_zstd,
)
from settlekit.llm.folds import read
from settlekit.session import stage_table


def op1_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.report(read(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write(read(spark, sf_dir, "documents"), tokens.vocabulary("word_bpe_49k.json"))
    return token_files.with_starts(token_files.read_documents(spark, path))


def op3_suffix_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_cover.dedup(read(spark, sf_dir, "documents"))


def op4_latent_decon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_decon.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_hilbert_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_pack.pack(read(spark, sf_dir, "documents"), tokens.vocabulary("byte_bpe_50k.json"))


def op6_toxic_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxic_pu.train(docs, read(spark, sf_dir, "labels"))
    return toxic_pu.score_documents(docs, model)


def op7_decision_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stage_table(decision_lists.statistics(read(spark, sf_dir, "documents")), "rules-statistics")
    rules = decision_lists.learn(stats, read(spark, sf_dir, "labels"))
    return decision_lists.judge(stats, rules)


def op8_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    forest = quality_trees.train(docs, read(spark, sf_dir, "labels"))
    return quality_trees.score_documents(docs, forest)


def op9_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_duplicates(read(spark, sf_dir, "documents"), parity_join.Rule(4, 85, 100))


def op10_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zstd.read(spark, warc_zstd.write(read(spark, sf_dir, "pages")))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.report(read(spark, sf_dir, "documents"), tokens.vocabulary("byte_bpe_50k.json"),
                              tokens.vocabulary("piece_bpe_32k.model"))


def op12_conversation_dawg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_dawg.report(conversation_dawg.damage(read(spark, sf_dir, "conversations")))


def op13_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_templates.extract(read(spark, sf_dir, "pages"))


QUERIES = {
    "op1_line_runs": op1_line_runs,
    "op2_token_files": op2_token_files,
    "op3_suffix_cover": op3_suffix_cover,
    "op4_latent_decon": op4_latent_decon,
    "op5_hilbert_pack": op5_hilbert_pack,
    "op6_toxic_pu": op6_toxic_pu,
    "op7_decision_lists": op7_decision_lists,
    "op8_quality_trees": op8_quality_trees,
    "op9_parity_join": op9_parity_join,
    "op10_warc_zstd": op10_warc_zstd,
    "op11_token_align": op11_token_align,
    "op12_conversation_dawg": op12_conversation_dawg,
    "op13_site_templates": op13_site_templates,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_runs": line_runs.oracle_sql(),
}
