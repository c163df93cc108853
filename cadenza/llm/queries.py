"""Contract queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.llm import (cotrain, decontaminate, hard_negatives, html_extract, lang_id, minhash, mixing, quality_rules, simhash, spelling,
                         suffix_dedup, token_store, url_filter)
from cadenza.llm.common import table
from cadenza.llm.oracle import ORACLE  # noqa: F401  (read by the driver entry)

QUERIES: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_decontaminate(spark, sf_dir):
    report = decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@register
def op2_mix_sources(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@register
def op3_quality_rules(spark, sf_dir):
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@register
def op4_url_filter(spark, sf_dir):
    return url_filter.url_report(table(spark, sf_dir, "pages"))


@register
def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents"))


@register
def op6_quality_classifier(spark, sf_dir):
    return cotrain.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op7_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op8_html_extract(spark, sf_dir):
    return html_extract.page_report(table(spark, sf_dir, "pages"))


@register
def op9_token_store(spark, sf_dir):
    return token_store.token_report(table(spark, sf_dir, "documents"))


@register
def op10_language_id(spark, sf_dir):
    return lang_id.language_report(table(spark, sf_dir, "documents"))


@register
def op11_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@register
def op12_simhash_dedup(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@register
def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@register
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
