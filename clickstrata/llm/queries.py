"""The registered query of each operator, over whole tables, and SQL that computes the same.

A query derives the columns of its contract from its operator's own results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.llm import (
    bisectors,
    decontamination,
    filter_audit,
    html_text,
    licences,
    mixing,
    neighbours,
    packing,
    repeats,
    secrets,
    similarity,
    tokens,
    toxicity,
)
from clickstrata.llm.common import table, workers_find_package
from clickstrata.llm.oracles import ORACLES
from clickstrata.llm.toxicity import toxicity_model


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score_documents(docs, toxicity_model(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontamination.find_contamination(
        docs, table(spark, sf_dir, "benchmark", "item_id", "text")
    )
    n_hit = decontamination.covered(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similarity_classes(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return licences.scan_licences(docs, licences.train(docs))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    return mixing.mix_sources(docs).drop("lang", "n_chars")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")).drop("kept")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return neighbours.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return filter_audit.audit_documents(docs, labels)


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.cluster_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def _digest(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of some kinds, comma-joined."""
    return F.array_join(
        F.transform(_of_kinds(spans, kinds), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    spans = F.col("secrets")
    base = [rule.kind for rule in secrets.BASE_RULES]
    return secrets.scan_secrets(docs).select(
        "doc_id",
        *[
            F.size(_of_kinds(spans, [kind])).cast("bigint").alias(f"n_{kind}") for kind in base
        ],
        F.sha2(_digest(spans, base), 256).alias("base_sha256"),
        _digest(spans, [rule.kind for rule in secrets.RULES]).alias("spans"),
    )


_QUERIES = (
    op1_toxicity,
    op2_decontamination,
    op3_html_extraction,
    op4_ngram_jaccard_join,
    op5_licence_scan,
    op6_token_counts,
    op7_source_mixing,
    op8_secret_scan,
    op9_substring_dedup,
    op10_nearest_neighbours,
    op11_filter_audit,
    op12_best_fit_packing,
    op13_centroid_clustering,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def prepared(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_find_package(spark)
            return query(spark, sf_dir)

        return run

    return {query.__name__: prepared(query) for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
