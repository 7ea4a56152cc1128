"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    align, audit, classifier, embed, jaccard, katz, licenses, mixing, pieces, rules, suffix, toxicity, urls,
)
from tidemark.llm.common import table
from tidemark.llm.oracles import ORACLES  # noqa: F401  (read by the entry module)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken per document, in training order."""
    rows = mixing.assign(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return rows.select(
        F.col("doc.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        "taken",
        F.get("passes", F.lit(0))["position"].alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


@query
def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and posterior verdict per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judge(docs).select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses found per document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op3_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict per page."""
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict")


@query
def op1_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a third of the ids is held out of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    labels = table(spark, sf_dir, "labels").where(remainder != 1)
    return classifier.score(docs, classifier.fit(docs, labels)).select(
        "doc.doc_id",
        (F.crc32(F.col("doc.doc_id").cast("string").cast("binary")) % 3 == 1).alias("held_out"),
        "score",
        "predicted",
    )


@query
def op10_vector_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict per vector."""
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op2_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that an earlier one has in a 50-byte string."""
    rows = suffix.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


@query
def op8_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and component of every document."""
    return jaccard.clusters(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text; a tenth of the ids is held out of the counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    return katz.score(docs, remainder != 0)


@query
def op9_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every text, and whether they decode to it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.decode(pieces.encode(docs))
    return coded.select(
        "doc.doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens"),
        "ids",
        F.coalesce(F.col("decoded") == F.col("doc.text"), F.lit(True)).alias("exact"),
    )


@query
def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, per language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return audit.audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.align(docs, as_text=False, columns=["doc_id"]).select(
        "doc.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


@query
def op13_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document with its nearest examples; a fifth of the ids is held out of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    index = toxicity.fit(docs, table(spark, sf_dir, "labels").where(remainder != 0).select("doc_id", "toxic"))
    return toxicity.score(docs, index).select(
        "doc.doc_id",
        (F.crc32(F.col("doc.doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out"),
        "score",
        "predicted",
        F.transform("evidence", lambda e: e["doc_id"]).alias("neighbours"),
    )
