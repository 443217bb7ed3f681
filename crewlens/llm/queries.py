"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.llm import (
    chat, embeddings, html_text, line_dedup, minhash, mixing, negatives, packing, pieces, quality_classifier,
    quality_rules, toxicity, whitening,
)
from crewlens.llm.tables import lines, read
from crewlens.session import tune

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"

QUERIES: dict[str, Query] = {}


def register(function: Query) -> Query:
    """Adaptive execution splits skewed joins of the queries only under the session's settings."""
    QUERIES[function.__name__] = lambda spark, sf_dir: function(tune(spark), sf_dir)
    return function


def _fold(folds: int):
    """The remainder that tells held-out documents from those to learn from; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds


def _scored(spark, sf_dir, operator, label: str, folds: int, held: int, threshold: float) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(_fold(folds) != held)
    model = operator.fit(docs, labels.select("doc_id", F.col(label).alias("label")))
    return operator.score(docs, model).select(
        "doc_id", (_fold(folds) == held).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


@register
def op1_toxicity(spark, sf_dir):
    return _scored(spark, sf_dir, toxicity, "toxic", 5, 0, 0.5)


@register
def op2_line_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    left = line_dedup.marked(docs).select(
        "row.doc_id", F.col("row.text").alias("before"), "runs",
        line_dedup.left_over(F.col("row.text"), F.col("runs")).alias("text"))
    deleted = F.transform("runs", lambda r: F.sequence(r["low"], r["high"] - 1))
    count = lambda text: F.size(lines(F.col(text))).cast("bigint")
    return left.select(
        "doc_id", count("before").alias("n_lines"),
        F.coalesce(F.size(F.array_distinct(F.flatten(deleted))), F.lit(0)).cast("bigint").alias("n_deleted"),
        "text", F.length("text").cast("bigint").alias("n_chars"))


@register
def op3_quality_classifier(spark, sf_dir):
    return _scored(spark, sf_dir, quality_classifier, "quality", 4, 2, 0.7)


@register
def op4_embedding_dedup(spark, sf_dir):
    return embeddings.groups(read(spark, sf_dir, "embeddings"))


@register
def op5_minhash_dedup(spark, sf_dir):
    return minhash.groups(read(spark, sf_dir, "documents"))


@register
def op6_chat_formatting(spark, sf_dir):
    said = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = F.lit(r"\### Assistant: </turn> ok")
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), tricky.alias("text"))
    return chat.read_back(chat.format_chat(chat.text_messages(said.unionByName(added))))


@register
def op7_packing(spark, sf_dir):
    pieces = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "document", "tier", "step_id")


@register
def op8_html_extraction(spark, sf_dir):
    return html_text.extract(read(spark, sf_dir, "pages"))


@register
def op9_mixing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.schedule(docs).select("row.doc_id", "row.source", "epoch", "block", "slot", "place", "release", "deadline")


@register
def op10_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(quality_rules.measure(read(spark, sf_dir, "documents"), ["doc_id"]))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_stop_words", "n_lines", "n_shouted_lines",
        F.array_join("broken_rules", ",").alias("broken_rules"))


@register
def op11_whitening(spark, sf_dir):
    found = whitening.whitened(read(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@register
def op12_hard_negatives(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@register
def op13_sentencepiece(spark, sf_dir):
    path = public_tokenizers.path(PIECES)
    found = pieces.decode(pieces.encode(read(spark, sf_dir, "documents"), path), path)
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
