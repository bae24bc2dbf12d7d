"""One query per operator, with the settings of production, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, boilerplate, bpe, idfile, language, maintext, mixing, nearcopies, passages, quality, ranked, topk, wordbpe,
)
from .common import scratch, table

VOCABULARY = "piece_bpe_32k.model"
#: No source is repeated more than so often beside the least repeated one; the mix has three times all tokens, so that
#: every document is drawn in whole epochs and some in one more.
REPEATS, SHARE = 1.3, 3.0


def byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, public_tokenizers.path(VOCABULARY))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-ids")
    encoder = idfile.word_encoder(spark, public_tokenizers.path("word_bpe_49k.json"))
    idfile.write(table(spark, sf_dir, "documents"), path, encoder, end_id=2)
    return idfile.read_documents(spark, path)


def mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    drawn = mixing.mix(docs, value=REPEATS, share=SHARE)
    return drawn.drop("text")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(*quality.COLUMNS)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = boilerplate.remove(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return found.select(
        "doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("n_chars"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(table(spark, sf_dir, "pages"))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.classes(table(spark, sf_dir, "documents"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.remove(table(spark, sf_dir, "documents"))
    size = F.aggregate("runs", F.lit(0).cast("long"), lambda t, r: t + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_bytes", size.alias("n_removed"), F.size("runs").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordbpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path(VOCABULARY))


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_mixing_weights": (mixing_weights, mixing.oracle(REPEATS, SHARE)),
    "op2_near_dedup": (near_dedup, None),
    "op3_exact_top_k": (exact_top_k, topk.oracle()),
    "op4_html_extraction": (html_extraction, None),
    "op5_quality_rules": (quality_rules, quality.oracle()),
    "op6_byte_level_bpe": (byte_level_bpe, None),
    "op7_language_id": (language_id, None),
    "op8_suffix_dedup": (suffix_dedup, None),
    "op9_token_files": (token_files, None),
    "op10_line_dedup": (line_dedup, boilerplate.oracle()),
    "op11_backtracking_bpe": (backtracking_bpe, None),
    "op12_token_alignment": (token_alignment, None),
    "op13_ranked_search": (ranked_search, ranked.oracle()),
}
