"""From raw documents to token ids, in stages that each work on what the one before kept.

1. Language ID: documents whose language cannot be told go.
2. Line dedup: lines that many sites share stay in one document only; documents of which no word is left go.
3. Near dedup: of each group of near copies the document of least id stays.
4. Mixing: sources are drawn to tempered weights; a document drawn in several epochs has several rows.
5. Byte-level BPE: the ids of each text, with digests of the ids and of the bytes they decode to.

Every stage takes and, but for the last, returns the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import boilerplate, bpe, language, mixing, nearcopies
from evenkeel.llm.common import scratch, table
from evenkeel.llm.queries import REPEATS


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, public_tokenizers.path("piece_bpe_32k.model"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return boilerplate.clean(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, value=REPEATS).select(*(F.col(f"`{c}`") for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_level_bpe", encode),
]

#: Language ID and near dedup have no SQL; the tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
