"""The corpus pipeline: toxicity, line dedup, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir); docs has the columns of `documents`, and so has
what all stages but the last return.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noria.llm import line_dedup, minmax, mixing, packing, toxicity
from noria.llm.common import Scratch
from noria.llm.queries import MIX_DOMAIN_SQL, MIX_FRACTION, MIX_SEED, MIX_WEIGHTS


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under their language's threshold; one at the threshold goes.

    Null texts and texts without words stay.  Repeated rows and rows with a null id are
    judged each; a null language has the threshold 0.5.  An empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject_toxic(docs, toxicity.train(docs, labels, F.lit(True)))


def lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; n_chars follows the text.

    No row goes: a text of which nothing is left is "", a null text stays null, and so
    does its n_chars.  Null sources are one site; repeated rows are pages of their own.
    """
    out = line_dedup.drop_boilerplate_lines(docs).drop("n_dropped_lines")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id: five words, a similarity of 0.8.

    Of rows that share an id, the first by content stays.  Null texts, texts without
    words and rows with a null id link with nothing and stay.
    """
    return minmax.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source mixture, each document at most once, the last one of a leaf cut; n_chars follows the text.

    A null language or source is the name ""; documents without words are not taken.
    Documents of equal hashes follow each other by content, repeated rows one by one.
    """
    out = mixing.mixed_texts(mixing.mix_sources(docs, F.expr(MIX_DOMAIN_SQL), MIX_FRACTION, 1, MIX_WEIGHTS, MIX_SEED))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row per piece.

    A null or empty text is its end token alone; repeated rows and null ids are packed
    each.  An empty table gives no pieces.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxic_out), ("line_dedup", lines_out), ("near_dedup", copies_out), ("mixing", mixed), ("packing", packed)]

#: Trained models and tokenizers are not expressible in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
