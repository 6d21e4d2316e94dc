"""The dictionary's feedback: after a new version, only documents that a changed word can touch are tagged again."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noria.functions.text import strip_spaces
from noria.operators.nouns import Tagger
from noria.session import ship_package

#: Changed words that are searched for by an automaton in each worker; a dictionary is written and reviewed by people.
MOST_WORDS = 1_000_000


@dataclass
class Retagged:
    tokens: DataFrame
    changed_words: int
    documents: int
    retagged: int

    @property
    def share(self) -> float:
        return self.retagged / self.documents if self.documents else 0.0


def changed_words(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """(word): those whose tags or scores differ between two versions (word, tag, score) of a dictionary, without white space."""
    if old is None:
        found = new
    else:
        a, b = (t.select("word", "tag", F.col("score").cast("double").alias("score")).distinct() for t in (old, new))
        found = a.exceptAll(b).unionByName(b.exceptAll(a))
    return found.select(strip_spaces(F.col("word")).alias("word")).where("word != ''").distinct()


def holding(docs: DataFrame, words: list[str], text: str = "abstract") -> DataFrame:
    """(doc_id, held): whether a document's text holds one of the words, white space aside, as an analyser that tolerates spaces reads it."""
    spark = docs.sparkSession
    if not words:
        return docs.select("doc_id", F.lit(False).alias("held"))
    sent = spark.sparkContext.broadcast(words)
    made: list = []

    @F.pandas_udf("boolean")
    def held(texts: pd.Series) -> pd.Series:
        if not made:
            import ahocorasick

            made.append(ahocorasick.Automaton())
            for w in sent.value:
                made[0].add_word(w, True)
            made[0].make_automaton()
        return texts.map(lambda t: t is not None and next(made[0].iter(t), None) is not None)

    return docs.select("doc_id", held(strip_spaces(F.col(text))).alias("held"))


def retag(docs: DataFrame, kept: DataFrame, old: DataFrame | None, new: DataFrame, tagger: Tagger, path: str) -> Retagged:
    """Tokens of all documents under the new dictionary, written to `path`.

    docs(doc_id, abstract), ids unique; kept(doc_id, tokens): their tokens under the old
    one; tagger: with the new one.  Documents that hold a changed word, or have no kept
    tokens, are tagged; the others' tokens are taken over.  Equal to tagging all of them,
    if a word of the dictionary changes no text without it.
    """
    spark = docs.sparkSession
    ship_package(spark)
    words = [r["word"] for r in changed_words(old, new).orderBy("word").limit(MOST_WORDS + 1).collect()]
    if len(words) > MOST_WORDS:
        again = docs.withColumn("held", F.lit(True))
    else:
        again = docs.join(holding(docs, words), "doc_id")
    again = again.join(kept.select("doc_id", F.lit(True).alias("known")), "doc_id", "left").withColumn("again", F.col("held") | F.col("known").isNull())
    again.select("doc_id", "abstract", "again").write.mode("overwrite").parquet(f"{path}/state")
    state = spark.read.parquet(f"{path}/state")
    same = kept.join(state.where("not again").select("doc_id"), "doc_id", "left_semi")
    same.unionByName(tagger.tag(state.where("again").select("doc_id", "abstract"))).write.mode("overwrite").parquet(f"{path}/tokens")
    n = state.agg(F.count("*").alias("n"), F.count_if("again").alias("again")).first()
    return Retagged(spark.read.parquet(f"{path}/tokens"), len(words), n["n"], n["again"])
