"""The five reports, in Markdown: Spark makes each section's rows, of which at most MOST reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noria.operators import corpus, nouns, topics
from noria.sources import storage

MOST = 50


def table(df: DataFrame, title: str, most: int = MOST) -> str:
    """A section of the first rows."""
    rows = df.limit(most).collect()
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in rows]) + "\n"


def _report(title: str, *sections: str) -> str:
    return f"# {title}\n\n" + "\n".join(sections)


def structure(df: DataFrame) -> str:
    """Of a standardised corpus: its columns, samples of the texts, validity, and documents by year."""
    parts = [table(corpus.column_profile(df), "Columns"), table(corpus.text_samples(df), "Samples"), table(corpus.validate(df, "morpheme"), "Checks")]
    if "pub_year" in df.columns:
        parts.append(table(df.groupBy("pub_year").agg(F.count("*").alias("documents")).orderBy("pub_year"), "Documents by year", 200))
    return _report("Structure", *parts)


def morphemes(tokens: DataFrame, found: DataFrame, metrics: DataFrame | None = None) -> str:
    """Of tagged documents and their nouns: totals, frequent nouns, prefixes, suffixes and what they stand with, and the run."""
    tags = ["NNG", "NNP"]
    return _report(
        "Morphemes",
        table(nouns.noun_totals(found), "Totals"),
        table(nouns.noun_document_frequency(found, 20), "Nouns by documents"),
        table(nouns.tag_totals(tokens, ["XPN", "XSN"]), "Affixes"),
        table(nouns.tag_frequency(tokens, "XSN", 15), "Suffixes"),
        table(nouns.tag_runs(tokens, tags, ["XSN"], k=20), "Noun and suffix"),
        table(nouns.tag_frequency(tokens, "XPN", 15), "Prefixes"),
        table(nouns.tag_runs(tokens, ["XPN"], tags, not_third=["XSN"], k=15), "Prefix and noun"),
        table(nouns.tag_runs(tokens, ["XPN"], tags, ["XSN"], k=10), "Prefix, noun and suffix"),
        *([table(metrics, "Run")] if metrics is not None else []),
    )


def ngram_report(mined: DataFrame, candidates: DataFrame, most: int = 20) -> str:
    """Of mined n-grams: how many of each size, the most frequent of each, and the candidates for the dictionary."""
    sizes = mined.groupBy("ngram_size").agg(F.count("*").alias("ngrams"), F.sum("frequency").alias("frequency")).orderBy("ngram_size")
    each = [table(mined.where(F.col("ngram_size") == n).orderBy(F.desc("frequency"), "ngram").select("ngram", "frequency"), f"{n} words", most) for n in sorted(r["ngram_size"] for r in sizes.collect())]
    return _report("N-grams", table(sizes, "Sizes"), *each, table(candidates.orderBy(F.desc("frequency"), "ngram_size", "ngram"), "Candidates", most))


def topic_report(beta: DataFrame, theta: DataFrame, titles: DataFrame | None = None, effects: DataFrame | None = None, words: int = 10) -> str:
    """Of a topic model: shares, words by each label, representative documents, correlations and effects."""
    scored = topics.label_scores(beta)
    labels = [table(topics.top_words(scored, by, words).groupBy("topic").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), ", ").alias("words")).orderBy("topic"), f"Words by {by}", 100) for by in ("prob", "frex", "lift", "score")]
    first = topics.representative(theta, 2)
    if titles is not None:
        first = first.join(titles, "doc_id", "left")
    return _report(
        "Topics",
        table(topics.mean_share(theta).orderBy(F.desc("mean_prop"), "topic"), "Shares", 100),
        table(topics.dominant(theta).orderBy("topic"), "Documents by their largest topic", 100),
        table(topics.concentration(theta), "Concentration"),
        *labels,
        table(first.orderBy("topic", "rank"), "Representative documents", 200),
        table(topics.correlations(theta).where("linked").orderBy(F.desc("corr")), "Correlated topics"),
        *([table(effects.orderBy("topic", "term"), "Effects of covariates", 500)] if effects is not None else []),
    )


METRICS = ["heldout", "semcoh", "exclusivity", "residual", "bound"]


def comparison(metrics: DataFrame) -> str:
    """Of a search over topic counts: its metrics, their summary, trends and scaled values, and the best count by each."""
    m = metrics.select("k", *[F.col(c).cast("double").alias(c) for c in METRICS])
    return _report(
        "Topic counts",
        table(metrics.orderBy("k"), "Metrics", 100),
        table(topics.metric_summary(m, METRICS).orderBy("metric"), "Summary"),
        table(topics.metric_trend(m, METRICS).orderBy("metric"), "Trends"),
        table(topics.normalize_metrics(m, METRICS).orderBy("metric", "k"), "Scaled to 0-1", 500),
        table(topics.best_k(m, METRICS).orderBy("metric"), "Best by each metric"),
    )


def write_report(spark: SparkSession, text: str, path: str) -> str:
    """One file on any file system; an older one is replaced."""
    storage.delete(spark, path)
    return storage.write_one(spark.createDataFrame([(text,)], "value string"), path, "text")
