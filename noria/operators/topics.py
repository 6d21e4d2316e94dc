"""Topic analytics over beta(topic, term, prob) and theta(doc_id, topic, prop)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_scores(beta: DataFrame, weight: float = 0.5) -> DataFrame:
    """beta with frex, lift and score.  Ranks are of values rounded to 9 digits."""
    term, topic = Window.partitionBy("term"), Window.partitionBy("topic")
    b = beta.withColumn("exclusive", F.round(F.col("prob") / F.sum("prob").over(term), 9)).withColumn("common", F.round("prob", 9))
    b = b.withColumn("e", F.cume_dist().over(topic.orderBy("exclusive"))).withColumn("f", F.cume_dist().over(topic.orderBy("common")))
    b = b.withColumn("frex", F.round(1 / (weight / F.col("e") + (1 - weight) / F.col("f")), 6))
    b = b.withColumn("lift", F.round(F.col("prob") / F.avg("prob").over(term), 6))
    log = F.log(F.greatest("prob", F.lit(1e-12)))
    return b.withColumn("score", F.round(F.col("prob") * (log - F.avg(log).over(term)), 9)).select("topic", "term", "prob", "frex", "lift", "score")


def top_words(scored: DataFrame, by: str, k: int = 7) -> DataFrame:
    """(topic, rank, term)."""
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc(by), "term"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("topic", "rank", "term")


def mean_share(theta: DataFrame) -> DataFrame:
    return theta.groupBy("topic").agg(F.round(F.avg("prop"), 6).alias("mean_prop"))


def dominant(theta: DataFrame) -> DataFrame:
    """(topic, n_docs, pct): each document counts for its largest topic, the lowest on ties."""
    main = theta.groupBy("doc_id").agg(F.min_by("topic", F.struct(-F.round("prop", 9), F.col("topic"))).alias("topic"))
    n = main.groupBy("topic").agg(F.count("*").alias("n_docs"))
    return n.withColumn("pct", F.round(100.0 * F.col("n_docs") / F.sum("n_docs").over(Window.partitionBy(F.lit(0))), 4))


def concentration(theta: DataFrame) -> DataFrame:
    """(top3_share, balance, is_balanced) of the mean shares."""
    m = mean_share(theta)
    r = m.withColumn("r", F.row_number().over(Window.orderBy(F.desc("mean_prop"), "topic")))  # a row per topic
    one = r.agg(F.round(F.sum(F.when(F.col("r") <= 3, F.col("mean_prop"))), 6).alias("top3_share"), F.round(F.max("mean_prop") / F.min("mean_prop"), 4).alias("balance"))
    return one.withColumn("is_balanced", F.col("balance") < 5)


def wide(theta: DataFrame, topics: list) -> DataFrame:
    return theta.groupBy("doc_id").pivot("topic", topics).agg(F.first("prop"))


def representative(theta: DataFrame, n: int = 2) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc(F.round("prop", 9)), "doc_id"))
    return theta.withColumn("rank", rank).where(F.col("rank") <= n).select("topic", "rank", "doc_id")


def correlations(theta: DataFrame, cut: float = 0.01) -> DataFrame:
    """(topic_i, topic_j, corr, linked) for i < j."""
    a, b = theta.select("doc_id", F.col("topic").alias("topic_i"), F.col("prop").alias("x")), theta.select("doc_id", F.col("topic").alias("topic_j"), F.col("prop").alias("y"))
    c = a.join(b, "doc_id").where("topic_i < topic_j").groupBy("topic_i", "topic_j").agg(F.round(F.corr("x", "y"), 6).alias("corr"))
    return c.withColumn("linked", F.col("corr") > cut)


def coherence(cells: DataFrame, words: DataFrame) -> DataFrame:
    """(topic, coherence): sum over word pairs of ln((D(i, j) + 1) / D(j)), j the higher ranked."""
    hit = cells.join(F.broadcast(words), "term").select("topic", "rank", "doc_id")  # topics times top words
    d = hit.groupBy("topic", "rank").agg(F.count("*").alias("d"))
    x, y = hit.select("topic", "doc_id", F.col("rank").alias("i")), hit.select("topic", "doc_id", F.col("rank").alias("j"))
    both = x.join(y, ["topic", "doc_id"]).where("i > j").groupBy("topic", "i", "j").agg(F.count("*").alias("c"))
    w = words.select("topic", F.col("rank").alias("i")).join(words.select("topic", F.col("rank").alias("j")), "topic").where("i > j")
    every = w.join(both, ["topic", "i", "j"], "left").join(d.withColumnRenamed("rank", "j"), ["topic", "j"])
    return every.groupBy("topic").agg(F.round(F.sum(F.log((F.coalesce("c", F.lit(0)) + 1) / F.col("d"))), 6).alias("coherence"))


def exclusivity(scored: DataFrame, k: int = 10) -> DataFrame:
    """(topic, exclusivity): summed FREX of the k most probable words."""
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc(F.round("prob", 9)), "term"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("topic").agg(F.round(F.sum("frex"), 5).alias("exclusivity"))


def normalize_metrics(metrics: DataFrame, names: list[str]) -> DataFrame:
    """(k, metric, value, scaled): long, each metric scaled to 0-1."""
    long = metrics.unpivot("k", names, "metric", "value")
    w = Window.partitionBy("metric")
    span = F.max("value").over(w) - F.min("value").over(w)
    return long.withColumn("scaled", F.round(F.when(span > 0, (F.col("value") - F.min("value").over(w)) / span).otherwise(0.0), 6))


def metric_summary(metrics: DataFrame, names: list[str]) -> DataFrame:
    long = metrics.unpivot("k", names, "metric", "value")
    r = lambda x: F.round(x, 6)
    return long.groupBy("metric").agg(r(F.avg("value")).alias("mean"), r(F.stddev_samp("value")).alias("sd"), r(F.min("value")).alias("min"), r(F.max("value")).alias("max"))


def metric_trend(metrics: DataFrame, names: list[str]) -> DataFrame:
    long = metrics.unpivot("k", names, "metric", "value")
    return long.groupBy("metric").agg(F.round(F.corr("k", "value"), 6).alias("corr_k")).withColumn("rises", F.col("corr_k") > 0)


def best_k(metrics: DataFrame, names: list[str], decides: str = "heldout") -> DataFrame:
    """(metric, best_k, decides): the K of each metric's maximum, the least on ties."""
    long = metrics.unpivot("k", names, "metric", "value")
    return long.groupBy("metric").agg(F.min_by("k", F.struct(-F.col("value"), F.col("k"))).alias("best_k")).withColumn("decides", F.col("metric") == decides)
