"""Ranked lexical search over postings in term buckets, scored in 64-bit integers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from noria.llm.common import Scratch, raw, slices, span_hashes, word_spans

#: Item terms that are broadcast at most, about 40 bytes each; more are joined by a shuffle.
BROADCAST_TERMS = 1 << 20

#: Bytes between terms: all ASCII but letters and digits.
_APART = np.zeros(256, dtype=bool)
_APART[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

_FIELDS = "row long, id long, term long, tf int"


@dataclass
class Index:
    """postings: bucket, term (a 64-bit hash), row, tf.  docs: row, id, n (terms with repeats).  documents, length: N and L."""

    postings: DataFrame
    docs: DataFrame
    documents: int
    length: int


def _term_counts(whole: bool):
    """Rows (row, id, term, tf) of each text, and one with a null term and tf = n if `whole`; none of a text without terms."""

    def run(batches):
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, texts in slices(batch.column(1)):
                data, offsets = raw(texts)
                starts, ends, first = word_spans(data, offsets, _APART)
                h, n = span_hashes(data, starts, ends), np.diff(first)
                of = np.repeat(np.arange(len(texts)), n)
                order = np.lexsort((h, of))
                h, of = h[order], of[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
                edges = np.flatnonzero(new)
                tf = np.diff(np.append(edges, len(h)))
                full = np.flatnonzero(n) if whole else np.zeros(0, np.int64)
                row = np.concatenate([of[edges], full])
                term = pa.array(np.concatenate([h[edges].view(np.int64), np.zeros(len(full), np.int64)]), mask=np.arange(len(row)) >= len(edges))
                ids = batch.column(0).slice(lo, len(texts)).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(at + row), ids, term, pa.array(np.concatenate([tf, n[full]]).astype(np.int32))], ["row", "id", "term", "tf"])
                at += len(texts)

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> Index:
    """Postings of all documents, in the shared folder.

    Terms are the maximal runs of non-ASCII characters, ASCII letters and digits, only
    A-Z lower-cased.  A null or empty text has none and is no document of the index.
    Every row is a document of its own, whatever its id.  A term's postings lie in one
    bucket, which is dealt out by size: a bucket with a frequent term is several files.
    `docs` must give the same rows in the same order when a task is run again, as a
    table does.  buckets: spark.sql.shuffle.partitions where it is not given.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_term_counts(True), _FIELDS)
    bucket = F.coalesce(F.pmod("term", F.lit(buckets)), F.lit(-1)).cast("int").alias("bucket")
    table = scratch.cut(counted.select(bucket, "term", "row", "tf", F.when(F.col("term").isNull(), F.col("id")).alias("id")).hint("rebalance", "bucket"), "index", "bucket")
    found = table.where("bucket = -1").select("row", "id", F.col("tf").alias("n"))
    total = found.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    return Index(table.where("bucket >= 0").select("bucket", "term", "row", "tf"), found, total["documents"], total["length"])


def search(index: Index, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text", result_col: str = "doc_id") -> DataFrame:
    """The k highest-scoring documents of each item: id_col, rank, result_col, score.

    A term's weight w is floor(1000 * ln((2N + 2) / (2df + 1))), a document's m is 50 +
    (50nN div L); the score sums w * ((10**9 * tf) div (1000tf + 20m)) over the item's
    distinct terms.  Scores above 0 only; equal scores by ascending id, nulls first.
    An item without terms, or with a null text, has no rows; repeated items are ranked
    each for itself.

    Only the item terms' postings leave their buckets; they are dealt out by document,
    where the sums need no further shuffle.
    """
    spark, scratch = items.sparkSession, Scratch(items.sparkSession)
    asked = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    terms = scratch.cut(asked.mapInArrow(_term_counts(False), _FIELDS).select(F.col("row").alias("item"), F.col("id").alias("item_id"), "term"), "terms")
    small = terms.count() <= BROADCAST_TERMS
    bounded = F.broadcast if small else (lambda df: df)
    hits = scratch.cut(index.postings.join(bounded(terms.select("term").distinct()), "term", "left_semi").select("term", "row", "tf"), "hits")
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(index.documents) + 2) / (2 * F.col("df") + 1))).alias("w")
    weighted = scratch.cut(terms.join(df, "term").select("term", "item", "item_id", weight), "weights")
    docs = index.docs.select("row", "id", F.expr(f"cast(50 + (cast(50L * n as decimal(38,0)) * {index.documents}L) div {max(1, index.length)}L as bigint) as m"))
    one = F.expr("w * ((1000000000L * tf) div (1000L * tf + 20L * m))")
    scored = hits.join(docs, "row").join(bounded(weighted), "term").groupBy("item", "item_id", "row", "id").agg(F.sum(one).alias("score")).where("score > 0")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "id", "row")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(F.col("item_id").alias(id_col), "rank", F.col("id").alias(result_col), "score")


def oracle(k: int = 50) -> str:
    """DuckDB SQL for `search` over documents and benchmark (ids are unique)."""
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return rf"""
    with t as (select doc_id, unnest({words}) as term from documents),
    p as (select doc_id, term, count(*)::bigint as tf from t group by 1, 2),
    n as (select doc_id, sum(tf)::bigint as n from p group by 1),
    z as (select count(*)::bigint as docs, sum(n)::bigint as len from n),
    f as (select term, count(*)::bigint as df from p group by 1),
    i as (select distinct item_id, unnest({words}) as term from benchmark),
    w as (select item_id, term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from i join f using (term) cross join z),
    s as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // len))))::bigint as score
          from w join p using (term) join n using (doc_id) cross join z group by 1, 2),
    r as (select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score from s where score > 0)
    select item_id, rank, doc_id, score from r where rank <= {k}
    """
