"""Compound normalisation, n-gram mining, candidates and dictionaries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noria.functions.text import bound, strip_spaces, year_span
from noria.operators.rules import nested, normalize_arrays
from noria.session import ship_package
from noria.store import Store


def normalize(x: Column, rules: list[tuple[str, str]]) -> Column:
    """Fixed replacements, one after the other: an early one can make input for a later one.  A nested expression for a few rules."""
    return nested(x, rules)


def dictionary_rules(terms: list[str], rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The rules, then a rule for each spaced term that they do not name."""
    known = {a for a, _ in rules}
    return rules + [(t, t.replace(" ", "")) for t in dict.fromkeys(terms) if " " in t and t not in known]


def normalize_list(df: DataFrame, rules: list[tuple[str, str]], column: str = "nouns") -> DataFrame:
    """`column` normalised, and n_changed: how many of its values changed."""
    after = "__after"
    done = df.withColumn(after, normalize_arrays(df.sparkSession, F.col(column), rules))
    changed = F.size(F.filter(F.zip_with(column, after, lambda a, b: a != b), lambda x: x))
    return done.withColumn("n_changed", changed).withColumn(column, F.col(after)).drop(after)


def long_words(df: DataFrame, column: str = "nouns", least: int = 2) -> DataFrame:
    return df.withColumn(column, F.filter(column, lambda x: F.length(x) >= least))


def ngrams_of(words: Column | str, n: int) -> Column:
    """Windows of n words joined by a space; none of fewer words."""


    def found(x):
        windows = F.transform(F.sequence(F.lit(1), F.size(x) - n + 1), lambda i: F.array_join(F.slice(x, i, F.lit(n)), " "))
        return F.when(F.size(x) >= n, windows).otherwise(F.array().cast("array<string>"))

    return bound(words, found)


def mine_ngrams(df: DataFrame, sizes: list[int] = (2, 3), least: int = 1, most: int | None = 100, column: str = "nouns") -> DataFrame:
    """(ngram, frequency, ngram_size, pos_tag): per size the `most` frequent; one pass and one shuffle for all sizes."""
    sized = lambda x, n: F.transform(ngrams_of(x, n), lambda x: F.struct(x.alias("ngram"), F.lit(n).alias("ngram_size")))
    every = bound(column, lambda x: F.flatten(F.array(*[sized(x, n) for n in sizes])))
    out = df.select(F.explode_outer(every).alias("g")).where("g is not null").groupBy("g.ngram", "g.ngram_size").agg(F.count("*").alias("frequency")).where(F.col("frequency") >= least)
    if most is not None:
        rank = F.row_number().over(Window.partitionBy("ngram_size").orderBy(F.desc("frequency"), "ngram"))
        out = out.withColumn("rank", rank).where(F.col("rank") <= most)
    return out.select("ngram", "frequency", "ngram_size", F.lit("NNG").alias("pos_tag"))


def mine_nested(df: DataFrame, size: int = 2, most: int | None = 100, column: str = "nouns") -> DataFrame:
    """`mine_ngrams` of `size` and one more, for words that are not null and hold no space.

    With `most`, df is read twice: hashes are counted first, then only the n-grams that a
    count lets among the `most` are made and counted as texts.  Without it, or where more
    than FEW n-grams are tied there, all are.
    """
    if most:
        wanted = frequent_keys(df, [size, size + 1], most, column)
        if wanted is not None:
            rank = F.row_number().over(Window.partitionBy("ngram_size").orderBy(F.desc("frequency"), "ngram"))
            found = ngrams_of_keys(df, wanted, column).withColumn("rank", rank).where(F.col("rank") <= most)
            return found.select("ngram", "frequency", "ngram_size", F.lit("NNG").alias("pos_tag"))
    return mine_nested_texts(df, size, most, column)


def mine_nested_texts(df: DataFrame, size: int = 2, most: int | None = 100, column: str = "nouns") -> DataFrame:
    """`mine_nested` in one pass, by texts.

    A row is shuffled for each place, dealt by its shorter n-gram: the longer one is that
    and a word, and the shorter one's count is the sum of what follows it, the end included.
    """
    ship_package(df.sparkSession)

    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            flat, doc = lists.flatten(), np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
            at = np.flatnonzero(doc[: max(len(doc) - size + 1, 0)] == doc[size - 1 :])
            head = pc.binary_join_element_wise(*[flat.take(pa.array(at + i)) for i in range(size)], " ")
            follows = np.append(doc, -1)[at + size] == doc[at]
            following = flat.take(pa.array(at + size, mask=~follows))
            counted = pa.table({"head": head, "next": following}).group_by(["head", "next"], use_threads=False).aggregate([([], "count_all")])
            yield from counted.select(["head", "next", "count_all"]).rename_columns(["head", "next", "n"]).combine_chunks().to_batches()

    found = df.select(column).mapInArrow(run, "head string, next string, n long")
    n = found.repartition("head").groupBy("head", "next").agg(F.sum("n").alias("n"))
    both = F.array(F.struct(F.lit(size).alias("ngram_size"), F.lit(None).cast("string").alias("next")), F.struct(F.lit(size + 1).alias("ngram_size"), F.col("next")))
    each_ = n.select("head", "n", F.explode(both).alias("g")).where((F.col("g.ngram_size") == size) | F.col("g.next").isNotNull())
    out = each_.groupBy("head", "g.next", "g.ngram_size").agg(F.sum("n").alias("frequency")).select(F.concat_ws(" ", "head", "next").alias("ngram"), "frequency", "ngram_size")
    if most is not None:
        rank = F.row_number().over(Window.partitionBy("ngram_size").orderBy(F.desc("frequency"), "ngram"))
        out = out.withColumn("rank", rank).where(F.col("rank") <= most)
    return out.select("ngram", "frequency", "ngram_size", F.lit("NNG").alias("pos_tag"))


#: Groups that the keys of n-grams are dealt to.
BUCKETS = 1 << 11
#: Places that a task holds before it hands their keys on.
HELD = 1 << 21
#: Keys that all tasks look up.
FEW = 1 << 16
#: Keys of a bucket that it hands on although they only tie for the last place.
TIED = 1 << 10


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _keys(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the n-grams of `size` words begin, their buckets and their keys: 11 and 64 bits, which together stand for an n-gram."""
    at = np.flatnonzero(doc[: max(len(doc) - size + 1, 0)] == doc[size - 1 :])
    key = hashes[at]
    for i in range(1, size):
        key = _mix(key) + hashes[at + i]
    bucket = _mix(_mix(key) + hashes[at]) >> np.uint64(53)
    return at, bucket.astype(np.uint16), key


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists as 64 bits, and the list of each."""
    return np.asarray(lists.flatten()).view(np.uint64), np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted row differs from the one before."""
    differs = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for c in columns:
        differs |= c[1:] != c[:-1]
    return np.flatnonzero(np.append(np.ones(min(len(columns[0]), 1), bool), differs))


def _hashed(column: str) -> Column:
    return F.transform(column, lambda x: F.xxhash64(x))


def key_counts(df: DataFrame, sizes: list[int], column: str, reduce, schema: str) -> DataFrame:
    """What `reduce(size, keys, n)` makes of a bucket's different keys of n-grams of `size` words, and of how often they are there; for all buckets and sizes.

    Texts stay where they are: a row of the shuffle holds a bucket's keys of some
    thousands of documents, counted, as numbers.  Equal keys count as equal n-grams.
    """
    ship_package(df.sparkSession)

    def dealt(held):
        for size, parts in zip(sizes, held, strict=True):
            bucket, key = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(key)
            order = order[np.argsort(bucket[order], kind="stable")]
            bucket, key = bucket[order], key[order]
            first = _starts(bucket, key)
            n = np.diff(np.append(first, len(key))).astype(np.int32)
            bucket, key = bucket[first], key[first].view(np.int64)
            at = _starts(bucket)
            offsets = pa.array(np.append(at, len(key)).astype(np.int32))
            columns = [pa.array(bucket[at].astype(np.int32)), pa.array(np.full(len(at), size, np.int32)), pa.ListArray.from_arrays(offsets, pa.array(key)), pa.ListArray.from_arrays(offsets, pa.array(n))]
            yield from pa.table(columns, names=["bucket", "ngram_size", "keys", "n"]).to_batches(max_chunksize=256)

    def run(batches):
        held, places = [[] for _ in sizes], 0
        for batch in batches:
            hashes, doc = _flat(batch.column(0))
            for size, parts in zip(sizes, held, strict=True):
                parts.append(_keys(hashes, doc, size)[1:])
            places += len(hashes)
            if places >= HELD:
                yield from dealt(held)
                held, places = [[] for _ in sizes], 0
        if places:
            yield from dealt(held)

    def summed(group, table):
        out = []
        for size in sizes:
            of = table.filter(pc.equal(table["ngram_size"], size))
            key, n = (pc.list_flatten(of[c]).to_numpy() for c in ("keys", "n"))
            if len(key):
                order = np.argsort(key)
                first = _starts(key[order])
                out.append(reduce(size, key[order][first], np.add.reduceat(n[order].astype(np.int64), first)))
        return pa.concat_tables(out)

    found = df.select(_hashed(column)).mapInArrow(run, "bucket int, ngram_size int, keys array<long>, n array<int>")
    return found.groupBy("bucket").applyInArrow(summed, schema)


def ngram_sizes(df: DataFrame, sizes: list[int] = (2, 3), column: str = "nouns") -> DataFrame:
    """(ngram_size, n, total): how many different n-grams of each size there are, and how many in all."""

    def reduce(size, keys, n):
        return pa.table({"ngram_size": pa.array([size], pa.int32()), "n": [len(keys)], "total": [int(n.sum())]})

    each_ = key_counts(df, list(sizes), column, reduce, "ngram_size int, n long, total long")
    return each_.groupBy("ngram_size").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def frequent_keys(df: DataFrame, sizes: list[int], most: int, column: str) -> dict[int, np.ndarray] | None:
    """The keys, sorted, of each size's n-grams that occur as often as its `most`-th; None if they are more than FEW.

    A bucket hands on what occurs as often as its own `most`-th; of more than TIED that
    occur just as often, only that they are there (a null).
    """

    def reduce(size, keys, n):
        least = np.partition(n, len(n) - most)[len(n) - most] if len(n) > most else 0
        tied = np.count_nonzero(n == least)
        on = n > least if tied > TIED else n >= least
        key, n = pa.array(keys[on]), n[on]
        if tied > TIED:
            key, n = pa.concat_arrays([key, pa.nulls(1, pa.int64())]), np.append(n, least)
        return pa.table({"ngram_size": pa.array(np.full(len(n), size, np.int32)), "key": key, "n": n})

    counted = Store(df.sparkSession).keep(key_counts(df, sizes, column, reduce, "ngram_size int, key long, n long"), "keys")
    rank = F.row_number().over(Window.partitionBy("ngram_size").orderBy(F.desc("n")))
    least = counted.withColumn("rank", rank).where(F.col("rank") <= most).groupBy("ngram_size").agg(F.min("n").alias("least"))
    chosen = counted.join(F.broadcast(least), "ngram_size").where("n >= least").select("ngram_size", "key").limit(FEW + 1).collect()
    if len(chosen) > FEW or any(r["key"] is None for r in chosen):
        return None
    return {size: np.unique(np.array([r["key"] for r in chosen if r["ngram_size"] == size], np.int64).view(np.uint64)) for size in sizes}


def ngrams_of_keys(df: DataFrame, wanted: dict[int, np.ndarray], column: str) -> DataFrame:
    """(ngram, ngram_size, frequency) of the n-grams that have one of the wanted keys of their size."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            words = batch.column(0).flatten()
            hashes, doc = _flat(batch.column(1))
            for size, keys in shared.value.items():
                at, _, key = _keys(hashes, doc, size)
                if len(keys):
                    at = at[keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key]
                    text = pc.binary_join_element_wise(*[words.take(pa.array(at + i)) for i in range(size)], " ")
                    counted = pc.value_counts(text)
                    yield pa.RecordBatch.from_arrays([counted.field(0), pa.array(np.full(len(counted), size, np.int32)), counted.field(1)], ["ngram", "ngram_size", "n"])

    found = df.select(column, _hashed(column)).mapInArrow(run, "ngram string, ngram_size int, n long")
    return found.groupBy("ngram", "ngram_size").agg(F.sum("n").alias("frequency"))


def dictionary_candidates(ngrams: DataFrame, least: int = 1, longest: int = 20) -> DataFrame:
    """Candidates of at least two words and at most `longest` characters, each n-gram once."""
    ok = ngrams.where((F.col("ngram_size") >= 2) & (F.col("frequency") >= least) & (F.length("ngram") <= longest) & F.forall(F.split("ngram", " "), lambda w: F.length(w) >= 1))
    return keep_first(ok, ["ngram"], [F.desc("frequency"), F.col("ngram_size")])


def keep_first(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key in a stated order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def merge_candidates(df: DataFrame, mode: str, key: str = "word", freq: str = "freq", order: str = "ord") -> DataFrame:
    """One row per word: 'sum' of the frequencies, the row of the 'max', or the 'mean' rounded half to even."""
    if mode == "max":
        return keep_first(df, [key], [F.desc(freq), F.col(order)])
    value = F.sum(freq) if mode == "sum" else F.bround(F.avg(freq)).cast("long")
    rest = [c for c in df.columns if c not in (key, freq, order)]
    return df.groupBy(key).agg(value.alias(freq), *[F.min_by(c, order).alias(c) for c in rest])


def review(df: DataFrame, *more: str) -> DataFrame:
    """(word, freq, context, pos, type, concept, trend) and the columns `more` from parsed recommendations (word, freq, context, type, concept, trend)."""
    return df.select("word", "freq", "context", F.lit("NNP").alias("pos"), F.col("type"), F.substring("concept", 1, 100).alias("concept"), year_span("trend").alias("trend"), *more).orderBy(F.desc("freq"), "word")


def quality_flags(df: DataFrame, generic: list[str], low: int = 2) -> DataFrame:
    """+ cut_short, generic, low_frequency, duplicated."""
    return df.withColumns({"cut_short": F.regexp_like("word", F.lit(r"\s[가-힣]$")), "generic": F.col("word").isin(generic) if generic else F.lit(False), "low_frequency": F.col("freq") <= low, "duplicated": F.count("*").over(Window.partitionBy("word")) > 1})


BINS = (100, 50, 20, 10, 5, 3)


def frequency_bins(df: DataFrame, freq: str = "freq") -> DataFrame:
    """(bin, bin_order, n)."""
    label, order = F.lit(f"<{BINS[-1]}"), F.lit(len(BINS) + 1)
    for i, b in reversed(list(enumerate(BINS))):
        label, order = F.when(F.col(freq) >= b, F.lit(f">={b}")).otherwise(label), F.when(F.col(freq) >= b, F.lit(i + 1)).otherwise(order)
    return df.groupBy(label.alias("bin"), order.alias("bin_order")).agg(F.count("*").alias("n"))


def frequency_summary(df: DataFrame, freq: str = "freq") -> DataFrame:
    return df.agg(F.round(F.avg(freq), 6).alias("mean_freq"), F.min(freq).alias("min_freq"), F.max(freq).alias("max_freq"))


def dictionary_entries(df: DataFrame, word: str, tag: str, default_tag: str, priority: int, order: str, score: float = 0.0) -> DataFrame:
    """(word, tag, score, priority, ord): words without spaces; an empty or null tag is the default."""
    w = strip_spaces(F.col(word))
    named = F.coalesce(F.when(F.col(tag) != "", F.col(tag)), F.lit(default_tag)) if tag in df.columns else F.lit(default_tag)
    return df.where(F.col(word).isNotNull() & (F.col(word) != "")).select(w.alias("word"), named.alias("tag"), F.lit(score).alias("score"), F.lit(priority).alias("priority"), F.col(order).cast("string").alias("ord"))


def merge_dictionaries(parts: list[DataFrame]) -> DataFrame:
    """(word, tag, score) by word; of a word in several parts the lower priority stays."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return keep_first(every, ["word"], [F.col("priority"), F.col("ord")]).select("word", "tag", "score").orderBy("word")
