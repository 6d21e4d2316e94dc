"""N-grams are counted by keys: the same results as by texts, and texts that are not wanted stay where they are."""

import random
from collections import Counter

import pytest

from noria.operators import ngrams
from noria.plans import catalog


def shuffled(spark, run) -> tuple[list, int]:
    """What `run` returns, and the bytes that were shuffled meanwhile."""
    sc = spark.sparkContext._jsc.sc()

    def total():
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorList(False).apply(0).totalShuffleWrite()

    before = total()
    rows = run()
    return rows, total() - before


@pytest.fixture(scope="module")
def long_words(spark, tmp_path_factory):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(100))
    texts = [" ".join([*(word() for _ in range(60)), *(("all", "rights", "reserved") if i % 2 else ())]) for i in range(1000)]
    path = str(tmp_path_factory.mktemp("long"))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    want = {n: Counter(" ".join(w[i : i + n]) for w in map(str.split, texts) for i in range(len(w) - n + 1)) for n in (2, 3)}
    return path, want


def test_sizes_shuffle_no_texts(spark, long_words):
    path, want = long_words
    rows, moved = shuffled(spark, lambda: catalog.QUERIES["ngram_size_counts"](spark, path).collect())
    assert {tuple(r) for r in rows} == {(n, len(c), sum(c.values())) for n, c in want.items()}
    # 13.9 million bytes when n-grams were shuffled as texts
    assert moved < 4 << 20


def frequent(want, most):
    return {(g, k, n) for n, c in want.items() for g, k in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:most]}


def test_frequent_ngrams_shuffle_no_texts_but_their_own(spark, long_words):
    path, want = long_words
    df = ngrams.long_words(catalog._kept_nouns(spark, path))
    rows, moved = shuffled(spark, lambda: ngrams.mine_nested(df, most=1).collect())
    assert {tuple(r)[:3] for r in rows} >= {("all rights reserved", 500, 3)} and len(rows) == 2
    assert {tuple(r)[:3] for r in rows} == frequent(want, 1)
    assert moved < 4 << 20


@pytest.mark.parametrize("query", ["ngrams_2_3", "dictionary_candidates", "user_dictionary_build", "dictionary_tag_distribution"])
def test_queries_shuffle_no_texts(spark, tmp_path, query):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(100))
    common = [f"{a}{b}{c}" for a in "wxyz" for b in "qrs" for c in "tuvwxyz"][:60]
    pairs = [" ".join(common[i : i + 4]) for i in range(0, 60)]
    texts = [" ".join([*(word() for _ in range(60)), *(pairs if i % 2 else ())]) for i in range(1000)]
    texts += [" ".join(rng.sample(common, 40)) for _ in range(600)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    (n, moved) = shuffled(spark, lambda: len(catalog.QUERIES[query](spark, str(tmp_path)).collect()))
    assert n > 0
    # 14.1 million bytes and more when n-grams were shuffled as texts; dictionary_tag_distribution also shuffles its nouns, once each
    assert moved < 9 << 20


@pytest.mark.parametrize(("few", "tied"), [(1 << 16, 1 << 10), (1 << 16, 2), (5, 1 << 10)])
def test_ties_are_whole_however_many(spark, monkeypatch, few, tied):
    """The smallest texts of those that tie for the last place, by keys or, where those are too many, by texts."""
    monkeypatch.setattr(ngrams, "FEW", few)
    monkeypatch.setattr(ngrams, "TIED", tied)
    rng = random.Random(3)
    lists = [[rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(0, 30))] for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in [*lists, None, []]], "nouns array<string>").repartition(3)
    want = {n: Counter(" ".join(w[i : i + n]) for w in lists for i in range(len(w) - n + 1)) for n in (2, 3)}
    for most in (1, 40, 5000):
        assert {tuple(r)[:3] for r in ngrams.mine_nested(df, most=most).collect()} == frequent(want, most)
    assert ngrams.mine_nested(df, most=0).count() == 0
    assert {tuple(r) for r in ngrams.ngram_sizes(df, [1, 2, 3]).collect()} == {(n, len(c), sum(c.values())) for n, c in [(1, Counter(w for x in lists for w in x)), *want.items()]}


def test_repeated_ngrams_and_no_rows(spark):
    rows = [([f"w{(i * j) % 97}" for j in range(12)],) for i in range(3000)]
    df = spark.createDataFrame(rows, "nouns array<string>")
    want = {n: Counter(" ".join(w[i : i + n]) for (w,) in rows for i in range(len(w) - n + 1)) for n in (2, 3)}
    assert {tuple(r)[:3] for r in ngrams.mine_nested(df, most=9).collect()} == frequent(want, 9)
    assert {tuple(r) for r in ngrams.ngram_sizes(df).collect()} == {(n, len(c), sum(c.values())) for n, c in want.items()}
    assert ngrams.ngram_sizes(df.where("false")).count() == 0 and ngrams.mine_nested(df.where("false")).count() == 0
