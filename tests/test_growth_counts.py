"""Terms leave a task counted, and documents meet tables of terms by chunks: equal to the plain forms, with fewer rows."""

import random

import pytest
from pyspark.sql import functions as F

from noria.operators import dtm, nouns
from noria.plans import catalog

WORDS = ["re", "un", "tion", "ing", "the", "a", "haus", "baum", "garten", "straße", "ÉTÉ", "語語語", "Σας"]


@pytest.fixture
def documents(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(3, 40))), rng.choice(["de", "en", "fr", None])) for i in range(300)]
    rows += [(1000, None, "de"), (1001, "too short", "de"), (1002, "einmalig allein", "fr"), (None, "haus baum garten haus", "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_terms_leave_a_task_counted(spark, documents):
    tagger, texts = catalog._tagger(), catalog._corpus(spark, documents).withColumn("half", F.crc32("abstract") % 2)
    cells = tagger.cells(texts, "half")
    want = rows_of(cells.groupBy("term", "half").agg(F.count("*")))
    counts = tagger.counts(texts, "half")
    assert rows_of(counts.groupBy("term", "half").agg(F.sum("n"))) == want
    assert counts.count() < cells.count() / 2
    assert rows_of(catalog._stats(spark, documents)) == rows_of(dtm.term_stats(catalog._cells(spark, documents)))
    assert tagger.counts(texts.where("false"), "half").count() == 0


def test_counts_that_are_handed_on_early_add_up(spark, documents):
    tagger, texts = catalog._tagger(), catalog._corpus(spark, documents).coalesce(1)
    want = rows_of(tagger.cells(texts).groupBy("term").agg(F.count("*")))
    split, lists = [], tagger._split(texts, ()).toArrow()
    # the bound on held rows is met after every batch
    before = nouns.COUNTED
    try:
        nouns.COUNTED = 3
        run = nouns.counting(tagger, (), 2)
        for batch in run(iter(lists.to_batches(max_chunksize=40))):
            split += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
    finally:
        nouns.COUNTED = before
    added = {}
    for term, n in split:
        added[term] = added.get(term, 0) + n
    assert sorted(added.items(), key=str) == want and len(split) > len(added)


def test_a_term_is_a_row_a_chunk_and_sums_equal_the_join(spark, documents):
    tagger, texts = catalog._tagger(), catalog._corpus(spark, documents)
    cells, coded = tagger.cells(texts), tagger.coded(texts)
    assert coded.where("term is not null").count() < cells.count() / 2
    values = spark.createDataFrame([("haus", 1.0, 2.0), ("garten", 0.25, None), ("nirgends", 9.0, 9.0)], "term string, x double, y double")
    want = cells.join(values, "term").groupBy("doc_id").agg(F.sum("x"), F.coalesce(F.sum("y"), F.lit(0.0)))
    assert rows_of(dtm.sums(coded, values)) == rows_of(want)
    vocab = spark.createDataFrame([(2, "haus"), (1, "garten"), (3, "allein")], "term_id int, term string")
    assert rows_of(dtm.listed_codes(coded, vocab)[0]) == rows_of(dtm.listed(cells, vocab)[0])


def test_theta_and_lists_of_chunks_equal_those_of_cells(spark, documents, monkeypatch):
    both = {}
    for unique in (True, False):
        monkeypatch.setattr(catalog, "_unique", lambda *_, u=unique: u)
        both[unique] = rows_of(catalog._theta(spark, documents)), rows_of(catalog._listed(spark, documents)[0]), rows_of(catalog._beta(spark, documents))
    assert both[True] == both[False] and all(both[True])
