"""Empty tables, nulls in any column, repeated rows and clashing names, for the ten operators."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from noria.llm import chat, embedding_dedup, line_dedup, lm, metric_search, minmax, mixing, packing, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, None, None, None, None), (None, "g h i", "en", "s", 5), (3, "", "fr", None, 0), (4, "Ünï ☃ " * 2000, "de", "t", 12000)]
#: Extra columns named like the operators' own working and result columns.
CLASHES = ("id", "text_", "key", "run", "pid", "host", "bad", "rep", "comp", "bands", "n", "pass", "tokens", "hash", "bucket", "__host", "__key", "__score")
PATH = public_tokenizers.path("byte_bpe_50k.json")

OPERATORS = {
    "line_dedup": lambda d: line_dedup.drop_boilerplate_lines(d),
    "packing": lambda d: packing.pack(d, PATH),
    "mixing": lambda d: mixing.mix_sources(d, F.lit("d"), 0.5, 2, {}, 1),
    "lm": lambda d: lm.lm_scores(d, shortlist=10, head=12),
    "minmax": lambda d: minmax.near_duplicates(d),
    "drop_near_duplicates": lambda d: minmax.drop_near_duplicates(d),
    "toxicity": lambda d: toxicity.score(d, toxicity.Model()),
}


@pytest.fixture(scope="module")
def crowded(spark):
    out = spark.createDataFrame(ROWS, DOCS)
    for c in CLASHES:
        out = out.withColumn(c, F.lit("x"))
    return out


#: What each operator gives for ROWS, by id: null and empty texts, repeated rows and a null id included.
WANT = {
    "line_dedup": (["doc_id", "text", "n_dropped_lines"], [(r[0], r[1], 0) for r in ROWS]),
    "mixing": (["doc_id", "mix_tokens", "mix_epochs", "mix_take"], [(1, 6, 2, 0), (1, 6, 2, 0), (None, 3, 2, 0), (4, 4000, 0, 1977)]),
    "lm": (["doc_id", "n_tokens"], [(1, 7), (1, 7), (2, 1), (None, 4), (3, 1), (4, 4001)]),
    "minmax": (["doc_id", "n_shingles", "component_id", "kept"], [(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (None, 1, None, True), (3, 0, 3, True), (4, 2, 4, True)]),
    "drop_near_duplicates": (["doc_id", "text"], [(r[0], r[1]) for r in ROWS[1:]]),
    "toxicity": (["doc_id", "toxicity", "toxicity_threshold"], [(r[0], 0.5, 0.5) for r in ROWS]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_nulls_repeats_and_clashing_names(crowded, name):
    out = OPERATORS[name](crowded)
    if name == "packing":
        got = {i: sum(r["length"] for r in out.collect() if r["doc_id"] == i) for i in (1, 2, 3, None)}
        assert got[2] == got[3] == 1 and got[1] == 2 * 7 and got[None] == 4
        return
    columns, want = WANT[name]
    assert sorted(map(repr, (tuple(r) for r in out.select(*columns).collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(crowded, name):
    assert OPERATORS[name](crowded.where("false")).count() == 0


def test_near_duplicates_keep_one_of_an_id_and_all_without_words(crowded):
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in minmax.drop_near_duplicates(crowded).collect())
    assert kept == [(False, 1), (False, 2), (False, 3), (False, 4), (True, 0)]


def test_toxicity_without_labels(spark, crowded):
    model = toxicity.train(crowded, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert toxicity.reject_toxic(crowded, model).columns == crowded.columns


def test_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int, id string, rep string"
    none = spark.createDataFrame([], schema)
    assert metric_search.top_k(none, F.col("vec_id") % 20 == 0).count() == 0
    assert embedding_dedup.embedding_duplicates(none).count() == 0
    odd = spark.createDataFrame([(0, [1.0, 0.0], 1, "x", "x"), (0, [1.0, 0.0], 1, "x", "x"), (1, [2.0, 0.0], None, None, None), (2, [], 1, "x", "x"), (3, None, 1, "x", "x"), (None, [1.0, 0.0], 1, "x", "x"), (4, [float("inf"), 1.0], 1, "x", "x"), (5, [1.0], 1, "x", "x")], schema)
    found = embedding_dedup.embedding_duplicates(odd).collect()
    assert len(found) == 8 and {r["component_id"] for r in found if r["vec_id"] in (0, 1)} == {0}
    best = metric_search.top_k(odd, F.col("vec_id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in best] == [(0, 1, 1, 64 * 128)]


@pytest.mark.parametrize("page", [2, 16, 256])
def test_tree_of_any_page_size_equals_brute_force(page):
    x = np.random.default_rng(5).integers(-60, 60, (700, 5))
    x[100:400] = x[7]  # more copies than a page holds
    ids = np.arange(700) * 3
    tree = metric_search.MTree(ids, x, page)
    tree = metric_search.MTree.load(tree.dump(), 5)
    assert (np.diff(np.sort(tree.ids)) > 0).all() and len(tree.ids) == 700
    for q in (0, 7, 250, 699):
        s = x @ x[q]
        want = [i for i in np.lexsort((ids, -s)) if i != q][:20]
        found, scores = tree.search(x[q], ids[q], 20)
        assert list(found) == list(ids[want]) and list(scores) == list(s[want])


def test_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(*chat.prefix_tree(none)).count() == 0
    rows = [(1, None, "user", "x" * 100_000, "a"), (1, 0, None, None, "a"), (1, 0, None, None, "a"), (None, 0, "user", "x", "a")]
    got = chat.read_back(*chat.prefix_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string"))).collect()
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in got] == [(1, 3, 0)]


def test_pages(spark):
    schema = "page_id long, url string, html string, kind string, record_id string"
    assert warc.write_and_read(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None, None, "k", "r"), (2, "u\r\nx: y", "é" * 100_000, "k", "r"), (3, "u", "é" * 100_000, None, None)]
    got = {r["record_id"]: (r["record_type"], r["refers_to"]) for r in warc.write_and_read(spark.createDataFrame(rows, schema)).where("kind = 'record'").collect()}
    assert got == {"1": ("response", None), "2": ("response", None), "3": ("revisit", "2")}
