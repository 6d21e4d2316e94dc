"""Branches that small inputs don't take: blocks, large joins, several query blocks, thresholds by language, odd pipeline inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from noria.llm import metric_search, minmax, mixing, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sets_of(texts, k):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute(texts, k, percent):
    s, root = sets_of(texts, k), list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(s))]


@pytest.mark.parametrize("items", [40, 1 << 17])
def test_near_duplicates_between_blocks(spark, monkeypatch, items):
    """Groups whose members drift apart, so that many candidates stay apart and are compared in blocks of about `items`."""
    monkeypatch.setattr(minmax, "BLOCK_ITEMS", items)
    rng = np.random.default_rng(12)
    texts = []
    for g in range(6):
        w = [f"g{g}w{i}" for i in rng.integers(0, 90, 70)]
        for step in range(14):
            texts.append(" ".join(w))
            for j in rng.integers(0, 70, 2 + step % 3):
                w[j] = f"n{rng.integers(10**6)}"
    rows = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r["component_id"] for r in minmax.near_duplicates(rows).collect()}
    want = brute(texts, 5, 80)
    assert [got[i] for i in range(len(texts))] == want and 6 < len(set(want)) < len(texts)


def test_mixing_joins_many_leaves(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "a b c " * (i % 5 + 1), "en", f"s{i % 7}", 0) for i in range(200)], DOCS)
    mixed = lambda: sorted(map(str, mixing.mix_sources(rows, F.lit("d"), 0.4, 2, {}, 3).collect()))
    want = mixed()
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", -1)
    assert mixed() == want and len(want) > 50


def test_search_with_several_query_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(metric_search, "QUERIES", 7)
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in metric_search.top_k(rows, F.col("vec_id") % 10 == 0, 5, shard_rows=60).collect())
    whole = np.floor(64 * x).astype(np.int64)
    score = whole @ whole.T
    want = []
    for q in range(0, 400, 10):
        best = sorted((-int(score[q, c]), c) for c in range(400) if c != q)[:5]
        want += [(q, rank, c, -s) for rank, (s, c) in enumerate(best, 1)]
    assert got == sorted(want)


def test_thresholds_by_language():
    """In one language the classes part at high scores, in another at low ones, and a third has too few rows."""
    rng = np.random.default_rng(5)
    y = np.arange(600) % 2
    z = np.where(y == 1, 3.0, -3.0)
    langs = ["a"] * 300 + ["b"] * 280 + ["c"] * 20
    z[:300] += 2.0 + rng.normal(0, 0.3, 300)
    z[300:] -= 2.0 + rng.normal(0, 0.3, 300)
    model = toxicity.Model()
    toxicity.calibrate(model, z, y.astype(float), langs)
    assert set(model.thresholds) == {"a", "b"} and model.thresholds["a"] >= model.thresholds["b"] >= 0.4
    p = toxicity.probability(model, z)
    for lang in "ab":
        mine = np.array([x == lang for x in langs])
        assert ((p[mine] >= model.thresholds[lang]) == (y[mine] > 0)).mean() > 0.95


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    rng = np.random.default_rng(6)
    texts = [" ".join([*rng.choice([f"w{i}" for i in range(90)], 30), *(["idiot"] * (i % 4 == 0))]) for i in range(80)]
    rows = [(i % 70, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)] + [(None, texts[0], "en", "src0", 3), (5, None, None, None, None)]
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(70)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(rows, DOCS).withColumn("id", F.lit("x")).withColumn("pass", F.lit(1)).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_repeated_ids_extra_columns_and_no_rows(spark, folder, tmp_path, empty):
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns = now.columns
    now = now.where("false") if empty else now
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        counts.append(now.count())
        if name != "packing":
            assert now.columns == columns
    assert counts == [0] * 5 if empty else counts[0] >= counts[1] >= counts[2] > 0 and counts[3] > 0 and counts[4] > 0


def test_archives_without_content(spark):
    from noria.llm import warc

    none = spark.createDataFrame([("a", None), ("b", b""), ("c", b"junk")], "path string, content binary")
    assert [(r["path"], r["kind"], r["end"]) for r in warc.read_archives(none).collect()] == [("c", "gap", 4)]


@pytest.mark.parametrize("scale", [8, 3000])
def test_a_block_of_queries_searches_trees_together(scale):
    """Many queries at once, two trees one after the other, copies and equal scores, in single and double precision: as brute force."""
    rng = np.random.default_rng(9)
    x = rng.integers(-scale, scale, (6000, 64))
    x[300:700] = x[0]
    x[5000:5040] = x[0]
    ids, k = np.arange(6000) * 3, 20
    trees = [metric_search.MTree.load(metric_search.MTree(ids[part], x[part]).dump(), 64) for part in (slice(0, 3500), slice(3500, 6000))]
    own = np.arange(0, 6000, 6)
    best = metric_search.Best(len(own), k)
    for tree in trees:
        tree.search_block(x[own].astype(float), ids[own], best)
    at, found, scores = best.rows()
    assert (at.reshape(-1, k) == np.arange(len(own))[:, None]).all()
    product = (x[own] @ x.T).astype(float)
    product[np.arange(len(own)), own] = -np.inf
    want = np.argsort(-product, axis=1, kind="stable")[:, :k]
    assert (found.reshape(-1, k) == ids[want]).all() and (scores.reshape(-1, k) == np.take_along_axis(product, want, 1)).all()
