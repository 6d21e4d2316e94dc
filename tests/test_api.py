"""Presets, settings from arguments, readers and writers, and small helpers."""

import pytest

from noria.operators import corpus
from noria.plans import pipeline
from noria.sources import files


def raw(spark):
    rows = [(f"t{i}", ("apple pear plum " if i % 2 else "steel iron zinc ") * 6) for i in range(20)]
    return spark.createDataFrame(rows, "title string, abstract string")


def test_presets(spark, tmp_path):
    config = pipeline.EngineConfig.from_args(["--topics", "2", "--max-em", "1", "--ngram-sizes", "2,3"])
    assert (config.topics, config.max_em, config.ngram_sizes) == (2, 1, (2, 3))
    short = pipeline.run_nouns_only(spark, str(tmp_path / "a"), raw(spark), config=config)
    assert list(short.steps) == ["corpus", "nouns"]
    rest = pipeline.run_without_ngrams(spark, str(tmp_path / "b"), raw(spark), config=config)
    assert list(rest.steps) == ["corpus", "nouns", "dtm", "topics"]
    whole = pipeline.run_full(spark, str(tmp_path / "c"), raw(spark), config=config)
    assert [s for s, _ in whole.steps.values()] == ["done"] * 5
    assert pipeline.Pipeline(spark, str(tmp_path / "b")).missing_outputs() == ["ngrams"]


def test_a_failing_step_of_ngrams_is_tolerated_and_others_are_not(spark, tmp_path):
    engine = pipeline.Pipeline(spark, str(tmp_path / "a"), pipeline.EngineConfig(topics=2, max_em=1))
    assert engine.run(steps=(3,)).steps["ngrams"][0] == "failed"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        engine.run(steps=(4,))


def test_settings_are_checked():
    for bad in ({"ngram_sizes": (1,)}, {"min_frequency": 0}, {"topics": 200}, {"ngram_sizes": ()}):
        with pytest.raises(ValueError, match="n-gram|at least|topics"):
            pipeline.EngineConfig(**bad)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("007", 'a "q", b\nc'), ("8", "é")], "doc_id string, noun_extraction string")
    files.write_csv(df, str(tmp_path / "x"), one_file=True)
    assert len(list((tmp_path / "x").glob("part-*"))) == 1
    got = files.read_csv(spark, str(tmp_path / "x"), "doc_id string, noun_extraction string")
    assert sorted(map(tuple, got.collect())) == [("007", 'a "q", b\nc'), ("8", "é")]
    df.write.json(str(tmp_path / "y.json"))
    both = files.read_many(spark, [str(tmp_path / "y.json")])
    assert both.count() == 2 and {r["source_file"] for r in both.collect()} == {"y.json"}


def test_columns(spark):
    df = spark.createDataFrame([("1", "a", None, 3), ("2", None, "text that is long enough", 4)], "doc_id string, x string, abstract string, y int")
    assert corpus.metadata_columns(df, ["abstract", "x"]).columns == ["doc_id", "y"]
    assert corpus.missing_columns(df, ["doc_id", "z"]) == ["z"]
    assert {(r["column"], r["sample"]) for r in corpus.text_samples(df).collect()} == {("doc_id", "1"), ("x", "a"), ("abstract", "text that is long en")}
    assert corpus.topic_metadata(df, ["x", "none"]).columns == ["doc_id", "x"]


def test_rows_without_an_id_are_numbered_by_ranges(spark):
    df = spark.createDataFrame([(None, f"v{i:03d}") for i in range(300)] + [("a", "1"), ("a", "2"), ("b", "3"), ("row", "4")], "doc_id string, x string").repartition(5)
    got = {r["x"]: r["doc_id"] for r in corpus.standardize_ids(df, only_duplicates=True).collect()}
    assert got["v000"] == "row_001" and got["v299"] == "row_300" and len(set(got.values())) == 304
    assert (got["1"], got["2"], got["3"], got["4"]) == ("a", "a_001", "b", "row")
