"""Many ordered rules, word boundaries, run metrics and the dictionary's feedback."""

import random

import pytest
from pyspark.sql import functions as F

from noria.operators import corpus, dtm, ngrams, nouns, rules
from noria.plans import feedback, metrics
from noria.plans.pipeline import EngineConfig, Pipeline


def chained(text, given):
    for a, b in given:
        text = text.replace(a, b) if a else text
    return text


def test_ten_thousand_rules_equal_chained_replaces(spark):
    rng = random.Random(4)
    letters = "abcde "
    spaced = ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(10_000)]
    given = [(a, "".join(rng.choices(letters, k=rng.randint(len(a) - 2, len(a))))) for a in spaced]  # none grows a text
    # rules whose outcome is the input of a later one, the same input twice, and an empty one
    given[:0] = [("x y", "xy"), ("xy z", "xyz"), ("", "never"), ("x y", "none"), ("aa", "a")]
    texts = ["".join(rng.choices("abcdexyz  ", k=rng.randint(0, 25))) for _ in range(60)] + ["x y z", "", "é x y"]
    want = {t: chained(t, given) for t in texts}
    df = spark.createDataFrame([(i, t, [t, "x y z", None]) for i, t in enumerate([*texts, None])], "i int, t string, ts array<string>")
    got = df.select("t", rules.normalize_texts(spark, F.col("t"), given).alias("u"), rules.normalize_arrays(spark, F.col("ts"), given).alias("us")).collect()
    for r in got:
        assert r["u"] == (None if r["t"] is None else want[r["t"]])
        assert r["us"] == [r["u"], want["x y z"], None]


def test_built_in_rules(spark):
    assert len(rules.NOUN_RULES) == 22 and len(rules.TEXT_RULES) == 9
    df = spark.createDataFrame([("1", ["정신 건강 실태 조사", "비자살적 자해 청소년", "정서 조절 곤란", "x"])], "doc_id string, nouns array<string>")
    r = ngrams.normalize_list(df, rules.NOUN_RULES).first()
    assert r["nouns"] == ["정신건강실태조사", "비자살적자해청소년", "정서조절곤란", "x"] and r["n_changed"] == 3
    many = rules.NOUN_RULES + [(f"n{i} m", f"n{i}m") for i in range(40)]
    assert ngrams.normalize_list(df, many).first()["nouns"] == r["nouns"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("can't stop 3.14, 1,000; e.g. x", ["can't", "stop", "3.14", "1,000", "e.g", "x"]),
        ("self-report a-1 -b c- --", ["self-report", "a-1", "b", "c"]),
        ("학생들의 자해 행동(2021)", ["학생들의", "자해", "행동", "2021"]),
        ("漢字かな カタカナー abc漢", ["漢", "字", "か", "な", "カタカナー", "abc", "漢"]),
        ("été naïve l’été", ["été", "naïve", "l’été"]),
        ("a1b2 snake_case __ x:y 10:30 3.a a.3", ["a1b2", "snake_case", "x:y", "10", "30", "3", "a", "a", "3"]),
        ("a😀b $5 c++ 'q'", ["a", "b", "5", "c", "q"]),
        ("", []),
    ],
)
def test_word_boundaries(spark, text, want):
    df = spark.createDataFrame([("1", text)], "doc_id string, abstract string")
    assert df.select(dtm.word_break(F.col("abstract"))).first()[0] == want
    assert [w for w in want if len(w) >= 2] == dtm.words(df).first()["nouns"]


def test_words_of_hyphens_and_long_tokens(spark):
    df = spark.createDataFrame([("1", "self-report " + "a." * 20_000 + "b " + "x" * 50_000)], "doc_id string, abstract string")
    assert [len(w) for w in dtm.words(df, split_hyphens=True).first()["nouns"]] == [4, 6, 40_001, 50_000]


def test_metrics_of_stages(spark, tmp_path):
    times = metrics.partition_times(spark)
    tagger = nouns.PythonTagger(lambda: lambda text: [(w, "NNG") for w in (1 / 0 if text.startswith("bad") else text.split())], times)
    rows = [(f"t{i}", ("bad " if i % 10 == 0 else "apple pear ") * 5) for i in range(40)]
    raw = spark.createDataFrame(rows, "title string, abstract string").repartition(4)
    engine = Pipeline(spark, str(tmp_path / "out"), EngineConfig(topics=2, max_em=2), tagger)
    engine.run(raw, (1, 2))
    found = {r["stage"]: r for r in engine.metrics().collect()}
    assert found["corpus"]["rows"] == 40 and found["corpus"]["documents"] is None and found["corpus"]["rows_per_second"] > 0
    m = found["nouns"]
    assert (m["documents"], m["failures"], m["success_rate"], m["rows"]) == (40, 4, 0.9, 40)
    assert 0 < m["efficiency"] <= 1 and m["uneven"] == (m["efficiency"] < metrics.UNEVEN) and m["partitions"] >= 1
    again = metrics.Watch("none", metrics.partition_times(spark))
    assert again.metrics().rows == 0


def test_a_new_dictionary_retags_what_it_touches(spark, tmp_path):
    words = ["self harm", "school", "survey", "panel", "data"]
    rows = [(f"title {i}", f"the {words[i % 5]} of case{i} in the long report on topics") for i in range(50)]
    raw = spark.createDataFrame(rows, "title string, abstract string")
    first, second = tmp_path / "one.tsv", tmp_path / "two.tsv"
    first.write_text("school\tNNP\t0\npanel\tNNP\n")
    second.write_text("school\tNNP\t0\nself harm\tNNP\t0\npanel\tNNG\t0\n")
    made = {p: nouns.DictionaryTagger(spark, nouns.longest_match, str(p)) for p in (first, second)}
    engine = Pipeline(spark, str(tmp_path / "a"), EngineConfig(topics=2, max_em=2), made[first], dictionary=str(first))
    engine.run(raw, (1, 2))
    report, done = engine.new_dictionary(str(second), made[second], (3, 4))
    assert {k: v[0] for k, v in report.steps.items()} == {"ngrams": "done", "dtm": "done"}
    assert (done.changed_words, done.documents, done.retagged, done.share) == (2, 50, 20, 0.4)
    full = Pipeline(spark, str(tmp_path / "b"), EngineConfig(topics=2, max_em=2), made[second], dictionary=str(second))
    full.run(raw, (1, 2, 3, 4))
    for name in ("tokens", "nouns", "ngrams", "dtm"):
        assert sorted(map(str, engine.table(name).collect())) == sorted(map(str, full.table(name).collect()))
    assert any(t["form"] == "self harm" for r in engine.table("tokens").collect() for t in r["tokens"])
    # no change, no document; a document without kept tokens is tagged
    docs = corpus.analysis_projection(full.table("corpus"))
    same = spark.read.text(str(second)).select(F.split("value", "\t").alias("f")).selectExpr("f[0] as word", "f[1] as tag", "cast(f[2] as double) as score")
    none = feedback.retag(docs, full.table("tokens").where("doc_id > 'doc5'"), same, same, made[second], str(tmp_path / "c"))
    assert none.changed_words == 0 and none.retagged == full.table("tokens").where("doc_id <= 'doc5'").count()
    assert sorted(map(str, none.tokens.collect())) == sorted(map(str, full.table("tokens").collect()))


def test_reports_and_the_topic_table(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"title {i}", " ".join(rng.choice(["apple", "pear", "plum"] if i % 2 else ["steel", "iron", "zinc"]) for _ in range(30)), f"20{i % 20:02d}") for i in range(40)]
    raw = spark.createDataFrame(rows, "title string, `other texts` string, pub_year string")
    engine = Pipeline(spark, str(tmp_path / "out"), EngineConfig(topics=2, max_em=3))
    engine.run(raw)
    assert engine.table("topic_table").columns == ["doc_id", "Topic1", "Topic2", "pub_year"] and engine.table("topic_table").count() == 40
    model = engine.search_topics([2, 3])
    assert model.k in (2, 3) and {r["k"] for r in engine.table("topic_counts").collect()} == {2, 3}
    made = engine.reports()
    assert set(made) == {"structure", "morphemes", "ngrams", "topics", "comparison"}
    texts = {k: (tmp_path / "out/reports" / f"{k}.md").read_text() for k in made}
    assert "| abstract | string |" in texts["structure"] and "| 2003 | 2 |" in texts["structure"]
    assert "| 40 | 120 | 3.0 | 6 |" in texts["morphemes"] and "## Run" in texts["morphemes"]
    assert "## 2 words" in texts["ngrams"] and "## Words by frex" in texts["topics"] and "title " in texts["topics"]
    assert "## Best by each metric" in texts["comparison"]
    assert engine.reports() == made


def test_many_topics_are_warned_of(spark, tmp_path):
    rows = [(f"t{i}", "apple pear plum fig kiwi " * 3) for i in range(12)]
    engine = Pipeline(spark, str(tmp_path / "out"), EngineConfig(topics=4, max_em=1))
    with pytest.warns(UserWarning, match="many for 12"):
        engine.run(spark.createDataFrame(rows, "title string, abstract string"))


def test_quarantine_holds_bad_files_and_records(spark, tmp_path):
    from noria.sources import files

    (tmp_path / "good.json").write_text('[{"추천명사": "a", "빈도수": 3}, {"추천명사": " ", "빈도수": 1}, {"추천명사": "b", "빈도수": "many"}]')
    (tmp_path / "bad.json").write_text('[{"추천명사": "c", "빈도수": 3}, {')
    held = {(r["source_file"], r["problem"]): r["raw"] for r in files.quarantine(spark, str(tmp_path)).collect()}
    assert set(held) == {("good.json", "word"), ("good.json", "frequency"), ("bad.json", "file")}
    assert '"many"' in held["good.json", "frequency"] and '"c"' in held["bad.json", "file"]
    assert sorted((r["word"], r["freq"]) for r in files.read_recommendations(spark, str(tmp_path)).collect() if r["freq"]) == [("a", 3)]


def test_three_dialects_of_candidates_and_mixed_types(spark, tmp_path):
    from noria.sources import files

    (tmp_path / "a.csv").write_text("ngram,frequency,pos_tag\nx y,3,\n,1,NNG\n")
    (tmp_path / "b.csv").write_text("word,freq,pos\nz,4,NNP\n")
    (tmp_path / "c.csv").write_text("noun\nw\n")
    (tmp_path / "d.csv").write_text("other\nw\n")
    got = [sorted(map(tuple, files.read_candidates(spark, str(tmp_path / f"{n}.csv")).collect())) for n in "abc"]
    assert got == [[("x y", "NNG", 3)], [("z", "NNP", 4)], [("w", "NNP", None)]]
    with pytest.raises(ValueError, match="ngram, word or noun"):
        files.read_candidates(spark, str(tmp_path / "d.csv"))
    a, b = spark.createDataFrame([(1, "p")], "id int, x string"), spark.createDataFrame([("q2", 5)], "id string, y int")
    both = corpus.union_by_name([a, b])
    assert dict(both.dtypes) == {"id": "string", "x": "string", "y": "int"} and sorted(r["id"] for r in both.collect()) == ["1", "q2"]
    (tmp_path / "words.tsv").write_text("# x\ta\na b\tNNG\nnotab\n")
    assert [r["word"] for r in files.read_dictionary_words(spark, str(tmp_path / "words.tsv")).collect()] == ["a b"]
    files.write_with_metadata(a, str(tmp_path / "m"), model="k")
    assert spark.read.json(str(tmp_path / "m/metadata")).first()["model"] == "k" and spark.read.parquet(str(tmp_path / "m/data")).count() == 1


def test_bounds_of_document_frequency(spark):
    cells = spark.createDataFrame([("1", "a", 1), ("2", "a", 1), ("3", "a", 1), ("1", "b", 2), ("2", "c", 1)], "doc_id string, term string, tf long")
    assert {r["term"] for r in dtm.trim(cells, 2, 1, 2).collect()} == {"b"}
    assert {r["term"] for r in dtm.trim(cells, 1, 2).collect()} == {"a"}
