import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from noria.functions import text as fn
from noria.operators import corpus, dtm, ngrams, nouns, stm, topics
from noria.plans.pipeline import EngineConfig
from noria.sources import files


def nouns_of(spark, *texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, abstract string")
    out = nouns.extract_nouns(nouns.PretaggedTagger().tag(df)).collect()
    return [r["nouns"] for r in sorted(out, key=lambda r: int(r["doc_id"]))]


def test_affixes(spark):
    given = ["비/XPN 정상/NNG 적/XSN", "비/XPN 정상/NNG 을/JKO", "정상/NNG 적/XSN 이/VCP", "비/XPN 정상/NNG 적/XSN 적/XSN", "비/XPN 가/JKS 적/XSN", "교육/NNG 학교/NNP 교육/NNG", ""]
    assert nouns_of(spark, *given) == [["비정상적"], ["비정상"], ["정상적"], ["비정상적", "적"], ["비", "적"], ["교육", "학교"], []]


def scan(tokens):
    out, i = [], 0
    while i < len(tokens):
        tags = [t for _, t in tokens[i : i + 3]] + [""] * 3
        noun = ("NNG", "NNP")
        n = 3 if tags[0] == "XPN" and tags[1] in noun and tags[2] == "XSN" else 2 if (tags[0] == "XPN" and tags[1] in noun) or (tags[0] in noun and tags[1] == "XSN") else 1 if tags[0] in (*noun, "XPN", "XSN") else 0
        if n:
            out.append("".join(f for f, _ in tokens[i : i + n]))
        i += n or 1
    return list(dict.fromkeys(out))


def test_nouns_equal_a_scanner(spark):
    rng = random.Random(1)
    lists = [[(rng.choice("abcd") * rng.randint(1, 2), rng.choice(["XPN", "NNG", "NNP", "XSN", "JKS"])) for _ in range(rng.randint(1, 12))] for _ in range(300)]
    assert nouns_of(spark, *[" ".join(f"{f}/{t}" for f, t in x) for x in lists]) == [scan(x) for x in lists]


def test_ngrams_and_rules(spark):
    df = spark.createDataFrame([("1", ["a"]), ("2", ["a", "b", "c"])], "doc_id string, nouns array<string>")
    got = {(r["ngram"], r["ngram_size"], r["frequency"]) for r in ngrams.mine_ngrams(df).collect()}
    assert got == {("a b", 2, 1), ("b c", 2, 1), ("a b c", 3, 1)}
    one = lambda rules: spark.range(1).select(ngrams.normalize(F.lit("x y z"), rules)).first()[0]
    assert one([("x y", "xy"), ("xy z", "xyz")]) == "xyz"
    assert one([("xy z", "xyz"), ("x y", "xy")]) == "xy z"


def test_scalar_functions(spark):
    df = spark.createDataFrame([("발행 2021",), ("2021-03",), ("c2021",), ("-",)], "x string")
    assert [r[0] for r in df.select(fn.first_year("x")).collect()] == [2021, 2021, None, None]
    assert spark.range(1).select(fn.year_span(F.lit("2001 1999 2010"))).first()[0] == "1999-2010"


def test_ids_and_validation(spark):
    df = spark.createDataFrame([("T x", "A", "I"), ("t  X", "a", "i"), (None, None, None)], "title string, author string, institution string")
    ids = sorted(r["doc_id"] for r in corpus.standardize_ids(df).collect())
    assert len(set(ids)) == 3 and any(x.endswith("_001") for x in ids) and ids[-1].startswith("row_")
    again = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "id string, title string")
    assert all(r["doc_id"].startswith("doc") for r in corpus.standardize_ids(again).collect())
    assert not {r["check"]: r["passed"] for r in corpus.validate(again.withColumnRenamed("id", "doc_id")).collect()}["unique_ids"]


def test_candidates_and_dictionary(spark):
    df = spark.createDataFrame([("w", 2, "1", "x"), ("w", 3, "2", "y")], "word string, freq long, ord string, note string")
    assert [ngrams.merge_candidates(df, m).first()["freq"] for m in ("sum", "max", "mean")] == [5, 3, 2]
    a = ngrams.dictionary_entries(spark.createDataFrame([("a", "NNG")], "w string, t string"), "w", "t", "NNG", 0, "w")
    b = ngrams.dictionary_entries(spark.createDataFrame([("a", "NNP"), ("b c", "")], "w string, t string"), "w", "t", "NNP", 1, "w")
    assert [tuple(r)[:2] for r in ngrams.merge_dictionaries([a, b]).collect()] == [("a", "NNG"), ("bc", "NNP")]


def test_weights(spark):
    cells = spark.createDataFrame([("1", "t", 3), ("1", "u", 1)], "doc_id string, term string, tf long")
    w = {r["term"]: r["weight"] for r in dtm.tfidf(cells, 10).collect()}
    assert w["t"] == pytest.approx(3.0)
    assert dtm.tfidf(cells, 1).first()["weight"] == 0.0
    assert [r["term"] for r in dtm.trim(cells).collect()] == ["t"]


def test_dominant_topic_takes_the_lower_on_ties(spark):
    t = spark.createDataFrame([("d", 1, 0.5), ("d", 2, 0.5)], "doc_id string, topic int, prop double")
    assert topics.dominant(t).first()["topic"] == 1


def test_topic_model_recovers_topics(spark):
    rng = np.random.default_rng(0)
    k, v = 3, 30
    beta = np.full((k, v), 0.002)
    for i in range(k):
        beta[i, i * 10 : (i + 1) * 10] = 0.1
    beta /= beta.sum(axis=1, keepdims=True)
    rows = []
    for d in range(120):
        c = rng.multinomial(60, rng.dirichlet([0.2] * k) @ beta)
        rows.append((str(d), [(int(i) + 1, int(n)) for i, n in enumerate(c) if n]))
    docs = spark.createDataFrame(rows, "doc_id string, terms array<struct<term_id:int,tf:bigint>>").repartition(2)
    vocab = spark.createDataFrame([(i + 1, f"w{i:02d}") for i in range(v)], "term_id int, term string")
    m = stm.fit(docs, vocab, k, max_em=12)
    cos = (m.beta / np.linalg.norm(m.beta, axis=1)[:, None]) @ (beta / np.linalg.norm(beta, axis=1)[:, None]).T
    assert sorted(cos.argmax(axis=1)) == [0, 1, 2] and cos.max(axis=1).min() > 0.9
    total = stm.theta(m, docs).groupBy("doc_id").agg(F.sum("prop").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1) for r in total)


def test_sources(spark, tmp_path):
    files.write_xlsx([["제목", "연도"], ["a<b", "2020"], [None, "2021"]], str(tmp_path / "x.xlsx"))
    got = sorted(files.read_exports(spark, str(tmp_path)).collect(), key=lambda r: r["연도"])
    assert [r["제목"] for r in got] == ["a<b", None] and got[0]["source_file"] == "x.xlsx"
    (tmp_path / "r.json").write_text('[{"추천명사": "n", "빈도수": 3, "추천근거": [{"맥락적_용례": ["u", "v"], "시계열적_동향": "2001 2004"}]}]')
    r = ngrams.review(files.read_recommendations(spark, str(tmp_path / "r.json"))).first()
    assert (r["word"], r["freq"], r["context"], r["trend"]) == ("n", 3, "u", "2001-2004")
    (tmp_path / "d.tsv").write_text("# c\na b\tNNG\t1.5\nc\tNNP\n")
    assert [tuple(r) for r in files.read_dictionary(spark, str(tmp_path / "d.tsv")).collect()] == [("a b", "NNG", 1.5), ("c", "NNP", 0.0)]


def test_config():
    assert EngineConfig.from_env({"NORIA_NGRAM_SIZES": "2,4"}).ngram_sizes == (2, 4)
    with pytest.raises(ValueError, match="topics"):
        EngineConfig(topics=1)
    assert re.fullmatch(r"\d{8}_\d{6}_a_b\.csv", files.stamped("a", "b", "csv"))
    assert corpus.clean_names(["a b", "a-b", "1"]) == ["a_b", "a_b_1", "v_1"]


def test_the_rest_works_without_the_operators():
    import __spark_entry__

    assert "tfidf_top_terms" in __spark_entry__.queries()


def test_given_ids_that_look_like_suffixes_stay_unique(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("1_001", "c"), (None, "d"), (None, "e")], "doc_id string, x string")
    ids = sorted(r["doc_id"] for r in corpus.standardize_ids(df, only_duplicates=True).collect())
    assert ids == ["1", "1_001", "1__001", "row__001", "row__002"]


def test_rows_without_any_part_are_numbered_and_long_runs_keep_their_number(spark):
    df = spark.createDataFrame([("t", i) for i in range(1102)] + [(None, i) for i in range(3)], "title string, i int")
    ids = [r["doc_id"] for r in corpus.generate_hash_ids(df, ["i"]).orderBy("doc_id").collect()]
    assert len(set(ids)) == 1105 and {"row_1", "row_2", "row_3"} <= set(ids) and any(x.endswith("_1101") for x in ids)


def test_columns_of_an_export_that_was_not_standardised(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], "`논문 일련` string, `영문 초록` string, `국문 초록문` string, source_file string")
    assert corpus.resolve_columns(df) == ("논문 일련", "국문 초록문")
    assert corpus.resolve_columns(spark.createDataFrame([(1, "a")], "x int, y string")) == ("x", "y")
    real = spark.createDataFrame([("7", "초록 " * 40, "c2020"), ("8", "초록 " * 40, "2021")], "`Article ID` string, `국문 초록 (Abstract)` string, `Publication Year` string")
    got = corpus.standardize(real).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["pub_year"]) for r in got] == [("7", None), ("8", 2021)] and got[0]["abstract"].startswith("초록")


def test_punctuation_ends_a_word(spark):
    df = spark.createDataFrame([("1", "a.b cd-ef, gh (ij)12 +kl")], "doc_id string, abstract string")
    assert dtm.tokenize(df).first()["nouns"] == ["cd", "ef", "gh", "ij", "12", "kl"]


def test_tags_and_a_python_tagger(spark):
    def make():
        return lambda text: [(w, "XSN" if w == "s" else "NNG") for w in (1 / 0 if text == "bad" else text.split())]

    df = spark.createDataFrame([("1", "a s b s"), ("2", "bad"), ("3", None)], "doc_id string, abstract string")
    tagged = nouns.PythonTagger(make).tag(df)
    assert {r["doc_id"]: r["nouns"] for r in nouns.extract_nouns(tagged).collect()} == {"1": ["as", "bs"], "2": [], "3": []}
    assert {(r["tag"], r["kinds"], r["total"]) for r in nouns.tag_totals(tagged, ["XSN", "NNG"]).collect()} == {("XSN", 1, 2), ("NNG", 2, 2)}


def test_pipeline_and_stream(spark, tmp_path):
    from noria.plans.pipeline import EngineConfig, Pipeline
    from noria.streaming.nouns import stream_nouns

    rng = random.Random(2)
    rows = [(f"title {i}", " ".join(rng.choice(["apple", "pear", "plum"] if i % 2 else ["steel", "iron", "zinc"]) for _ in range(30))) for i in range(40)]
    raw = spark.createDataFrame(rows, "title string, abstract string")
    engine = Pipeline(spark, str(tmp_path / "out"), EngineConfig(topics=2, max_em=3))
    report = engine.run(raw)
    assert [s for s, _ in report.steps.values()] == ["done"] * 5 and engine.missing_outputs() == []
    assert {r["feature"] for r in engine.table("terms").collect()} == {"apple", "pear", "plum", "steel", "iron", "zinc"}
    engine.table("corpus").select("doc_id", "abstract").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id string, abstract string").parquet(str(tmp_path / "in"))
    stream_nouns(stream, nouns.RuleTagger([], [], []), str(tmp_path / "found"), str(tmp_path / "check")).awaitTermination()
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "found")).collect())) == sorted(map(str, engine.table("nouns").collect()))
