"""The text-mining pipeline as one program, its configuration and its reports."""

from __future__ import annotations

import argparse
import os
import time
import warnings
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noria.operators import corpus, dtm, ngrams, nouns, rules, stm, topics
from noria.operators.nouns import RuleTagger, Tagger
from noria.plans import feedback, reports
from noria.plans.metrics import Watch, read_metrics, write_metrics
from noria.sources import files, storage


@dataclass(frozen=True)
class EngineConfig:
    """Typed settings; values are checked when it is made."""

    ngram_sizes: tuple[int, ...] = (2, 3)
    min_frequency: int = 1
    max_results: int = 100
    min_token_length: int = 2
    min_termfreq: int = 2
    min_docfreq: int = 1
    top_terms: int = 30
    topics: int | None = None
    max_em: int = 500
    seed: int = 848

    def __post_init__(self):
        if not self.ngram_sizes or not all(2 <= n <= 5 for n in self.ngram_sizes):
            raise ValueError("n-gram sizes are 2 to 5")
        if min(self.min_frequency, self.min_termfreq, self.min_docfreq, self.max_results) < 1:
            raise ValueError("frequencies and limits are at least 1")
        if self.topics is not None and not 2 <= self.topics <= 100:
            raise ValueError("topics are 2 to 100")

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, prefix: str = "NORIA_") -> EngineConfig:
        return cls(**_typed({k[len(prefix) :].lower(): v for k, v in (os.environ if env is None else env).items() if k.startswith(prefix)}))

    @classmethod
    def from_args(cls, args: list[str]) -> EngineConfig:
        p = argparse.ArgumentParser()
        for f in fields(cls):
            p.add_argument(f"--{f.name.replace('_', '-')}")
        return cls(**_typed({k: v for k, v in vars(p.parse_args(args)).items() if v is not None}))


def _typed(given: dict[str, str]) -> dict:
    names = {f.name for f in fields(EngineConfig)}
    return {k: tuple(int(x) for x in v.split(",")) if k == "ngram_sizes" else int(v) for k, v in given.items() if k in names}


@dataclass
class RunReport:
    steps: dict[str, tuple[str, float]] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)


class Pipeline:
    """Steps 1 corpus, 2 nouns, 3 n-grams (may fail), 4 document-term table, 5 topic model; each writes its tables under `out`.

    dictionary: a file of (word, tag, score); its spaced words join the compound rules of
    step 3, and a `DictionaryTagger` may have it too.  rules: of steps 3 and 4 in place of
    the built-in ones (those of step 3 hold only with a dictionary).  Beside each step's
    tables lie its metrics, under `out`/metrics.
    """

    STEPS = {1: "corpus", 2: "nouns", 3: "ngrams", 4: "dtm", 5: "topics"}

    def __init__(self, spark: SparkSession, out: str, config: EngineConfig | None = None, tagger: Tagger | None = None, rules: list[tuple[str, str]] | None = None, dictionary: str | None = None):
        self.spark, self.out, self.config = spark, out, config or EngineConfig()
        self.tagger, self.rules, self.dictionary = tagger or RuleTagger([], [], []), rules, dictionary

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        watch = getattr(self, "_watch", None)
        (watch.seen(df) if watch else df).write.mode("overwrite").parquet(f"{self.out}/{name}")
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")

    def run(self, raw: DataFrame | None = None, steps: tuple[int, ...] = (1, 2, 3, 4, 5)) -> RunReport:
        report = RunReport()
        for i in steps:
            name, began = self.STEPS[i], time.time()
            try:
                with Watch(name, getattr(self.tagger, "times", None) if i == 2 else None) as self._watch:
                    report.tables[name] = getattr(self, f"_{name}")(raw)
                write_metrics(self.spark, f"{self.out}/metrics/{name}", self._watch.metrics())
                report.steps[name] = ("done", (time.time() - began) / 60)
            except Exception:
                report.steps[name] = ("failed", (time.time() - began) / 60)
                if i != 3:
                    raise
            finally:
                self._watch = None
        return report

    def metrics(self) -> DataFrame:
        """A row for each step that ran."""
        return read_metrics(self.spark, *(e.path for e in storage.entries(self.spark, f"{self.out}/metrics")))

    def new_dictionary(self, dictionary: str, tagger: Tagger, steps: tuple[int, ...] = (3, 4, 5)) -> tuple[RunReport, feedback.Retagged]:
        """Another version of the dictionary: tags the documents it touches again, then runs the later steps.

        The tokens are written beside the old ones, which they then replace, so a lost
        driver leaves a whole table in one of the two places.
        """
        old = files.read_dictionary(self.spark, self.dictionary) if self.dictionary else None
        docs, made = corpus.analysis_projection(self.table("corpus")), f"{self.out}/retagged"
        done = feedback.retag(docs, self.table("tokens"), old, files.read_dictionary(self.spark, dictionary), tagger, made)
        storage.delete(self.spark, f"{self.out}/tokens")
        storage.rename(self.spark, f"{made}/tokens", f"{self.out}/tokens")
        done.tokens = self.table("tokens")
        storage.delete(self.spark, made)
        self.dictionary, self.tagger = dictionary, tagger
        self._keep("nouns", nouns.extract_nouns(self.table("tokens")))
        return self.run(steps=steps), done

    def _noun_rules(self) -> list[tuple[str, str]]:
        if self.rules is not None:
            return self.rules
        if self.dictionary is None:
            return []
        spaced = files.read_dictionary_words(self.spark, self.dictionary).where(F.contains("word", F.lit(" "))).limit(feedback.MOST_WORDS).collect()
        return ngrams.dictionary_rules([r["word"] for r in spaced], rules.NOUN_RULES)

    def _corpus(self, raw):
        done = corpus.standardize(raw)
        if "abstract" not in done.columns:  # no known header: by parts of headers, then the first text
            done = done.withColumnRenamed(corpus.resolve_columns(done)[1], "abstract")
        return self._keep("corpus", done)

    def _nouns(self, _):
        tagged = self._keep("tokens", self.tagger.tag(corpus.analysis_projection(self.table("corpus"))))
        return self._keep("nouns", nouns.extract_nouns(tagged))

    def _ngrams(self, _):
        words = ngrams.normalize_list(ngrams.long_words(self.table("nouns")), self._noun_rules())
        mined = self._keep("ngrams", ngrams.mine_ngrams(words, list(self.config.ngram_sizes), self.config.min_frequency, self.config.max_results))
        return self._keep("candidates", ngrams.dictionary_candidates(mined, self.config.min_frequency))

    def _dtm(self, _):
        used = rules.TEXT_RULES if self.rules is None else self.rules
        cells = dtm.dfm(ngrams.normalize_list(self.table("nouns"), used), least_length=self.config.min_token_length)
        kept = self._keep("dtm", dtm.trim(cells, self.config.min_termfreq, self.config.min_docfreq))
        self._keep("terms", dtm.tfidf_terms(kept, self.table("nouns").count(), self.config.top_terms))
        return kept

    def _topics(self, _):
        docs, vocab = dtm.stm_input(self.table("dtm"))
        n = docs.count()
        k = self.config.topics or stm.suggest_k(n)
        for warning in stm.check_k(k, n):
            warnings.warn(warning, stacklevel=2)
        # a run that was cut goes on from its last round
        model = stm.fit(docs, vocab, k, max_em=self.config.max_em, seed=self.config.seed, state=f"{self.out}/topic_rounds")
        stm.save(self.spark, model, f"{self.out}/topic_model")
        storage.delete(self.spark, f"{self.out}/topic_rounds")
        self._keep("beta", stm.beta_table(self.spark, model))
        self._keep("labels", topics.top_words(topics.label_scores(self.table("beta")), "prob"))
        kept = self._keep("theta", stm.theta(model, docs))
        wide = topics.wide(kept, list(range(1, model.k + 1)))
        named = wide.withColumnsRenamed({str(i): f"Topic{i}" for i in range(1, model.k + 1)})
        self._keep("topic_table", corpus.left_join_metadata(named, corpus.topic_metadata(self.table("corpus"))))
        return kept

    def reports(self) -> dict[str, str]:
        """The reports of the steps that have run, written under `out`/reports; name -> path."""
        has = lambda *names: all(storage.exists(self.spark, f"{self.out}/{n}") for n in names)
        made = {}
        if has("corpus"):
            made["structure"] = reports.structure(self.table("corpus"))
        if has("tokens", "nouns"):
            made["morphemes"] = reports.morphemes(self.table("tokens"), self.table("nouns"), self.metrics() if has("metrics") else None)
        if has("ngrams", "candidates"):
            made["ngrams"] = reports.ngram_report(self.table("ngrams"), self.table("candidates"))
        if has("beta", "theta"):
            title = corpus.pick(self.table("corpus").columns, corpus.TITLE_NAMES) if has("corpus") else None
            titles = self.table("corpus").select("doc_id", F.col(f"`{title}`").alias("title")) if title else None
            made["topics"] = reports.topic_report(self.table("beta"), self.table("theta"), titles)
        if has("topic_counts"):
            made["comparison"] = reports.comparison(self.table("topic_counts"))
        return {name: reports.write_report(self.spark, text, f"{self.out}/reports/{name}.md") for name, text in made.items()}

    def search_topics(self, ks: list[int] | None = None) -> stm.StmModel:
        """The topic counts ks (by the number of documents, if not given) compared, and the best one fitted again; writes topic_counts and topic_model."""
        docs, vocab = dtm.stm_input(self.table("dtm"))
        found = self._keep("topic_counts", stm.search_k(docs, vocab, ks or stm.suggest_range(docs.count()), max_em=self.config.max_em, seed=self.config.seed))
        model = stm.refit_best(docs, vocab, found, max_em=self.config.max_em, seed=self.config.seed)
        stm.save(self.spark, model, f"{self.out}/topic_model")
        return model

    def missing_outputs(self) -> list[str]:
        found = []
        for name in ("corpus", "nouns", "ngrams", "dtm", "theta"):
            try:
                self.table(name)
            except Exception:  # noqa: BLE001  whatever the file system says, the table is not there
                found.append(name)
        return found


def run_full(spark, out, raw, **kw) -> RunReport:
    return Pipeline(spark, out, **kw).run(raw)


def run_without_ngrams(spark, out, raw, **kw) -> RunReport:
    return Pipeline(spark, out, **kw).run(raw, (1, 2, 4, 5))


def run_nouns_only(spark, out, raw, **kw) -> RunReport:
    return Pipeline(spark, out, **kw).run(raw, (1, 2))


def markdown_table(df: DataFrame, title: str, most: int = 50) -> str:
    """A report section of the first rows."""
    return reports.table(df, title, most)
