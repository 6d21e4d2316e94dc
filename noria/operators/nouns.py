"""Tagging, affix-aware noun extraction and affix statistics."""

from __future__ import annotations

import hashlib
import re
import tempfile
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noria.functions.text import bound
from noria.session import ship_package

TOKENS = "array<struct<form:string,tag:string>>"
NOUN = ("NNG", "NNP")
#: Rows of counts that a task holds before it hands them on.
COUNTED = 1 << 20


class Tagger(Protocol):
    def tag(self, df: DataFrame) -> DataFrame:
        """(doc_id, abstract) -> (doc_id, tokens)."""


class RuleTagger:
    """A deterministic tagger of Catalyst expressions, for tests and for languages without a model."""

    def __init__(self, prefixes: list[str], suffixes: list[str], function_words: list[str]):
        self.prefixes, self.suffixes, self.function_words = prefixes, suffixes, function_words

    def tag(self, df: DataFrame) -> DataFrame:
        words = F.filter(F.split(F.lower("abstract"), r"[^\p{L}\p{N}]+"), lambda x: x != "")
        kind = lambda x: F.when(x.isin(self.prefixes), "XPN").when(x.isin(self.suffixes), "XSN").when(F.length(x) <= 2, "JKS").when(x.isin(self.function_words), "MM").otherwise("NNG")
        return df.select("doc_id", F.transform(words, lambda x: F.struct(x.alias("form"), kind(x).alias("tag"))).alias("tokens"))

    def nouns(self, df: DataFrame, *keep: str) -> DataFrame:
        """(doc_id, nouns, *keep): what `extract_nouns` makes of the tags, whole batches at a time."""
        kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in ("doc_id", *keep)]

        def run(batches):
            for batch in batches:
                lists = batch.column(1)
                doc, forms, place = self._found(lists)
                offsets = np.searchsorted(doc, np.arange(len(lists) + 1)).astype(np.int32)
                out = pa.ListArray.from_arrays(pa.array(offsets), forms.take(pa.array(place)))
                yield pa.RecordBatch.from_arrays([batch.column(0), out, *batch.columns[2:]], ["doc_id", "nouns", *keep])

        return self._split(df, keep).mapInArrow(run, ", ".join([kinds[0], "nouns array<string>", *kinds[1:]]))

    def cells(self, df: DataFrame, *keep: str, least_length: int = 2) -> DataFrame:
        """(doc_id, term, tf, *keep): `dtm.dfm` of the nouns, for ids that are unique.  Nothing is shuffled; a noun counts once a document."""
        kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in ("doc_id", *keep)]

        def run(batches):
            for batch in batches:
                doc, forms, place = self._nouns(batch.column(1), least_length)
                doc, place = pa.array(doc), pa.array(place)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(doc), forms.take(place), pa.array(np.ones(len(doc), np.int64)), *[c.take(doc) for c in batch.columns[2:]]], ["doc_id", "term", "tf", *keep])

        return self._split(df, keep).mapInArrow(run, ", ".join([kinds[0], "term string, tf long", *kinds[1:]]))

    def counts(self, df: DataFrame, *keep: str, least_length: int = 2) -> DataFrame:
        """(term, *keep, n): how many rows of df hold a noun, by the columns `keep`.  Summed within a task as far as COUNTED rows; a term has several rows, to be summed."""
        kinds = ["term string", *[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep], "n long"]

        return self._split(df, keep).mapInArrow(counting(self, keep, least_length), ", ".join(kinds))

    def coded(self, df: DataFrame, *keep: str, least_length: int = 2) -> DataFrame:
        """(chunk, doc_id, codes, code, term, *keep, n): the cells of ids that are unique, by chunks of documents that have numbers of their own for their terms.

        A document is a row (chunk, doc_id, codes: its terms' numbers); a term of a chunk
        is a row (chunk, code, term, *keep, n: how many of the chunk's documents hold it) for
        each value of `keep`.  So a chunk's terms meet a table of terms once, whatever the number
        of cells (`dtm.met`).
        """
        doc_kind, *kinds = [df.schema[c].dataType.simpleString() for c in ("doc_id", *keep)]

        def run(batches):
            chunk = TaskContext.get().partitionId() << 33
            for batch in batches:
                lists = batch.column(1)
                doc, forms, place = self._nouns(lists, least_length)
                used, code = np.unique(place, return_inverse=True)
                offsets = np.searchsorted(doc, np.arange(len(lists) + 1)).astype(np.int32)
                codes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(code.astype(np.int32)))
                documents = pa.table({"chunk": pa.array(np.full(len(lists), chunk)), "doc_id": batch.column(0), "codes": codes})
                found = _summed(doc, pa.array(np.arange(len(used), dtype=np.int32)), code, batch.columns[2:], keep)
                numbers = found["term"].combine_chunks()
                terms = pa.table({"chunk": pa.array(np.full(len(found), chunk)), "code": numbers, "term": forms.take(pa.array(used)).take(numbers)} | {c: found[c] for c in (*keep, "n")})
                both = pa.concat_tables([documents, terms], promote_options="default")
                yield from both.select(["chunk", "doc_id", "codes", "code", "term", *keep, "n"]).combine_chunks().to_batches(max_chunksize=1 << 16)
                chunk += 1

        fields = ["chunk long", f"doc_id {doc_kind}", "codes array<int>", "code int", "term string", *[f"`{c}` {k}" for c, k in zip(keep, kinds, strict=True)], "n long"]
        return self._split(df, keep).mapInArrow(run, ", ".join(fields))

    def _nouns(self, lists: pa.ListArray, least_length: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """What `_found` gives, of nouns of at least so many characters."""
        doc, forms, place = self._found(lists)
        long = np.asarray(pc.greater_equal(pc.utf8_length(forms), least_length).to_numpy(zero_copy_only=False), dtype=bool)[place]
        return doc[long], forms, place[long]

    @staticmethod
    def _split(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        ship_package(df.sparkSession)
        return df.select("doc_id", F.split(F.lower("abstract"), r"[^\p{L}\p{N}]+").alias("words"), *keep)

    def _found(self, lists: pa.ListArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Rows, all different forms, and each row's nouns as places among these: in first-occurrence order, each once."""
        flat = lists.flatten()
        doc = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
        coded = flat.dictionary_encode()
        words, code = coded.dictionary, np.asarray(coded.indices)
        known = dict.fromkeys(self.function_words, 0) | dict.fromkeys(self.suffixes, 3) | dict.fromkeys(self.prefixes, 2)
        # 0: other, 1: noun, 2: prefix, 3: suffix
        size = np.asarray(pc.utf8_length(words))
        at = np.asarray(pc.fill_null(pc.index_in(words, pa.array(list(known), words.type)), -1))
        kind = np.where(at >= 0, np.array([*known.values(), 0], np.int8)[at], size > 2).astype(np.int8)
        kind = np.where(size == 0, np.int8(-1), kind)[code]
        there = kind >= 0
        doc, code, kind = doc[there], code[there], kind[there]
        n = len(code)
        same = np.append(doc[1:] == doc[:-1], False) if n else np.zeros(0, bool)
        after = np.where(same, np.append(kind[1:], 0), 0) if n else kind
        before = np.where(np.append(False, same[:-1]), np.append(0, kind[:-1]), 0) if n else kind
        after2 = np.where(same, np.append(after[1:], 0), 0) if n else kind
        place, out = code.astype(np.int64), np.zeros(n, bool)
        own = (kind == 1) & (before != 2)
        alone = (kind == 3) & (before != 1)
        out[own | alone | (kind == 2)] = True
        length = np.where(own & (after == 3), 2, np.where((kind == 2) & (after == 1), np.where(after2 == 3, 3, 2), 1))
        i = np.flatnonzero(out & (length > 1))
        third = np.append(code, [0, 0])[i + 2]
        parts = words.take(pa.array(code[i])), words.take(pa.array(code[i + 1])), words.take(pa.array(third, mask=length[i] < 3))
        made = pc.binary_join_element_wise(*parts, pa.scalar("", words.type), null_handling="replace")
        place[i] = len(words) + np.arange(len(i))
        doc, place = doc[out], place[out]
        # a joined form can be a word as well
        every = pa.concat_arrays([words, made]).dictionary_encode()
        place = np.asarray(every.indices).astype(np.int64)[place] if len(place) else place
        _, first = np.unique(doc * (len(every.dictionary) + 1) + place, return_index=True)
        first.sort()
        return doc[first], every.dictionary, place[first]


def _summed(doc: np.ndarray, forms: pa.Array, place: np.ndarray, columns: list[pa.Array], names: tuple[str, ...]) -> pa.Table:
    """(term, *names, n): the cells (doc, place) counted by form and by the values that `columns` have for their document."""
    key, coded = place, [c.dictionary_encode(null_encoding="encode") for c in columns]
    for c in coded:
        key = key * max(len(c.dictionary), 1) + np.asarray(c.indices)[doc]
    key, n = np.unique(key, return_counts=True)
    values = []
    for c in reversed(coded):
        key, at = np.divmod(key, max(len(c.dictionary), 1))
        values.append(c.dictionary.take(pa.array(at)))
    return pa.table([forms.take(pa.array(key)), *reversed(values), pa.array(n.astype(np.int64))], names=["term", *names, "n"])


def counting(tagger: RuleTagger, keep: tuple[str, ...], least_length: int):
    """What a task of `RuleTagger.counts` does."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            doc, forms, place = tagger._nouns(batch.column(1), least_length)
            held.append(_summed(doc, forms, place, batch.columns[2:], keep))
            size += len(held[-1])
            if size > COUNTED:
                held = [pa.concat_tables(held).group_by(["term", *keep], use_threads=False).aggregate([("n", "sum")]).rename_columns(["term", *keep, "n"])]
                size = len(held[0])
                if size > COUNTED // 2:
                    yield from held.pop().combine_chunks().to_batches(max_chunksize=1 << 16)
                    size = 0
        for found in held:
            yield from found.combine_chunks().to_batches(max_chunksize=1 << 16)

    return run


class PretaggedTagger:
    """Reads `form/TAG form/TAG` strings from the abstract column."""

    def tag(self, df: DataFrame) -> DataFrame:
        parts = F.filter(F.split("abstract", r"\s+"), lambda x: x != "")
        token = lambda x: F.struct(F.regexp_extract(x, "^(.*)/([^/]*)$", 1).alias("form"), F.regexp_extract(x, "^(.*)/([^/]*)$", 2).alias("tag"))
        return df.select("doc_id", F.transform(parts, token).alias("tokens"))


class PythonTagger:
    """Any `make() -> (text -> [(form, tag)])`, made once in each Python worker; a text that fails has no tokens.

    times: an accumulator of `plans.metrics`, which gets each partition's documents,
    failures and seconds.
    """

    def __init__(self, make: Callable[[], Callable[[str], list[tuple[str, str]]]], times=None):
        self.make, self.times = make, times

    def tag(self, df: DataFrame) -> DataFrame:
        make, times = self.make, self.times
        kind = df.schema["doc_id"].dataType.simpleString()

        def run(batches: Iterator):
            tokenize, docs, failures, began = make(), 0, 0, time.perf_counter()
            for pdf in batches:
                out = []
                for text in pdf["abstract"]:
                    docs += 1
                    try:
                        out.append([{"form": a, "tag": b} for a, b in tokenize(text or "")])
                    except Exception:  # noqa: BLE001  one bad text must not end the job
                        failures += 1
                        out.append([])
                pdf["tokens"] = out
                yield pdf[["doc_id", "tokens"]]
            if times is not None:
                times.add({TaskContext.get().partitionId(): (docs, failures, time.perf_counter() - began)})

        return df.select("doc_id", "abstract").mapInPandas(run, f"doc_id {kind}, tokens {TOKENS}")


class DictionaryTagger(PythonTagger):
    """A tagger with a user dictionary: `make(path) -> (text -> [(form, tag)])`, the path being the dictionary's copy on the worker.

    The file, on any file system, is shipped once under a name made from its content, so
    a new version never meets an old copy.
    """

    def __init__(self, spark: SparkSession, make: Callable[[str | None], Callable[[str], list[tuple[str, str]]]], dictionary: str | None = None, times=None):
        name = _shipped(spark, dictionary) if dictionary else None

        def start():
            return make(SparkFiles.get(name) if name else None)

        super().__init__(start, times)


def _shipped(spark: SparkSession, path: str) -> str:
    content = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    name = f"dictionary-{hashlib.sha256(content).hexdigest()}.tsv"
    local = Path(tempfile.mkdtemp(prefix="noria-")) / name
    local.write_bytes(content)
    spark.sparkContext.addFile(str(local))
    return name


def longest_match(path: str | None) -> Callable[[str], list[tuple[str, str]]]:
    """A tokenizer for `DictionaryTagger`: the longest dictionary words, and between them runs of letters and digits as NNG."""
    words: dict[str, str] = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines() if path else []:
        parts = line.split("\t")
        if len(parts) >= 2 and parts[0] and not line.startswith("#"):
            words.setdefault(parts[0], parts[1])
    either = "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    found = re.compile(rf"({either})|[^\W_]+?(?={either}|[\W_]|$)" if words else r"()[^\W_]+")
    return lambda text: [(m[0], words[m[1]] if m[1] else "NNG") for m in found.finditer(text)]


def kiwi_tagger(spark: SparkSession, model_path: str | None = None, dictionary: str | None = None, model_type: str | None = None, times=None) -> DictionaryTagger:
    """The Kiwi analyser, where it is installed on the executors."""

    def make(path):
        from kiwipiepy import Kiwi

        kiwi = Kiwi(**{k: v for k, v in (("model_path", model_path), ("model_type", model_type)) if v})
        kiwi.space_tolerance = 2
        if path:
            kiwi.load_user_dictionary(path)
        return lambda text: [(t.form, t.tag) for t in kiwi.tokenize(text)]

    return DictionaryTagger(spark, make, dictionary, times)


def morphemes(tagged: DataFrame) -> DataFrame:
    """+ morphemes: `form/TAG form/TAG`."""
    return tagged.withColumn("morphemes", F.array_join(F.transform("tokens", lambda t: F.concat(t["form"], F.lit("/"), t["tag"])), " "))


def extract_nouns(tagged: DataFrame, keep_repeats: bool = False) -> DataFrame:
    """(doc_id, nouns): prefix + noun + suffix, prefix + noun, noun + suffix, or one of them alone; in first-occurrence order.

    A token decides by its neighbours' tags: a noun behind a prefix belongs to it, a
    suffix behind a noun to that, and what is left of prefixes, nouns and suffixes
    stands alone.  One pass over the tokens.
    """
    is_ = lambda t, *tags: F.coalesce(t["tag"].isin(*tags), F.lit(False))

    def found(tokens):
        at = lambda i: F.get(tokens, i)
        before = lambda i, *tags: F.when(i > 0, is_(at(i - 1), *tags)).otherwise(F.lit(False))
        suffix = lambda i: F.when(is_(at(i), "XSN"), at(i)["form"]).otherwise(F.lit(""))

        def noun(t, i):
            prefix = F.when(is_(at(i + 1), *NOUN), F.concat(t["form"], at(i + 1)["form"], suffix(i + 2))).otherwise(t["form"])
            own = F.when(~before(i, "XPN"), F.concat(t["form"], suffix(i + 1)))
            alone = F.when(~before(i, *NOUN), t["form"])
            return F.when(t["tag"] == "XPN", prefix).when(t["tag"].isin(*NOUN), own).when(t["tag"] == "XSN", alone)

        nouns = F.filter(F.transform(tokens, noun), lambda x: x.isNotNull())
        return nouns if keep_repeats else F.array_distinct(nouns)

    return tagged.select("doc_id", bound("tokens", found).alias("nouns"))


def each(df: DataFrame, *columns: str, of: str = "nouns", name: str = "noun") -> DataFrame:
    """A row for each value of an array.  An outer explode, which puts no second copy of the array's expression into a filter below."""
    return df.select(*columns, F.explode_outer(of).alias(name)).where(F.col(name).isNotNull())


def noun_document_frequency(nouns: DataFrame, k: int = 20) -> DataFrame:
    """(noun, n_docs): the k nouns of most documents."""
    return each(nouns).groupBy("noun").agg(F.count("*").alias("n_docs")).orderBy(F.desc("n_docs"), "noun").limit(k)


def noun_totals(nouns: DataFrame) -> DataFrame:
    """(n_docs, n_nouns, n_distinct, mean_nouns), counted from one pass: null stands for a document in the groups of nouns."""
    marked = nouns.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), "nouns")).alias("noun"))
    n = marked.groupBy("noun").agg(F.count("*").alias("n"))
    docs, all_ = F.sum(F.when(F.col("noun").isNull(), F.col("n"))), F.sum(F.when(F.col("noun").isNotNull(), F.col("n")))
    return n.agg(F.coalesce(docs, F.lit(0)).alias("n_docs"), all_.alias("n_nouns"), F.round(all_ / docs, 6).alias("mean_nouns"), F.count("noun").alias("n_distinct"))


def tag_counts(tagged: DataFrame, tag: str) -> DataFrame:
    """(form, n) of all forms of a tag."""
    forms = tagged.select(F.explode_outer(F.transform(F.filter("tokens", lambda t: t["tag"] == tag), lambda t: t["form"])).alias("form")).where("form is not null")
    return forms.groupBy("form").agg(F.count("*").alias("n"))


def tag_frequency(tagged: DataFrame, tag: str, k: int = 15) -> DataFrame:
    """(form, n) of the k most frequent forms of a tag."""
    return tag_counts(tagged, tag).orderBy(F.desc("n"), "form").limit(k)


def tag_totals(tagged: DataFrame, tags: list[str]) -> DataFrame:
    """(tag, kinds, total): how many different forms a tag has, and how many in all."""
    both = tagged.select(F.explode_outer(F.filter("tokens", lambda t: t["tag"].isin(*tags))).alias("t")).where("t is not null")
    return both.groupBy("t.tag", "t.form").agg(F.count("*").alias("n")).groupBy("tag").agg(F.count("*").alias("kinds"), F.sum("n").alias("total"))


def tag_runs(tagged: DataFrame, first: list[str], second: list[str], third: list[str] | None = None, not_third: list[str] | None = None, k: int = 20) -> DataFrame:
    """(forms, n): adjacent forms with these tags, joined by +; not_third: tags that must not follow.  Neighbours are read in the array, so only counts are shuffled."""

    def found(tokens):
        at = lambda i: F.get(tokens, i)

        def run(t, i):
            hit = t["tag"].isin(*first) & at(i + 1)["tag"].isin(*second)
            parts = [t["form"], at(i + 1)["form"]]
            if third:
                hit, parts = hit & at(i + 2)["tag"].isin(*third), [*parts, at(i + 2)["form"]]
            if not_third:
                hit = hit & ~F.coalesce(at(i + 2)["tag"].isin(*not_third), F.lit(False))
            return F.when(hit, F.concat_ws("+", *parts))

        return F.filter(F.transform(tokens, run), lambda x: x.isNotNull())

    runs = tagged.select(bound("tokens", found).alias("runs"))
    return each(runs, of="runs", name="forms").groupBy("forms").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "forms").limit(k)
