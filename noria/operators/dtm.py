"""Document-term tables in long form: counts, trimming, weights and sparsity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noria.operators.nouns import each
from noria.session import ship_package
from noria.store import Store, numbered


def dfm(nouns: DataFrame, column: str = "nouns", least_length: int = 2) -> DataFrame:
    """(doc_id, term, tf), lower-cased."""
    t = each(nouns, "doc_id", of=column, name="t").where(F.length("t") >= least_length)
    return t.groupBy("doc_id", F.lower("t").alias("term")).agg(F.count("*").alias("tf"))


def tokenize(df: DataFrame, text: str = "abstract", least_length: int = 2) -> DataFrame:
    """(doc_id, nouns): words between white space, punctuation and symbols; these end a word and are in none."""
    return df.select("doc_id", F.filter(F.split(text, r"[\s\p{P}\p{S}]+"), lambda x: F.length(x) >= least_length).alias("nouns"))


#: Letters and digits with the marks that extend them; what stands between letters, and between digits, within a word.
_LETTER, _DIGIT = r"[\p{L}\p{Nl}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}]][\p{M}\p{Cf}]*+", r"\p{Nd}[\p{M}\p{Cf}]*+"
_BETWEEN_LETTERS, _BETWEEN_DIGITS, _JOINS = r"[:.'\u00B7\u2018\u2019\u2024\u2027]", r"[,;.'\u2018\u2019\u2024]", r"\p{Pc}"
_UNIT = rf"(?:{_LETTER}(?:{_BETWEEN_LETTERS}{_LETTER})++|{_DIGIT}(?:{_BETWEEN_DIGITS}{_DIGIT})++|{_LETTER}|{_DIGIT}|{_JOINS})++"
_ALONE = r"[\p{IsHan}\p{IsHiragana}][\p{M}\p{Cf}]*+|[\p{IsKatakana}\u30FC][\p{IsKatakana}\u30FC\p{M}\p{Cf}]*+"


def word_break(text: Column, split_hyphens: bool = False) -> Column:
    """The words of a text by Unicode's word boundaries (UAX 29), without punctuation and symbols.

    A full stop, colon or apostrophe between letters stays within a word, and so does a
    full stop, comma or semicolon between digits; letters, digits and connecting
    punctuation hold together; an ideograph or hiragana is a word by itself, and katakana
    hold together.  Hyphens join words unless split_hyphens.
    """
    word = _UNIT if split_hyphens else rf"{_UNIT}(?:[-\u2010\u2011]{_UNIT})*+"
    found = F.regexp_extract_all(text, F.lit(f"{_ALONE}|{word}"), F.lit(0))
    return F.filter(found, lambda x: F.regexp_like(x, F.lit(r"[\p{L}\p{N}]")))


def words(df: DataFrame, text: str = "abstract", least_length: int = 2, split_hyphens: bool = False) -> DataFrame:
    """(doc_id, nouns): the words of a text by `word_break`, of at least so many characters."""
    return df.select("doc_id", F.filter(word_break(F.col(text), split_hyphens), lambda x: F.length(x) >= least_length).alias("nouns"))


def term_stats(cells: DataFrame) -> DataFrame:
    """(term, frequency, docfreq)."""
    return cells.groupBy("term").agg(F.sum("tf").alias("frequency"), F.count("*").alias("docfreq"))


def trim(cells: DataFrame, min_termfreq: int = 2, min_docfreq: int = 1, max_docfreq: int | None = None) -> DataFrame:
    """Cells of the terms within the bounds; documents that lose all their terms stay in the corpus."""
    s = term_stats(cells).where((F.col("frequency") >= min_termfreq) & (F.col("docfreq") >= min_docfreq))
    if max_docfreq is not None:
        s = s.where(F.col("docfreq") <= max_docfreq)
    return cells.join(s.select("term"), "term", "left_semi")


def tfidf(cells: DataFrame, n_docs: int) -> DataFrame:
    """(doc_id, term, tf, weight): tf * log10(N / df)."""
    idf = cells.groupBy("term").agg(F.log10(F.lit(float(n_docs)) / F.count("*")).alias("idf"))
    return cells.join(idf, "term").select("doc_id", "term", "tf", F.round(F.col("tf") * F.col("idf"), 6).alias("weight"))


def tfidf_terms(cells: DataFrame, n_docs: int, k: int | None = 30, min_termfreq: int = 1, counted: bool = False) -> DataFrame:
    """(feature, frequency, docfreq, tfidf_score) of the terms of at least min_termfreq: column sums in closed form, one aggregate.  counted: `cells` are their term_stats."""
    s = (cells if counted else term_stats(cells)).where(F.col("frequency") >= min_termfreq)
    s = s.select(F.col("term").alias("feature"), "frequency", "docfreq", F.round(F.col("frequency") * F.log10(F.lit(float(n_docs)) / F.col("docfreq")), 6).alias("tfidf_score"))
    return s if k is None else s.orderBy(F.desc("tfidf_score"), "feature").limit(k)


def cloud_weights(terms: DataFrame) -> DataFrame:
    """(feature, cloud_weight): scores above 0, times 1000."""
    low = terms.agg(F.min("tfidf_score").alias("low"))
    shift = F.when(F.col("low") <= 0, F.abs("low") + 0.1).otherwise(F.lit(0.0))
    return terms.crossJoin(F.broadcast(low)).select("feature", F.round((F.col("tfidf_score") + shift) * 1000).cast("long").alias("cloud_weight"))  # low is one row


def sparsity(stats: DataFrame, n_docs: int) -> DataFrame:
    """(n_docs, n_terms, nonzero, total_tokens, mean_tokens, sparsity, memory_bytes) of term_stats; mean_tokens is the mean row sum."""
    s = stats.agg(F.count("*").alias("n_terms"), F.sum("docfreq").alias("nonzero"), F.sum("frequency").alias("total_tokens"))
    share = F.round(1 - F.col("nonzero") / (F.col("n_terms") * F.lit(n_docs)), 9)
    mean = F.round(F.col("total_tokens") / F.lit(n_docs), 6)
    return s.select(F.lit(n_docs).cast("long").alias("n_docs"), "n_terms", "nonzero", "total_tokens", mean.alias("mean_tokens"), share.alias("sparsity"), (F.col("nonzero") * 8).alias("memory_bytes"))


def stm_input(cells: DataFrame, kept: bool = False) -> tuple[DataFrame, DataFrame]:
    """documents (doc_id, terms array<struct<term_id, tf>>) and vocabulary (term_id, term), ids in term order from 1, numbered without a collect.

    kept: the cells are a written table already.
    """
    store = Store(cells.sparkSession)
    cells = cells if kept else store.keep(cells, "cells")
    return listed(cells, vocabulary(cells.select("term").distinct(), store))


def vocabulary(terms: DataFrame, store: Store) -> DataFrame:
    """(term_id, term) of different terms."""
    return store.keep(numbered(terms, ["term"], store, "term_id").select(F.col("term_id").cast("int").alias("term_id"), "term"), "vocabulary")


def listed(cells: DataFrame, vocab: DataFrame) -> tuple[DataFrame, DataFrame]:
    """documents (doc_id, terms) of the cells whose terms the vocabulary has, and the vocabulary; one join, which trims as well."""
    docs = cells.join(vocab, "term").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("term_id", "tf"))).alias("terms"))
    return docs, vocab


def met(coded: DataFrame, values: DataFrame, run, schema: str) -> DataFrame:
    """What `run` makes of each chunk of `RuleTagger.coded`: of its documents (doc_id, codes) and the values (by term) of those of its terms that have some.

    A term is joined once a chunk and the documents are moved as lists of numbers, so
    cells are not shuffled with their terms.  A chunk is a batch of documents, so a group is bounded.
    """
    ship_package(coded.sparkSession)
    docs = coded.where(F.col("codes").isNotNull()).select("chunk", "doc_id", "codes")
    hits = coded.where(F.col("term").isNotNull()).select(F.col("chunk").alias("of"), "code", "term").join(values, "term").drop("term")
    return docs.groupBy("chunk").cogroup(hits.groupBy("of")).applyInArrow(run, schema)


def _cells_of(docs: pa.Table, hits: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document and row of `hits` of each cell that has one."""
    lists = docs["codes"].combine_chunks()
    code = np.asarray(lists.flatten())
    doc = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
    known = np.asarray(hits["code"])
    row = np.full(max(code.max(initial=-1), known.max(initial=-1)) + 1, -1)
    row[known] = np.arange(len(known))
    at = row[code]
    return doc[at >= 0], at[at >= 0]


def sums(coded: DataFrame, values: DataFrame) -> DataFrame:
    """(doc_id, *values): the values of a document's terms added up, null as 0; documents without a term that has values are left out."""
    names = [c for c in values.columns if c != "term"]

    def run(docs, hits):
        doc, at = _cells_of(docs, hits)
        there = np.unique(doc)
        added = [np.bincount(doc, np.asarray(pc.fill_null(hits[c], 0.0))[at], docs.num_rows)[there] for c in names]
        return pa.table([docs["doc_id"].take(pa.array(there)), *map(pa.array, added)], names=["doc_id", *names])

    kind = coded.schema["doc_id"].dataType.simpleString()
    return met(coded, values, run, ", ".join([f"doc_id {kind}", *[f"`{c}` double" for c in names]]))


def listed_codes(coded: DataFrame, vocab: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`listed` of coded documents; a term counts once a document."""

    def run(docs, hits):
        doc, at = _cells_of(docs, hits)
        ids = np.asarray(hits["term_id"])[at]
        order = np.lexsort((ids, doc))
        there, first = np.unique(doc, return_index=True)
        pairs = pa.StructArray.from_arrays([pa.array(ids[order].astype(np.int32)), pa.array(np.ones(len(ids), np.int64))], ["term_id", "tf"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(ids)).astype(np.int32)), pairs)
        return pa.table([docs["doc_id"].take(pa.array(there)), lists], names=["doc_id", "terms"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    return met(coded, vocab, run, f"doc_id {kind}, terms array<struct<term_id:int,tf:bigint>>"), vocab
