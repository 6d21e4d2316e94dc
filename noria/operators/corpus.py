"""Corpus standardisation, profiling and validation."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noria.functions.text import first_year, hangul_ratio, hash_id, trim_blanks
from noria.store import Store, numbered

# The headers of the exports that are read, in order of priority.  Replace them for other exports.
ID_NAMES = ["doc_id", "논문 ID", "논문ID", "Article ID", "article_id", "ID", "id", "일련번호", "번호"]
TITLE_NAMES = ["제목", "논문제목", "제목명", "title", "Title"]
AUTHOR_NAMES = ["저자", "저자명", "author", "Author", "작성자"]
INSTITUTION_NAMES = ["발행기관", "소속기관", "기관명", "institution", "Institution", "발행처"]
ABSTRACT_NAMES = ["국문 초록 (Abstract)", "국문초록", "국문 초록", "초록", "영문초록", "영문 초록", "Abstract", "abstract", "다국어초록", "다국어 초록", "요약", "Summary"]
YEAR_NAMES = ["pub_year", "발행연도", "발행년도", "연도", "년도", "Year", "year", "출판연도", "출판년도", "Publication Year"]
# Parts of headers that are looked for, in any case, where none of the names above is there.
ID_PARTS = ["ID", "논문 ID", "일련", "번호", "article"]
ABSTRACT_PARTS, OTHER_LANGUAGE_PARTS = ["초록", "요약", "summary"], ["multilingual", "다국어", "영문", "english"]
# Metadata that goes with the topic table.
TOPIC_METADATA = ["논문명", "저자명", "pub_year", "KCI 등재 구분", "주제분야"]


def pick(columns: list[str], names: list[str]) -> str | None:
    return next((n for n in names if n in columns), None)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a missing column is null, and a column whose types differ becomes a string."""
    kinds: dict[str, set[str]] = {}
    for f in frames:
        for c, k in f.dtypes:
            kinds.setdefault(c, set()).add(k)
    mixed = {c for c, k in kinds.items() if len(k) > 1}
    same = [f.withColumns({c: F.col(c).cast("string") for c in f.columns if c in mixed}) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same)


def generate_hash_ids(df: DataFrame, order: list[str], out: str = "doc_id") -> DataFrame:
    """Hash ids of title, author and institution; later rows of an id, in the given order, get _NNN; rows without any get row_N.

    Rows are numbered by ranges of (hash, order), and a hash's first number is taken off,
    so neither a hash that many rows share nor the rows without one meet in one task.
    """
    parts = [F.col(c).cast("string") for names in (TITLE_NAMES, AUTHOR_NAMES, INSTITUTION_NAMES) if (c := pick(df.columns, names))]
    made = hash_id(*parts) if parts else F.lit(None).cast("string")
    key, store = "__hash", Store(df.sparkSession)
    rows = numbered(df.withColumn(key, F.coalesce(made, F.lit(""))), [key, *[c for c in order if c != out]], store, "__n")
    first = rows.groupBy(key).agg(F.min("__n").alias("__first"))
    n = F.col("__n") - F.col("__first")
    doc_id = F.when(F.col(key) == "", F.concat(F.lit("row_"), (n + 1).cast("string"))).when(n > 0, F.concat(key, F.format_string("_%03d", n))).otherwise(F.col(key))
    return rows.join(first, key).select(doc_id.alias(out), *[c for c in df.columns if c != out])


def standardize_ids(df: DataFrame, order: list[str] | None = None, only_duplicates: bool = False) -> DataFrame:
    """A unique string doc_id in front.  Given ids with any duplicate are all made anew, or only the duplicates.

    only_duplicates: the first row of an id keeps it, the others get a suffix of
    underscores and a number, one underscore more than any given id ends with before
    digits, so that no new id can be a given one.  Rows without an id count as rows of
    the id "row", and all get a suffix.
    """
    found = pick(df.columns, ID_NAMES)
    order = order or [c for c in df.columns if c != found]
    if found is None:
        return generate_hash_ids(df, order)
    out = df.withColumnRenamed(found, "doc_id").withColumn("doc_id", F.col("doc_id").cast("string"))
    if only_duplicates:
        run = F.length(F.regexp_extract("doc_id", "(_+)[0-9]+$", 1))
        most = out.agg(F.coalesce(F.max(run), F.lit(0))).first()[0]
        given = F.coalesce("doc_id", F.lit("row"))
        # numbered by ranges of (id, order), less each id's first number, so rows without an id don't meet in one task
        key, store = "__given", Store(df.sparkSession)
        marked = out.withColumn(key, F.coalesce(F.concat(F.lit("="), "doc_id"), F.lit("")))
        rows = numbered(marked, [key, *[c for c in order if c != "doc_id"]], store, "__n")
        first = rows.groupBy(key).agg(F.min("__n").alias("__first"))
        n = F.col("__n") - F.col("__first") + F.when(F.col("doc_id").isNull(), 1).otherwise(0)
        suffixed = F.concat(given, F.lit("_" * (most + 1)), F.format_string("%03d", F.col("__n")))
        out = rows.join(first, key).withColumn("__n", n).withColumn("doc_id", F.when(F.col("__n") > 0, suffixed).otherwise(given)).drop("__n", "__first", key)
    elif not out.groupBy("doc_id").count().where("count > 1").limit(1).isEmpty():
        return generate_hash_ids(out, order)
    return out.select("doc_id", *[c for c in out.columns if c != "doc_id"])


def resolve_columns(df: DataFrame) -> tuple[str, str | None]:
    """(id column, text column) of a table that was not standardised: by parts of the header, else the first column and the first text column."""
    strings = [c for c, k in df.dtypes if k == "string"]
    holds = lambda c, parts: any(p.lower() in c.lower() for p in parts)
    id_col = next((c for p in ID_PARTS for c in df.columns if holds(c, [p])), df.columns[0])
    texts = ["abstract"] if "abstract" in strings else [c for p in ABSTRACT_PARTS for c in strings if holds(c, [p]) and not holds(c, OTHER_LANGUAGE_PARTS)]
    return id_col, next(iter(texts), next((c for c in strings if c != "source_file"), None))


def script_scores(df: DataFrame, columns: list[str], bonus: dict[str, int] | None = None) -> DataFrame:
    """(column, hangul, mean_length, score): over all texts of more than 10 characters, in one aggregate."""
    bonus = bonus or {}
    aggs = []
    for c in columns:
        long = F.length(c) > 10
        aggs += [F.avg(F.when(long, hangul_ratio(c))).alias(f"h_{c}"), F.avg(F.when(long, F.length(c))).alias(f"l_{c}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"h_{c}"), F.lit(0.0)).alias("hangul"), F.coalesce(F.col(f"l_{c}"), F.lit(0.0)).alias("mean_length"), F.lit(float(bonus.get(c, 0))).alias("bonus")) for c in columns]))
    score = 0.7 * F.col("hangul") + 0.2 * F.col("bonus") + 0.1 * F.least(F.col("mean_length") / 200, F.lit(1.0))
    return one.select(rows.alias("r")).select("r.*").select("column", "hangul", "mean_length", score.alias("score"))


def is_korean_text(df: DataFrame, column: str) -> bool:
    return script_scores(df, [column]).first()["hangul"] >= 0.3


def standardize_text(df: DataFrame) -> DataFrame:
    """The best abstract column, renamed to abstract."""
    strings = [c for c, k in df.dtypes if k == "string"]
    named = [c for c in strings if c in ABSTRACT_NAMES]
    scored = {r["column"]: r for r in script_scores(df, strings, {c: 3 - min(3, i) for i, c in enumerate(ABSTRACT_NAMES) if c in named}).collect()} if strings else {}
    good = [c for c in named if scored[c]["hangul"] >= 0.3 and scored[c]["mean_length"] >= 50]
    best = max(good, key=lambda c: scored[c]["score"], default=None) or pick(df.columns, ABSTRACT_NAMES)
    best = best or max((c for c in strings if scored[c]["mean_length"] > 50), key=lambda c: scored[c]["mean_length"], default=None)
    if best in (None, "abstract"):
        return df
    return (df.withColumnRenamed("abstract", "abstract_orig") if "abstract" in df.columns else df).withColumnRenamed(best, "abstract")


def standardize_year(df: DataFrame) -> DataFrame:
    found = pick(df.columns, YEAR_NAMES)
    return df if found is None else df.withColumnRenamed(found, "pub_year").withColumn("pub_year", first_year(F.col("pub_year").cast("string")))


def standardize(df: DataFrame) -> DataFrame:
    """Ids, abstract and year; doc_id first, all other columns as they are."""
    out = df.transform(standardize_ids).transform(standardize_text).transform(standardize_year)
    return out.select("doc_id", *[c for c in out.columns if c != "doc_id"])


def analysis_projection(df: DataFrame, id_col: str = "doc_id", text_col: str = "abstract", *keep: str) -> DataFrame:
    """(doc_id, abstract, *keep): trimmed texts of more than 10 characters."""
    return df.select(F.col(id_col).cast("string").alias("doc_id"), trim_blanks(text_col).alias("abstract"), *keep).where(F.length("abstract") > 10)


def column_profile(df: DataFrame) -> DataFrame:
    """(column, type, n_null, null_pct, n_distinct) in one aggregate; null counts as a value.

    Values are counted as 128-bit hashes, so texts are not multiplied by the distinct counts.
    """
    floats = {"float", "double"}
    value = lambda c, k: F.col(c) + F.lit(0.0) if k in floats else F.col(c)  # noqa: E731  -0.0 is 0.0
    hashed = [F.when(F.col(c).isNotNull(), F.struct(F.xxhash64(value(c, k)), F.xxhash64(F.lit(1), value(c, k)))).alias(f"h{i}") for i, (c, k) in enumerate(df.dtypes)]
    aggs = [x for i in range(len(df.columns)) for x in (F.count_if(F.col(f"h{i}").isNull()).alias(f"n{i}"), (F.count_distinct(F.col(f"h{i}")) + F.coalesce(F.max(F.col(f"h{i}").isNull().cast("int")), F.lit(0))).alias(f"d{i}"))]
    one = df.select(*hashed).agg(F.count("*").alias("__rows"), *aggs)
    pct = lambda i: F.round(100.0 * F.col(f"n{i}") / F.col("__rows"), 2)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("type"), F.col(f"n{i}").alias("n_null"), pct(i).alias("null_pct"), F.col(f"d{i}").cast("long").alias("n_distinct")) for i, (c, k) in enumerate(df.dtypes)])
    return one.select(F.inline(rows))


def covariates(df: DataFrame, least: int = 2, most: int = 50, most_share: float = 0.2) -> DataFrame:
    """(column, n_distinct, share, is_categorical) of the text columns."""
    strings = [c for c, k in df.dtypes if k == "string"]
    prof = column_profile(df.select(*strings)).select("column", "n_distinct")
    share = F.round(F.col("n_distinct") / F.lit(df.count()), 6)
    return prof.withColumn("share", share).withColumn("is_categorical", F.col("n_distinct").between(least, most) & (F.col("share") <= most_share))


def clean_names(names: list[str]) -> list[str]:
    """Names of letters, digits and _, each once."""
    out: list[str] = []
    for n in names:
        made = re.sub(r"_+", "_", re.sub(r"[^\w]", "_", n)).strip("_") or "v"
        made = made if not made[0].isdigit() else f"v_{made}"
        i, base = 1, made
        while made in out:
            made, i = f"{base}_{i}", i + 1
        out.append(made)
    return out


def text_samples(df: DataFrame, most: int = 20) -> DataFrame:
    """(column, sample): the first non-null value of each text column in the order of the files, cut."""
    strings = [c for c, k in df.dtypes if k == "string"]
    place = F.monotonically_increasing_id()
    one = df.withColumn("__place", place).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__place"))).alias(c) for c in strings])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.substring(c, 1, most).alias("sample")) for c in strings])))


def duplicate_ids(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1")


def missing_columns(df: DataFrame, needed: list[str]) -> list[str]:
    return [c for c in needed if c not in df.columns]


def validate(df: DataFrame, kind: str = "basic") -> DataFrame:
    """(check, passed): basic, morpheme (needs abstract) or metadata (needs pub_year)."""
    needed = {"basic": ["doc_id"], "morpheme": ["doc_id", "abstract"], "metadata": ["doc_id", "pub_year"]}[kind]
    lacks = missing_columns(df, needed)
    has_id = "doc_id" in df.columns
    distinct = F.count_distinct("doc_id") if has_id else F.lit(-1)
    one = df.agg(F.count("*").alias("n"), distinct.alias("d"), (F.count("doc_id") if has_id else F.lit(-2)).alias("k"))
    checks = [("has_rows", F.col("n") > 0), ("has_columns", F.lit(bool(df.columns))), ("has_doc_id", F.lit(has_id)), ("unique_ids", (F.col("d") == F.col("n")) & (F.col("k") == F.col("n"))), ("required_columns", F.lit(not lacks))]
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check"), v.alias("passed")) for k, v in checks])))


def left_join_metadata(left: DataFrame, right: DataFrame, key: str = "doc_id") -> DataFrame:
    """All of left; clashing columns of right get _orig."""
    clash = {c: f"{c}_orig" for c in right.columns if c in left.columns and c != key}
    return left.join(right.withColumnsRenamed(clash), key, "left")


def metadata_columns(df: DataFrame, text_columns: list[str]) -> DataFrame:
    """Everything but the text columns."""
    return df.drop(*text_columns)


def topic_metadata(df: DataFrame, names: list[str] = TOPIC_METADATA) -> DataFrame:
    """doc_id and those of the named columns that are there, for the topic table."""
    return df.select("doc_id", *[c for c in names if c in df.columns])


EMPTY_NOUNS = T.StructType([T.StructField("noun", T.StringType()), T.StructField("pos_tag", T.StringType())])
