"""Boilerplate lines by their frequency within a site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noria.llm.common import Scratch, own

#: A line is boilerplate if its share of a site's pages is over this, the site counted with SMOOTH more pages that lack it.
#: So the pages it takes grow with the site: 5 of 50 pages, 7 of 500, 470 of 93,000, and no line of 4 pages ever is.
MAX_RATIO, SMOOTH = 0.005, 800
#: Boilerplate hashes that may be broadcast; 8 bytes each.  Beyond it the join is salted.
BROADCAST_HASHES = 1_000_000
SALTS = 64


def url_host(url: Column | str) -> Column:
    """Host of a URL in lower case, without user and port."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def drop_boilerplate_lines(docs: DataFrame, host: Column | str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO, smooth: int = SMOOTH) -> DataFrame:
    """`docs` with its columns, text_col without its site's boilerplate lines, and n_dropped_lines.

    Lines end with \\n and are compared without the spaces around them; blank lines
    are never dropped.  Per host, the pages that contain a line are divided by the
    pages of the host and `smooth` more; a line above max_ratio is dropped wherever it
    stands on that host.

    A line's count is a partial aggregate of (host, 64-bit hash), so neither a large
    host nor a common line gathers in a task.  A host has at most (distinct lines a
    page) / max_ratio boilerplate lines; they are one array per host, broadcast up to
    BROADCAST_HASHES hashes in all and joined by salted host beyond that.  Texts are
    neither shuffled nor rebuilt from rows.

    Nulls: null hosts are one host; a null text stays null and counts as a page
    without lines.  A text of which nothing is left is "".  Repeated rows are pages
    of their own.  A column named n_dropped_lines is replaced.
    """
    spark = docs.sparkSession
    n = own(docs.columns, "host", "bad", "salt")
    docs = docs.drop("n_dropped_lines")
    host = F.col(host) if isinstance(host, str) else host
    paged = docs.withColumn(n["host"], F.coalesce(host.cast("string"), F.lit("\0")))
    hashes = F.transform(F.split(F.col(text_col), "\n", -1), lambda x: F.when(F.trim(x) != "", F.xxhash64(F.trim(x))))
    lines = paged.select(F.col(n["host"]).alias("host"), F.array_distinct(F.array_compact(hashes)).alias("lines"))
    totals = paged.groupBy(F.col(n["host"]).alias("host")).agg(F.count("*").alias("pages"))
    counted = lines.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("c")).where(F.col("c") > smooth * max_ratio)
    bad = counted.join(totals, "host").where(F.col("c") > (F.col("pages") + smooth) * max_ratio).groupBy("host").agg(F.collect_list("line").alias("bad"))
    bad = Scratch(spark).cut(bad, "boilerplate").select(F.col("host").alias(n["host"]), F.col("bad").alias(n["bad"]))
    many = bad.agg(F.coalesce(F.sum(F.size(n["bad"]) + F.lit(8)), F.lit(0))).first()[0]
    if many <= BROADCAST_HASHES:
        joined = paged.join(F.broadcast(bad), n["host"], "left")
    else:
        salted = bad.withColumn(n["salt"], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        # by all that can be hashed, so pages without a text are dealt out too
        hashed = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
        dealt = paged.withColumn(n["salt"], F.pmod(F.xxhash64(*hashed), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, [n["host"], n["salt"]], "left")
    parts = F.split(F.col(text_col), "\n", -1)
    kept = F.filter(parts, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(n["bad"]), F.xxhash64(F.trim(x))))
    hit = F.col(n["bad"]).isNotNull() & F.col(text_col).isNotNull()
    out = joined.withColumn(n["bad"], F.when(hit, F.struct(F.array_join(kept, "\n").alias("text"), (F.size(parts) - F.size(kept)).cast("long").alias("n"))))
    fresh = {c: F.col(c) for c in docs.columns} | {text_col: F.when(hit, F.col(n["bad"] + ".text")).otherwise(F.col(text_col))}
    return out.select(*[c.alias(k) for k, c in fresh.items()], F.coalesce(F.col(n["bad"] + ".n"), F.lit(0)).alias("n_dropped_lines"))


def oracle(table: str = "documents", host: str = "source", id_col: str = "doc_id", text_col: str = "text", max_ratio: float = MAX_RATIO, smooth: int = SMOOTH) -> str:
    """DuckDB SQL for (id_col, text_col, n_dropped_lines) where ids are unique."""
    return f"""
    with d as (select {id_col} as doc_id, coalesce({host}, chr(1)) as h, {text_col} as text, string_split({text_col}, chr(10)) as parts from {table}),
    l as (select distinct doc_id, h, trim(x, ' ') as line from (select doc_id, h, unnest(parts) as x from d)),
    t as (select h, count(*) as pages from d group by h),
    bad as (select h, list(line) as bad from (select h, line, count(*) as c from l where line <> '' group by h, line) join t using (h)
            where c > {smooth} * {max_ratio} and c > (pages + {smooth}) * {max_ratio} group by h),
    k as (select doc_id, text, parts, list_filter(parts, lambda x: trim(x, ' ') = '' or not list_contains(coalesce(bad, []), trim(x, ' '))) as kept from d left join bad using (h))
    select doc_id as {id_col}, case when text is null then null else array_to_string(kept, chr(10)) end as {text_col}, coalesce(len(parts) - len(kept), 0)::bigint as n_dropped_lines from k
    """
