"""Mixing sources to target weights through a domain - language - source tree, by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noria.llm.common import Scratch, own

#: Leaves of one tree that may be broadcast with their hash buckets.
BROADCAST_LEAVES = 2_000
#: First hex digits of a document's hash that name its bucket; a leaf has 16 ** DIGITS buckets.
DIGITS = 3


def word_count(text: Column | str) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`, the tokens of this operator; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def word_prefix(text: Column | str, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    words = F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), n.cast("int"))
    return F.array_join(words, "")


def _fill(nodes: DataFrame, parent: list[str], budget: str, out: str) -> DataFrame:
    """Water-filling: split each parent's budget by weight; what a child cannot supply goes to its siblings by weight.

    A child is short if its supply per unit of weight is at most the level at which
    the budget is met; short children give their supply, the others the level times
    their weight.  Children come in the order of supply per weight.
    """
    order = Window.partitionBy(*parent).orderBy("per_weight", "node")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*parent)
    nodes = nodes.withColumn("per_weight", F.when(F.col("w") > 0, F.col("supply") / F.col("w")).otherwise(F.lit(float("inf"))))
    nodes = nodes.withColumn("used", F.coalesce(F.sum("supply").over(before), F.lit(0))).withColumn("left_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    nodes = nodes.withColumn("level", F.when((F.col("left_w") > 0) & (F.col("w") > 0), (F.col(budget) - F.col("used")) / F.col("left_w")))
    nodes = nodes.withColumn("short", F.coalesce(F.col("per_weight") <= F.col("level"), F.lit(False)))
    level = F.max(F.when(~F.col("short"), F.col("level"))).over(whole)
    share = F.when(F.col("w") <= 0, F.lit(0.0)).when(F.col("short"), F.col("supply").cast("double")).otherwise(level * F.col("w"))
    return nodes.withColumn(out, F.least(share, F.col("supply").cast("double"))).drop("per_weight", "used", "left_w", "level", "short")


def leaf_budgets(leaves: DataFrame, fraction: float, max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """leaves(domain, lang, source, tokens) -> with target_tokens (long).

    weights: integer weights per level, {"domain": {...}, "lang": {...}, "source": {...}};
    a name that is not listed weighs 1.  The budget is fraction of all tokens.  A
    node's supply is max_epochs times the tokens below it, so a shortage is first met
    by its siblings and goes up only where the whole subtree is short.
    """

    def w(level: str) -> Column:
        out = F.lit(1)
        for name, value in sorted(weights.get(level, {}).items()):
            out = F.when(F.col(level) == name, F.lit(int(value))).otherwise(out)
        return out.cast("long")

    leaves = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    langs = leaves.groupBy("domain", "lang").agg(F.sum("supply").alias("supply"))
    domains = langs.groupBy("domain").agg(F.sum("supply").alias("supply"))
    root = domains.select(F.lit(0).alias("root"), "domain", "supply", F.col("domain").alias("node"), w("domain").alias("w"))
    root = root.withColumn("budget", F.floor(F.sum("supply").over(Window.partitionBy("root")) / max_epochs * fraction).cast("double"))
    d = _fill(root, ["root"], "budget", "d_budget").select("domain", "d_budget")
    g = _fill(langs.join(d, "domain").withColumn("node", F.col("lang")).withColumn("w", w("lang")), ["domain"], "d_budget", "l_budget").select("domain", "lang", "l_budget")
    s = _fill(leaves.join(g, ["domain", "lang"]).withColumn("node", F.col("source")).withColumn("w", w("source")), ["domain", "lang"], "l_budget", "target")
    return s.select("domain", "lang", "source", "tokens", F.floor(F.col("target") + 1e-6).cast("long").alias("target_tokens"))


def mix_sources(docs: DataFrame, domain: Column, fraction: float, max_epochs: int, weights: dict[str, dict[str, int]], seed: int = 0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """`docs` with mix_domain, mix_tokens (words), mix_epochs (whole passes) and mix_take (words of the last, partial pass).

    Rows of which nothing is taken are not returned.  Every leaf takes whole passes
    of its documents, then a prefix of one more pass in the order of
    md5(seed:pass:id); the document at the end of the prefix is taken up to a word.

    The prefix is found in two steps: word sums of each leaf's hash buckets
    (16 ** DIGITS of them), and a running sum inside the one bucket of each leaf where
    the prefix ends.  So a leaf with any share of the rows is never sorted in a task.

    Nulls: a null domain, lang or source is the name ""; a null text has no words
    and is never taken; a null id hashes as "".  Ties and repeated rows follow each
    other by their text's md5, and equal rows are taken one by one.  Columns of
    `docs` named like the four new ones are replaced.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    new = ["mix_domain", "mix_tokens", "mix_epochs", "mix_take"]
    docs = docs.drop(*new)
    n = own([*docs.columns, *new], "domain", "lang", "source", "tokens", "hash", "bucket", "key")
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    dealt = docs.withColumns({n["domain"]: name(domain), n["lang"]: name(F.col(lang_col)), n["source"]: name(F.col(source_col)), n["tokens"]: word_count(F.col(text_col).cast("string"))})
    keys = ["domain", "lang", "source"]
    thin = scratch.cut(dealt.select(*[F.col(n[k]).alias(k) for k in keys], F.col(n["tokens"]).alias("tokens"), name(F.col(id_col)).alias("id")), "words")
    budgets = scratch.cut(leaf_budgets(thin.groupBy(*keys).agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), fraction, max_epochs, weights), "budgets")
    full = F.floor(F.col("target_tokens") / F.col("tokens")).cast("long")
    leaf = budgets.select(*keys, full.alias("epochs"), (F.col("target_tokens") - full * F.col("tokens")).alias("rest"))
    hashed = lambda epochs, i: F.md5(F.concat_ws(":", F.lit(str(seed)), epochs.cast("string"), i))

    # Where in the order of hashes each leaf's prefix ends.
    buckets = thin.join(leaf, keys).groupBy(*keys, "rest", F.substring(hashed(F.col("epochs"), F.col("id")), 1, DIGITS).alias("bucket")).agg(F.sum("tokens").alias("tokens"))
    before = F.coalesce(F.sum("tokens").over(Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = buckets.withColumn("before", before).where("before < rest and before + tokens >= rest").select(*keys, F.col("bucket").alias("edge"), "before")
    leaf = scratch.cut(leaf.join(ends, keys, "left"), "leaves").select(*[F.col(k).alias(n[k]) for k in keys], F.struct("epochs", "rest", "edge", "before").alias(n["key"]))
    few = leaf.count() <= BROADCAST_LEAVES
    joined = dealt.join(F.broadcast(leaf) if few else leaf, [n[k] for k in keys])
    at = F.col(n["key"])
    joined = joined.withColumn(n["hash"], hashed(at["epochs"], name(F.col(id_col))))
    joined = joined.withColumn(n["bucket"], F.substring(n["hash"], 1, DIGITS))
    last = F.coalesce(F.col(n["bucket"]) == at["edge"], F.lit(False))
    w = Window.partitionBy(*[n[k] for k in keys]).orderBy(n["hash"], F.md5(F.col(text_col).cast("string").cast("binary"))).rowsBetween(Window.unboundedPreceding, -1)
    edge = joined.where(last).withColumn(n["bucket"], at["before"] + F.coalesce(F.sum(n["tokens"]).over(w), F.lit(0)))
    edge = edge.withColumn(n["bucket"], F.greatest(F.lit(0), F.least(F.col(n["tokens"]), at["rest"] - F.col(n["bucket"]))))
    whole = joined.where(~last).withColumn(n["bucket"], F.when(F.coalesce(F.col(n["bucket"]) < at["edge"], F.lit(False)), F.col(n["tokens"])).otherwise(F.lit(0)))
    out = whole.unionAll(edge).select(*docs.columns, F.col(n["domain"]).alias(new[0]), F.col(n["tokens"]).alias(new[1]), at["epochs"].alias(new[2]), F.col(n["bucket"]).cast("long").alias(new[3]))
    return out.where("mix_tokens > 0 and (mix_epochs > 0 or mix_take > 0)")


def mixed_texts(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The mixture itself: a row per pass of a document, the last one cut to its prefix; the mix_ columns go.

    Repeated rows and null ids are rows of their own; an empty mixture stays empty.
    """
    cols = [c for c in mixed.columns if not c.startswith("mix_")]
    pass_ = own(cols, "pass")["pass"]
    rows = mixed.withColumn(pass_, F.explode(F.concat(F.when(F.col("mix_epochs") > 0, F.array_repeat(F.lit(-1).cast("long"), F.col("mix_epochs").cast("int"))).otherwise(F.array().cast("array<long>")), F.when(F.col("mix_take") > 0, F.array("mix_take")).otherwise(F.array().cast("array<long>")))))
    cut = (F.col(pass_) >= 0) & (F.col(pass_) < F.col("mix_tokens"))
    text = F.when(cut, word_prefix(text_col, F.col(pass_))).otherwise(F.col(text_col)).alias(text_col)
    return rows.select(*[text if c == text_col else F.col(c) for c in cols])


def oracle(domain: str, fraction: float, max_epochs: int, weights: dict[str, dict[str, int]], seed: int = 0, table: str = "documents") -> str:
    """DuckDB SQL for (doc_id, mix_domain, mix_tokens, mix_epochs, mix_take) where doc_id is unique."""

    def w(level: str) -> str:
        return "(case " + " ".join(f"when {level} = '{k}' then {int(v)}" for k, v in sorted(weights.get(level, {}).items())) + " else 1 end)" if weights.get(level) else "1"

    def fill(src: str, parent: str, node: str, budget: str, out: str) -> str:
        part = f"partition by {parent}"
        order = f"over ({part} order by per_weight, {node} rows between unbounded preceding and 1 preceding)"
        return f"""(select *, least(case when w <= 0 then 0.0 when short then supply::double else max(case when not short then level end) over ({part}) * w end, supply::double) as {out} from
          (select *, coalesce(per_weight <= level, false) as short from
            (select *, case when left_w > 0 and w > 0 then ({budget} - used) / left_w end as level from
              (select *, coalesce(sum(supply) {order}, 0)::double as used, (sum(w) over ({part}) - coalesce(sum(w) {order}, 0))::double as left_w from
                (select *, case when w > 0 then supply::double / w else 'infinity'::double end as per_weight from {src})))))"""

    return f"""
    with d as (select *, coalesce(lang, '') as g, coalesce(source, '') as s, coalesce({domain}, '') as dom, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as tokens from {table}),
    leaves as (select dom as domain, g as lang, s as source, sum(tokens)::bigint as tokens, (sum(tokens) * {max_epochs})::bigint as supply from d group by all having sum(tokens) > 0),
    langs as (select domain, lang, sum(supply)::bigint as supply from leaves group by all),
    doms as (select domain, sum(supply)::bigint as supply, 0 as root from langs group by all),
    rt as (select *, {w("domain")} as w, floor(sum(supply) over () / {max_epochs} * {fraction})::double as budget from doms),
    fd as (select domain, d_budget from {fill("rt", "root", "domain", "budget", "d_budget")}),
    lg as (select *, {w("lang")} as w from langs join fd using (domain)),
    fl as (select domain, lang, l_budget from {fill("lg", "domain", "lang", "d_budget", "l_budget")}),
    sc as (select *, {w("source")} as w from leaves join fl using (domain, lang)),
    t as (select domain, lang, source, tokens, floor(target + 1e-6)::bigint as goal from {fill("sc", "domain, lang", "source", "l_budget", "target")}),
    e as (select domain, lang, source, goal // tokens as epochs, goal - (goal // tokens) * tokens as rest from t),
    o as (select doc_id, dom, tokens, epochs, rest, coalesce(sum(tokens) over (partition by dom, g, s order by md5(concat('{seed}:', epochs, ':', doc_id)), md5(text) rows between unbounded preceding and 1 preceding), 0) as before
          from d join e on d.dom = e.domain and d.g = e.lang and d.s = e.source)
    select doc_id, dom as mix_domain, tokens as mix_tokens, epochs::bigint as mix_epochs, greatest(0, least(tokens, rest - before))::bigint as mix_take from o
    where tokens > 0 and (epochs > 0 or greatest(0, least(tokens, rest - before)) > 0)
    """
