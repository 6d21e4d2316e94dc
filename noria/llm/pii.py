"""Personal data by bootstrapped contextual extraction, in DataFrame and SQL functions only.

Identifiers of four kinds are found by their form (the base).  Those that are a whole word
seed a graph of lexical patterns and instances.  An instance is an identifier-shaped
word: one that holds a digit, an @, (at) or [at], with the words of digits that follow it
after one space each.  A pattern is the words beside it: the word before, the two words before, or
the words before and after.  In each round a pattern scores by the share of seeds and
discovered instances in all that it ever stands beside, ordinary words included, and the
patterns of high confidence discover further instances.  What has the form of a kind and
is not known yet counts a quarter against a pattern; all else counts whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noria.llm.common import Scratch

#: In the order in which spans are listed.  No alternative of these patterns is retried, so they take linear time and no stack.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: What a match `m` of each kind must hold.
_VALID = {
    "email": "true",
    "ip": rf"{{m}} rlike r'^{_PART}(?:\.{_PART}){{{{3}}}}$'",
    "card": "length(translate({m}, ' -', '')) between 16 and 19 and luhn_check(translate({m}, ' -', ''))",
    "phone": "length(translate({m}, '+ ().-', '')) between 8 and 15",
}
#: A text without this has none of the kind.
_HINT = {"email": "instr(text, '@') > 0", "ip": r"text rlike r'[0-9]\.[0-9]'", "card": "text rlike r'[0-9][ -]?[0-9]'", "phone": "instr(text, '+') > 0"}
#: Forms (of at least 5 and at most 64 characters) in which an instance `c` may be discovered as each kind; d: its digits.
_ABLE = {
    "email": r"c rlike r'@|[(\[]at[)\]]' and c rlike '[a-z]'",
    "ip": r"d >= 4 and c rlike r'^[0-9a-f.:/]+$' and c rlike r'[.:]'",
    "card": "d >= 8 and c rlike r'^[0-9][0-9 -]+$'",
    "phone": "d >= 5 and c rlike r'^[+]?[0-9][0-9 ().-]+$'",
}
IDENTIFIER = r"(?<!\S)(?:[^\s0-9@]*+[0-9@]\S*+(?: [().-]*+[0-9]\S*+)*+|\S*?[(\[][aA][tT][)\]]\S*+)"
#: Characters that are cut from both ends of an identifier-shaped word.
EDGES = ".,;:!?\"()[]{}<>*|&%$#=~^"
#: A context word of more characters is one of a class, "~"; an identifier-shaped one is "#".
WORD = 40
#: Rounds; the instances a pattern needs; and its confidence, as -1000 ln(1 - confidence): 0.8.
ROUNDS, SUPPORT, EVIDENCE = 3, 3, 1609
#: What an instance that is not known yet counts against a pattern, in thousandths, if its form allows the kind.
UNKNOWN = 250
#: Patterns, or discovered instances, that are broadcast at most, at most 24 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 20
_SPACE = r"' \t\n\u000B\u000C\r'"
_BLOCK = 256


def _let(name: str, value: str, body: str) -> str:
    """`body` with `name` standing for `value`, which is computed once a row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _matches(pattern: str, each: str, where: str = "true") -> str:
    """SQL array of `each` for the matches of `pattern` in `text` for which `where` holds.

    In both: z.m the matches, z.s the texts between them, i a match's number from 0, at
    its first code point, m the match.  Offsets are sums of lengths by blocks, so a text
    of n matches takes n times a block's additions, not n * n.
    """
    at = f"length(z.s[i]) + aggregate(slice(b, 1, cast(i div {_BLOCK} as int)), 0L, (x, y) -> x + y) + aggregate(slice(z.l, cast(i div {_BLOCK} as int) * {_BLOCK} + 1, i % {_BLOCK}), 0L, (x, y) -> x + y)"
    blocks = f"transform(sequence(0, size(z.m) div {_BLOCK}), j -> aggregate(slice(z.l, cast(j as int) * {_BLOCK} + 1, {_BLOCK}), 0L, (x, y) -> x + y))"
    found = f"transform(z.m, (m, i) -> if({where}, {_let('at', at, each)}, null))"
    lengths = "zip_with(y.s, y.m, (a, b) -> cast(length(a) + coalesce(length(b), 0) as bigint))"
    inner = _let("z", f"named_struct('s', y.s, 'm', y.m, 'l', {lengths})", _let("b", blocks, f"filter({found}, f -> f is not null)"))
    return _let("y", f"named_struct('s', split(text, r'{pattern}', -1), 'm', regexp_extract_all(text, r'{pattern}', 0))", inner)


def _base(kind: str) -> Column:
    each = "named_struct('start', at, 'end', at + length(m))"
    return F.expr(f"case when {_HINT[kind]} then {_matches(KINDS[kind], each, _VALID[kind].format(m='m'))} else cast(array() as array<struct<start: bigint, end: bigint>>) end").alias(kind)


def _word(text: str, last: bool) -> str:
    """The last or first word of a text that has no white space at that end."""
    cut = f"element_at(split(right({text}, {WORD + 1}), r'\\s+', -1), -1)" if last else f"split(left({text}, {WORD + 1}), r'\\s+', -1)[0]"
    return _let("w", f"lower({cut})", f"if(length(w) > {WORD}, '~', w)")


def _keys(one: str, two: str, after: str) -> str:
    """The patterns' keys of a place: `one` the word before it, `two` the one before that, `after` the word after; null where a word lacks."""
    return f"array(if({one} = '', null, xxhash64('1', {one})), if({two} = '' or {one} in ('', '#', '~'), null, xxhash64('2', {two}, {one})), if({one} = '' or {after} = '', null, xxhash64('3', {one}, {after})))"


def _identifiers() -> Column:
    """array of (start, end, key, kind, able, patterns) of the identifier-shaped words of `text`, in order."""
    edges = "'" + EDGES.replace("\\", "\\\\") + "'"
    anchored = {
        "email": r"c rlike r'^[a-z0-9._%+-]++@[a-z0-9-]++(?:\.[a-z0-9-]++)++$'",
        "ip": _VALID["ip"].format(m="c"),
        "card": "c rlike r'^[0-9](?:[ -]?[0-9])++$' and " + _VALID["card"].format(m="c"),
        "phone": r"c rlike r'^\+[0-9][ ().0-9-]+[0-9]$' and " + _VALID["phone"].format(m="c"),
    }
    kind = "case " + " ".join(f"when {test} then {j}" for j, test in enumerate(anchored.values())) + " end"
    able = _let("d", "length(regexp_replace(c, '[^0-9]', ''))", "if(length(c) between 5 and 64, " + " + ".join(f"if({test}, {1 << j}, 0)" for j, test in enumerate(_ABLE.values())) + ", 0)")
    before, after = f"trim(TRAILING {_SPACE} FROM z.s[i])", f"trim(LEADING {_SPACE} FROM z.s[i + 1])"
    one = f"case when p != '' then {_word('p', True)} when i > 0 then '#' else '' end"
    rest = f"trim(TRAILING {_SPACE} FROM left(p, length(p) - length(element_at(split(right(p, {WORD + 1}), r'\\s+', -1), -1))))"
    two = f"case when p = '' or one in ('#', '~') then '' else {_let('q', rest, f'''case when q != '' then {_word('q', True)} when i > 0 then '#' else '' end''')} end"
    next_ = f"case when n != '' then {_word('n', False)} when i + 1 < size(z.m) then '#' else '' end"
    patterns = _let("p", before, _let("one", one, _let("two", two, _let("n", after, _let("next", next_, _keys("one", "two", "next"))))))
    lead, core = f"length(m) - length(trim(LEADING {edges} FROM m))", f"trim(BOTH {edges} FROM m)"
    span = "'start', at + lead, 'end', at + lead + length(core)"
    each = _let("core", core, _let("lead", lead, _let("c", "lower(core)", f"named_struct({span}, 'key', xxhash64(c), 'kind', {kind}, 'able', {able}, 'patterns', {patterns})")))
    schema = "array<struct<start: bigint, end: bigint, key: bigint, kind: int, able: int, patterns: array<bigint>>>"
    return F.expr(f"case when text rlike r'[0-9@]|[(\\[][aA][tT][)\\]]' then {_matches(IDENTIFIER, each)} else cast(array() as {schema}) end").alias("identifiers")


def _places(docs: DataFrame) -> DataFrame:
    """`pattern`: the keys of every word's place, in all texts."""
    words = F.expr(f"split(trim(BOTH {_SPACE} FROM regexp_replace(lower(text), r'{IDENTIFIER}', '#')), r'\\s+', -1)")
    sides = docs.select(words.alias("word")).selectExpr("word", "concat(array(''), slice(word, 1, size(word) - 1)) as one", "concat(array('', ''), slice(word, 1, greatest(0, size(word) - 2))) as two", "concat(slice(word, 2, size(word)), array('')) as next")
    # `two` has one entry too many where there is one word; it lies beside no word
    shifted = sides.selectExpr("inline(arrays_zip(one, two, next, word))")
    cut = shifted.where("word is not null and word != ''").select(*(F.expr(f"if(length({c}) > {WORD}, '~', {c})").alias(c) for c in ("one", "two", "next")))
    return cut.select(F.explode(F.expr(_keys("one", "two", "next"))).alias("pattern")).where("pattern is not null")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, support: int = SUPPORT, evidence: int = EVIDENCE) -> DataFrame:
    """A row per row of docs: id_col, base and learned spans.

    Columns: `base`, an array of (kind, start, end) in the order of KINDS and then of
    start, in code points, end exclusive; `learned`, an array of the same of what the
    patterns discover, by start, none of which overlaps a base span.

    Base: the leftmost non-overlapping matches of each kind's pattern; those that fail
    the kind's test are dropped.  Learned: instances of another form, beside patterns
    that `support` known instances stand beside and that are right with a confidence of
    at least 1 - exp(-evidence / 1000), wherever in the table they occur.  Of two kinds,
    the one with more evidence, then the first.  All of docs is read twice and
    written nowhere; the graph is kept in the shared folder.

    A null or empty text has no spans.  Rows are independent of their ids: repeated and
    null ids have a row each.  Equal texts find the same spans, but a pattern counts
    distinct instances, so copies don't raise it.  An empty table gives no rows.  Extra
    columns are not read.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = scratch.cut(texts.select(F.monotonically_increasing_id().alias("row"), "id", *map(_base, KINDS), _identifiers()), "found")
    seen = found.select("row", F.inline("identifiers"))
    learned = _discover(scratch, seen, texts, rounds, support, evidence)
    kinds = ", ".join(f"transform({k}, x -> named_struct('kind', {j}, 'start', x.start, 'end', x.end))" for j, k in enumerate(KINDS))
    out = found.drop("identifiers").join(learned, "row", "left").select("id", F.expr(f"concat({kinds})").alias("base"), F.coalesce("learned", F.expr("cast(array() as array<struct<kind: int, start: bigint, end: bigint>>)")).alias("learned"))
    apart = F.expr("filter(learned, x -> not exists(base, b -> b.start < x.end and x.start < b.end))")
    named = "transform({0}, x -> named_struct('kind', element_at(array(" + ", ".join(f"'{k}'" for k in KINDS) + "), x.kind + 1), 'start', x.start, 'end', x.end))"
    return out.withColumn("learned", apart).select(F.col("id").alias(id_col), F.expr(named.format("base")).alias("base"), F.expr(named.format("learned")).alias("learned"))


def _bounded(df: DataFrame) -> DataFrame:
    """df, a written table, broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _discover(scratch: Scratch, seen: DataFrame, texts: DataFrame, rounds: int, support: int, evidence: int) -> DataFrame:
    """(row, learned): what the pattern-instance graph discovers."""
    edges = seen.select("key", "kind", "able", F.explode("patterns").alias("pattern")).where("pattern is not null").groupBy("pattern", "key", "kind", "able").agg(F.count("*").alias("places"))
    # a pattern beside fewer instances can never have the support
    met = scratch.cut(edges.groupBy("pattern").agg(F.count("*").alias("instances"), F.sum("places").alias("places")).where(F.col("instances") >= support), "met")
    few = _bounded(met)
    everywhere = _places(texts).join(F.broadcast(met.select("pattern")) if few is not met else met.select("pattern"), "pattern").groupBy("pattern").agg(F.count("*").alias("everywhere"))
    links = scratch.cut(edges.join(few.select("pattern"), "pattern", "left_semi").select("pattern", "key", "kind", "able"), "links")
    open_ = links.groupBy("pattern").agg(F.array(*(F.expr(f"count_if(kind is null and able & {1 << j} != 0)") for j in range(len(KINDS)))).alias("open"))
    patterns = scratch.cut(met.join(everywhere, "pattern").join(open_, "pattern").select("pattern", F.expr("1000 * (instances + everywhere - places)").alias("all"), "open"), "patterns")
    good = None
    for at in range(rounds):
        known = links.where("kind is not null").select("pattern", "kind", F.lit(1000).alias("score"), F.lit(0).alias("new"))
        if good is not None:
            # as if the patterns' errors were independent
            score = F.floor(1000 - 1000 * F.exp(-F.col("sum") / 1000)).cast("int")
            new = links.where("kind is null").select("pattern", "key").join(_scores(links, good), "key")
            known = known.unionByName(new.select("pattern", F.col("kind2").alias("kind"), score.alias("score"), score.alias("new")))
        share = known.groupBy("pattern", "kind").agg(F.sum("score").alias("right"), F.sum("new").alias("new")).where(F.col("right") >= 1000 * support).join(patterns, "pattern")
        everything = F.expr(f"all - ({1000 - UNKNOWN}L * (1000 * open[kind] - new)) div 1000")
        strength = F.floor(-1000 * F.log((everything - F.col("right") + 1000) / (everything + 1000)))
        good = _bounded(scratch.cut(share.select("pattern", "kind", strength.alias("evidence")).where(F.col("evidence") >= evidence), f"good{at}"))
    best = _scores(links, good).groupBy("key").agg(F.min_by("kind2", F.struct(-F.col("sum"), F.col("kind2"))).alias("kind2"))
    instances = _bounded(scratch.cut(best, "instances"))
    spans = seen.where("kind is null").join(instances, "key").select("row", F.struct(F.col("start"), F.col("kind2").alias("kind"), F.col("end")).alias("span"))
    listed = F.expr("transform(array_sort(collect_list(span)), x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end))")
    return scratch.cut(spans.groupBy("row").agg(listed.alias("learned")), "learned")


def _scores(links: DataFrame, good: DataFrame) -> DataFrame:
    """(key, kind2, sum): the evidence for each instance that is no seed, of the kinds that its form allows."""
    named = good.withColumnRenamed("kind", "kind2")
    able = F.col("able").bitwiseAND(F.expr("shiftleft(1, kind2)")) != 0
    return links.where("kind is null and able != 0").join(named, "pattern").where(able).groupBy("key", "kind2").agg(F.sum("evidence").alias("sum"))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base spans, the digest of their list, and the list of all spans."""
    text = "array_join(transform({0}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    order = "case x.kind " + " ".join(f"when '{k}' then {j}" for j, k in enumerate(KINDS)) + " end"
    both = f"transform(array_sort(transform(concat(base, learned), x -> named_struct('o', {order}, 'start', x.start, 'end', x.end, 'kind', x.kind))), x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end))"
    return found.select(F.col(id_col), *counts, F.sha2(F.expr(text.format("base")).cast("binary"), 256).alias("base_sha256"), F.expr(text.format(both)).alias("spans"), F.expr("cast(size(learned) as bigint)").alias("n_learned"))


def oracle(rounds: int = ROUNDS, support: int = SUPPORT, evidence: int = EVIDENCE) -> str:
    """DuckDB SQL for `digests` over documents with unique ids: words in place of hashes, and the rounds written out."""
    forms = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", r"[0-9](?:[ -]?[0-9])+", r"\+[0-9][ ().0-9-]+[0-9]"]

    def valid(m: str) -> list[str]:
        digits = f"regexp_replace({m}, '[^0-9]', '', 'g')"
        part = "case when length(ltrim(p, '0')) > 3 then 999 else coalesce(try_cast(nullif(ltrim(p, '0'), '') as int), 0) end"
        value = f"substr(reverse({digits}), i, 1)::int"
        luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: case when i % 2 = 1 then {value} else 2 * {value} - 9 * ({value} > 4)::int end)) % 10 = 0"
        return ["true", f"list_max(list_transform(string_split({m}, '.'), lambda p: {part})) <= 255", f"length({digits}) between 16 and 19 and {luhn}", f"length({digits}) between 8 and 15"]

    edges = EDGES.replace("'", "''")
    raw = " union all ".join(f"select doc_id, {j} as k, regexp_extract_all(text, '{f}') as m, string_split_regex(text, '{f}') as s from d" for j, f in enumerate(forms))
    base_ok = " ".join(f"when {j} then {v}" for j, v in enumerate(valid("m")))
    kind = " ".join(f"when regexp_full_match(c, '{f.replace('A-Z', '')}') and {v} then {j}" for j, (f, v) in enumerate(zip(forms, valid("c"), strict=True)))
    d = "length(regexp_replace(c, '[^0-9]', '', 'g'))"
    able = [r"regexp_matches(c, '@|[(\[]at[)\]]') and regexp_matches(c, '[a-z]')", rf"{d} >= 4 and regexp_full_match(c, '[0-9a-f.:/]+') and regexp_matches(c, '[.:]')", rf"{d} >= 8 and regexp_full_match(c, '[0-9][0-9 -]+')", rf"{d} >= 5 and regexp_full_match(c, '[+]?[0-9][0-9 ().-]+')"]
    names = "['email', 'ip', 'card', 'phone']"
    parts = [
        "d as (select doc_id, coalesce(text, '') as text from documents)",
        f"raw as ({raw})",
        "one as (select doc_id, k, m[i] as m, (list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::bigint as start from (select *, unnest(range(1, len(m) + 1)) as i from raw))",
        f"base as materialized (select doc_id, k, start, start + length(m) as stop from one where case k {base_ok} end)",
        r"piece as (select doc_id, text, unnest(p) as w, generate_subscripts(p, 1) as j from (select doc_id, text, string_split_regex(text, '[\x20\x09-\x0D]') as p from d))",
        "placed as (select *, (sum(length(w) + 1) over (partition by doc_id order by j) - length(w) - 1)::bigint as off, regexp_matches(w, '[0-9@]') as shaped from piece)",
        r"near as (select *, coalesce(lag(shaped) over o, false) and substr(text, off, 1) = ' ' and regexp_matches(w, '^[().-]*[0-9]') as tied from placed window o as (partition by doc_id order by j))",
        r"word as (select doc_id, text, j, w, off, shaped or regexp_matches(w, '[(\[][aA][tT][)\]]') as is_id, tied, sum((not tied)::int) over (partition by doc_id order by j) as g from near where w <> '')",
        "tok as (select doc_id, min(j) as j, bool_or(is_id) as is_id, min(off) as start, max(off + length(w)) as stop, any_value(text) as text, case when bool_or(is_id) then '#' when length(lower(any_value(w))) > "
        + str(WORD)
        + " then '~' else lower(any_value(w)) end as word from word group by doc_id, g)",
        "side as materialized (select *, coalesce(lag(word) over o, '') as a, coalesce(lag(word, 2) over o, '') as b, coalesce(lead(word) over o, '') as z from tok window o as (partition by doc_id order by j))",
        "keyed as (select *, [case when a <> '' then '1 ' || a end, case when b <> '' and a not in ('', '#', '~') then '2 ' || b || ' ' || a end, case when a <> '' and z <> '' then '3 ' || a || ' ' || z end] as keys from side)",
        "every as materialized (select pattern, count(*) as n from (select unnest(keys) as pattern from keyed) where pattern is not null group by pattern)",
        f"core as (select doc_id, keys, substr(text, start + 1, stop - start) as m, start from keyed where is_id), cored as (select *, trim(m, '{edges}') as t, lower(trim(m, '{edges}')) as c, start + length(m) - length(ltrim(m, '{edges}')) as lo from core)",
        f"seen as materialized (select doc_id, lo, lo + length(t) as hi, c, keys, case {kind} end as kind, [{', '.join(f'length(c) between 5 and 64 and {a}' for a in able)}] as able from cored)",
        "edge as (select pattern, c, any_value(kind) as kind, any_value(able) as able, count(*) as places from (select unnest(keys) as pattern, c, kind, able from seen) where pattern is not null group by pattern, c)",
        f"met as (select pattern, count(*) as instances, sum(places) as places from edge group by pattern having count(*) >= {support})",
        "pat as materialized (select pattern, 1000 * (instances + n - places) as total from met join every using (pattern))",
        "link as materialized (select pattern, c, kind, able from edge join pat using (pattern)), kinds as (select unnest(range(4)) as k)",
        "open as materialized (select pattern, k, count(*) filter (where kind is null and able[k + 1]) as n from link cross join kinds group by pattern, k)",
        "score0 as (select ''::varchar as c, 0::bigint as k, 0::bigint as s where false)",
    ]
    for r in range(rounds):
        parts.append(f"""known{r} as (select pattern, kind::bigint as k, 1000 as s, 0 as new from link where kind is not null union all select pattern, k, s, s as new from link join score{r} using (c) where kind is null),
        share{r} as (select pattern, k, sum(s) as ok, sum(new) as new from known{r} group by pattern, k having sum(s) >= {1000 * support}),
        strong{r} as (select pattern, k, ok, total - ({1000 - UNKNOWN} * (1000 * n - new)) // 1000 as everything from share{r} join pat using (pattern) join open using (pattern, k)),
        good{r} as materialized (select pattern, k, floor(-1000 * ln((everything - ok + 1000)::double / (everything + 1000)::double))::bigint as e from strong{r} where floor(-1000 * ln((everything - ok + 1000)::double / (everything + 1000)::double)) >= {evidence}),
        sum{r} as materialized (select c, k, sum(e) as e from link join good{r} using (pattern) where kind is null and able[k + 1] group by c, k),
        score{r + 1} as (select c, k, floor(1000 - 1000 * exp(-e / 1000.0))::bigint as s from sum{r})""")
    last = f"sum{rounds - 1}"
    parts.append(f"best as (select c, k from (select *, row_number() over (partition by c order by e desc, k) as r from {last}) where r = 1)")
    parts.append("learned as (select s.doc_id, k, lo as start, hi as stop from seen s join best using (c) where s.kind is null and not exists (select 1 from base b where b.doc_id = s.doc_id and b.start < s.hi and s.lo < b.stop))")
    listed = f"string_agg({names}[k + 1] || ':' || start || ':' || stop, ',' order by k, start)"
    return (
        "with "
        + ",\n".join(parts)
        + f""",
    bases as (select doc_id, {", ".join(f"count(*) filter (where k = {j}) as n_{k}" for j, k in enumerate(KINDS))}, {listed} as list from base group by doc_id),
    whole as (select doc_id, {listed} as spans, count(*) filter (where new) as n_learned from (select *, false as new from base union all select *, true from learned) group by doc_id)
    select d.doc_id, {", ".join(f"coalesce(n_{k}, 0)::bigint as n_{k}" for k in KINDS)}, sha256(coalesce(list, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_learned, 0)::bigint as n_learned
    from d left join bases using (doc_id) left join whole using (doc_id)"""
    )
