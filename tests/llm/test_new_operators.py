"""Personal data, lexical search and ball k-means against plain Python, and the classifier's logits against a slow loop."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from noria.llm import ball_kmeans, lexical_search, pii, toxicity

DOCS = "doc_id long, text string, row string, term string, id string, key string"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def table(spark, texts, ids=None):
    """Documents with extra columns that are named like the operators' own."""
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOCS)


def luhn(d):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))) or (kind == "card" and 16 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 8 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def learned_spans(texts, rounds=pii.ROUNDS, support=pii.SUPPORT, evidence=pii.EVIDENCE):
    """The graph in plain Python, with words as keys in place of hashes."""
    identifier = re.compile(r"(?<!\S)(?:[^\s0-9@]*[0-9@]\S*(?: [().-]*[0-9]\S*)*|\S*?[(\[][aA][tT][)\]]\S*)", re.ASCII)
    kinds = list(BASE)
    able = {
        "email": lambda c, d: re.search(r"@|[(\[]at[)\]]", c) and re.search("[a-z]", c),
        "ip": lambda c, d: d >= 4 and re.fullmatch(r"[0-9a-f.:/]+", c) and re.search("[.:]", c),
        "card": lambda c, d: d >= 8 and re.fullmatch(r"[0-9][0-9 -]+", c),
        "phone": lambda c, d: d >= 5 and re.fullmatch(r"[+]?[0-9][0-9 ().-]+", c),
    }
    seen, everywhere = [], Counter()

    def keys(words, i):
        one, two, after = (words[j] if 0 <= j < len(words) else "" for j in (i - 1, i - 2, i + 1))
        if one in ("", "#", "~"):
            two = ""
        return [k for k, ok in ((("1", one), one), (("2", two, one), two), (("3", one, after), one and after)) if ok]

    for n, text in enumerate(texts):
        text = text or ""
        found = list(identifier.finditer(text))
        words = [w if len(w) <= pii.WORD else "~" for w in re.split(r"[\x20\x09-\x0D]+", identifier.sub("\0", text).lower()) if w]
        at = [i for i, w in enumerate(words) if w == "\0"]
        words = ["#" if w == "\0" else w for w in words]
        for i in range(len(words)):
            everywhere.update(keys(words, i))
        for i, m in zip(at, found, strict=True):
            core = m[0].strip(pii.EDGES)
            start = m.start() + len(m[0]) - len(m[0].lstrip(pii.EDGES))
            whole = [k for k, a, b in base_spans(core.lower()) if (a, b) == (0, len(core))]
            digits = len(re.sub("[^0-9]", "", core))
            forms = {k for k in kinds if 5 <= len(core) <= 64 and able[k](core.lower(), digits)}
            seen.append((n, start, start + len(core), core.lower(), whole[0] if whole else None, forms, keys(words, i)))
    links, places = defaultdict(set), Counter()
    info = {core: (kind, forms) for _, _, _, core, kind, forms, _ in seen}
    for _, _, _, core, _, _, patterns in seen:
        for p in patterns:
            links[p].add(core)
            places[p] += 1
    good, score = {}, {}
    for _ in range(rounds):
        fresh = {}
        for p, cores in links.items():
            if len(cores) < support:
                continue
            for k in kinds:
                right = sum(1000 if info[c][0] == k else score.get((c, k), 0) for c in cores if info[c][0] in (None, k))
                new = sum(score.get((c, k), 0) for c in cores if info[c][0] is None)
                unknown = sum(info[c][0] is None and k in info[c][1] for c in cores)
                all_ = 1000 * (len(cores) + everywhere[p] - places[p]) - (1000 - pii.UNKNOWN) * (1000 * unknown - new) // 1000
                if right >= 1000 * support:
                    strength = math.floor(-1000 * math.log((all_ - right + 1000) / (all_ + 1000)))
                    if strength >= evidence:
                        fresh[p, k] = strength
        good, total = fresh, Counter()
        for (p, k), strength in good.items():
            for c in links[p]:
                if info[c][0] is None and k in info[c][1]:
                    total[c, k] += strength
        score = {ck: math.floor(1000 - 1000 * math.exp(-s / 1000)) for ck, s in total.items()}
    out = defaultdict(list)
    for n, start, end, core, kind, _, _ in seen:
        mine = [(-total[core, k], kinds.index(k)) for k in kinds if kind is None and (core, k) in total]
        if mine and not any(a < end and start < b for _, a, b in base_spans(texts[n])):
            out[n].append((kinds[min(mine)[1]], start, end))
    return out


ODD = [
    None, "", "no data", "a@b.c_d@e.f x", "1.2.3.4.5.6.7.8 and 999.1.2.3 and 0001.2.3.255 1.2.3.256", "😀 4111-1111-1111-1111 😀 +49 (0)30 1234567) 😀 x@y.z.", "4111 1111 1111 1112", "+1 2", "mail a%b+c@d-e.f-g.h,i@j",
    "İİ 10.0.0.1\n\n\t 10.0.0.2  +1 (988) 555-2485, or 4111 1111 1111 1111!!", "7" * 3000, "a" * 3000 + "@" + "b." * 3000 + "c", "1.1.1.1 " * 700, "+1" + " " * 3000, "x@y " * 300 + "z@w.v",
]


def contexts(n=12):
    names = [f"name{chr(97 + i)}" for i in range(n)]
    out = [f"Please call me at +1 (20{i}) 555-010{i} today, {name}" for i, name in enumerate(names[:9])]
    out += [f"please  call me at 555-77{i}1 today" for i in range(3)]
    out += [f"write to\nuser{i}@mail.example.com, thanks" for i in range(10)] + ["write to bob(at)example today", "write to 555 now", "seen bob(at)example again: 555-7701"]
    out += [f"of the 10.0.0.{i} thing" for i in range(5)] + ["of the 12:34:56 day"] + ["of the other"] * 9
    return out


def test_pii_equals_plain_python(spark):
    texts = ODD + contexts()
    got = {r["doc_id"]: r for r in pii.find_pii(table(spark, texts)).collect()}
    learned = learned_spans(texts)
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert [tuple(x) for x in got[i]["base"]] == base_spans(text), text
        assert [tuple(x) for x in got[i]["learned"]] == learned[i], text
    found = {(kind, texts[n][a:b]) for n, spans in learned.items() for kind, a, b in spans}
    assert {("phone", f"555-77{i}1") for i in range(3)} | {("email", "bob(at)example")} == {x for x in found if "12:34" not in x[1]}
    assert not any("12:34" in x[1] for x in found)


def test_pii_sql_equals_plain_python():
    import duckdb

    texts = ODD + contexts()
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": range(len(texts)), "text": pa.array(texts, pa.string())}))
    got, learned, order = {r[0]: r for r in con.sql(pii.oracle()).fetchall()}, learned_spans(texts), list(pii.KINDS)
    for i, text in enumerate(texts):
        base = base_spans(text)
        both = sorted(base + learned[i], key=lambda s: (order.index(s[0]), s[1]))
        listed = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i][1:] == (*[sum(s[0] == k for s in base) for k in order], hashlib.sha256(listed(base).encode()).hexdigest(), listed(both), len(learned[i])), text


def test_pii_joins_when_nothing_is_small(spark, monkeypatch):
    rows = table(spark, contexts())
    want = sorted(map(str, pii.digests(pii.find_pii(rows)).collect()))
    monkeypatch.setattr(pii, "BROADCAST_ROWS", -1)
    assert sorted(map(str, pii.digests(pii.find_pii(rows)).collect())) == want


def test_pii_digests(spark):
    texts = ["x 1.2.3.4 and a@b.cd 5.6.7.8", None, "a@b.cd"]
    rows = table(spark, [*texts, texts[0]], [1, None, 1, 1])
    got = sorted(tuple(r) for r in pii.digests(pii.find_pii(rows)).collect() if r["doc_id"] is not None)
    listed = "email:14:20,ip:2:9,ip:21:28"
    assert got.count((1, 1, 2, 0, 0, hashlib.sha256(listed.encode()).hexdigest(), listed, 0)) == 2 and len(got) == 3
    none = [r for r in pii.digests(pii.find_pii(rows)).collect() if r["doc_id"] is None]
    assert [(r["spans"], r["base_sha256"]) for r in none] == [("", hashlib.sha256(b"").hexdigest())]
    assert pii.find_pii(rows.where("false")).count() == 0


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k):
    counts = {i: Counter(terms(t)) for i, t in docs if terms(t)}
    n, total = len(counts), sum(sum(c.values()) for c in counts.values())
    df = Counter(t for c in counts.values() for t in c)
    out = []
    for item, text in items:
        scores = {}
        for i, c in counts.items():
            m = 50 + 50 * sum(c.values()) * n // total
            scores[i] = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
        best = sorted((-s, i) for i, s in scores.items() if s > 0)[:k]
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_search_equals_plain_python(spark, monkeypatch, limit):
    monkeypatch.setattr(lexical_search, "BROADCAST_TERMS", limit)
    rng = np.random.default_rng(3)
    words = [*"the a Éte été x9 9 ÜBER über it's snow☃man".split(), *(f"w{i}" for i in range(60))]
    texts = [" ".join(rng.choice(words[: 5 + i % 70], rng.integers(0, 60))) for i in range(150)] + [None, "", "...", "the" * 2000, "the " * 3000, "same same", "same same", "Snow_Man-x9"]
    items = [(0, "the The über w3 w4"), (1, "it's snow☃man SAME"), (2, None), (3, "..."), (4, "unheard of"), (5, " ".join(words)), (6, "été")]
    index = lexical_search.build_index(table(spark, texts))
    got = lexical_search.search(index, spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, rank int"), 20)
    assert sorted(map(tuple, got.collect())) == ranked(list(enumerate(texts)), items, 20)
    assert index.documents == sum(bool(terms(t)) for t in texts)


def test_search_of_repeated_and_null_ids_and_empty_tables(spark):
    rows = table(spark, ["red fox", "red fox", "red", "blue"], [7, 7, None, 2])
    items = spark.createDataFrame([(1, "red"), (1, "red"), (None, "blue")], "item_id long, text string")
    index = lexical_search.build_index(rows)
    got = sorted(((r["item_id"] or -1, r["rank"], r["doc_id"] or -1) for r in lexical_search.search(index, items).collect()), key=str)
    assert got == [(-1, 1, 2), (1, 1, -1), (1, 1, -1), (1, 2, 7), (1, 2, 7), (1, 3, 7), (1, 3, 7)]
    assert lexical_search.search(index, items.where("false")).count() == 0
    assert lexical_search.search(lexical_search.build_index(rows.where("false")), items).count() == 0


def lloyd(vectors, k, rounds, seed, scale):
    whole = {i: [math.floor(scale * float(x)) for x in v] for i, v in vectors}
    centroids = [whole[i] for i in sorted(whole, key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())[:k]]

    def assign():
        return {i: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for i, v in whole.items()}

    for _ in range(rounds):
        at = assign()
        for j in range(len(centroids)):
            mine = [whole[i] for i, (_, c) in at.items() if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    at = assign()
    inertia = Counter()
    for d, c in at.values():
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, (d, c) in at.items())


@pytest.mark.parametrize("spread", [0.02, 0.3, 1.0])
def test_ball_kmeans_equals_plain_lloyd(spark, spread):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (7, 6))
    x = np.round((centres[rng.integers(0, 7, 400)] + rng.normal(0, spread, (400, 6))) * 4) / 4 if spread == 1 else centres[rng.integers(0, 7, 400)] + rng.normal(0, spread, (400, 6))
    x = x.astype(np.float32)
    x[380:] = x[:20]  # copies
    rows = [(i, v.tolist(), 1, "x", 3) for i, v in enumerate(x)]
    bad = [(900, None, 1, "x", 3), (901, [1.0] * 5, 1, "x", 3), (902, [1.0] * 5 + [None], 1, "x", 3), (903, [float("nan")] * 6, 1, "x", 3), (904, [float("-inf")] * 6, 1, "x", 3), (905, [], 1, "x", 3)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, cluster int, v string, distance int")
    got = ball_kmeans.ball_kmeans(frame, k=9, rounds=4, dims=6)
    assert sorted(map(tuple, got.collect())) == lloyd([(i, v) for i, v, *_ in rows], 9, 4, 2, 256)


def test_ball_kmeans_small_null_and_large(spark):
    schema = "vec_id long, embedding array<double>"
    few = spark.createDataFrame([(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [5.0, 5.0]), (2, [4.0, 4.0])], schema)
    got = sorted((r["vec_id"] or -1, r["distance"]) for r in ball_kmeans.ball_kmeans(few, k=40, rounds=5, dims=2, scale=1).collect())
    assert len(got) == 4 and got[1:3] == [(1, 0), (1, 0)]
    assert ball_kmeans.ball_kmeans(few.where("false"), dims=2).count() == 0
    with pytest.raises(Exception, match="64-bit"):
        ball_kmeans.ball_kmeans(spark.createDataFrame([(1, [1e30, 0.0])], schema), dims=2).count()


def test_ball_kmeans_skips_far_centroids():
    """A member of a stable core is compared with no neighbour; what is compared gives the same as all."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (30, 8))
    x = centres[rng.integers(0, 30, 2000)] + rng.integers(-300, 300, (2000, 8))
    at, d = ball_kmeans.nearest(x, ball_kmeans.Balls(centres))
    radii = np.array([math.sqrt(d[at == j].max(initial=0)) for j in range(30)])
    balls = ball_kmeans.neighbours(centres, radii)
    assert sum(map(len, balls.near)) < 30 * 29 / 4
    again = ball_kmeans.reassign(x, at, balls)
    assert (again[0] == at).all() and (again[1] == d).all()


def test_logits_equal_a_slow_loop():
    rng = np.random.default_rng(2)
    model = toxicity.Model(members=[])
    model.table = rng.normal(0, 1, model.table.shape).astype(np.float32)
    model.filters = [rng.normal(0, 1, (w, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS]
    model.bias, model.out = (rng.normal(0, 1, len(toxicity.WIDTHS) * toxicity.FILTERS).astype(np.float32) for _ in range(2))
    texts = ["one two three four", "x", "", "Ünï ((code)) ... !!"]
    buckets, rows = toxicity.word_buckets(pa.array(texts))
    got = toxicity.logits(model, buckets, rows)
    for t in range(len(texts)):
        e = [sum(model.table[b] for b in word) for word in buckets[rows[t] : rows[t + 1]]]
        z = model.out_bias
        for i, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                here = [sum(float(e[s + j] @ model.filters[i][j, :, f]) for j in range(width) if s + j < len(e)) for s in range(len(e))]
                at = i * toxicity.FILTERS + f
                z += max(0, max(here) + model.bias[at]) * model.out[at] if here else 0
        assert abs(got[t] - z) < 1e-3 * (1 + abs(z))
    assert (toxicity.word_buckets(pa.array(["...", "((code))"]))[0][1] == toxicity.word_buckets(pa.array(["code"]))[0][0]).all()


def test_texts_without_words_are_never_rejected(spark):
    model = toxicity.Model(out_bias=9.0, share=0.9)
    rows = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, " \n ", None), (4, "a", "en")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(rows, model).collect()}
    assert got[1] == got[2] == got[3] == 0.9 and got[4] > 0.99
    assert sorted(r["doc_id"] for r in toxicity.reject_toxic(rows, model).collect()) == [1, 2, 3]
    assert toxicity.reject_toxic(rows.where("false"), model).count() == 0


def test_fold_models_are_the_mean_and_do_not_see_their_fold(spark):
    rng = np.random.default_rng(4)
    texts, y = [rng.integers(0, 50, (30, toxicity.PARTS)).astype(np.int32) for _ in range(60)], np.arange(60) % 2
    for i in range(1, 60, 2):
        texts[i][7] = 77
    model, z = toxicity._fit_folds(spark, texts, y.astype(float))
    one, seen = toxicity.fit_fold(texts, y.astype(float), 1)
    assert len(model.members) == toxicity.FOLDS and np.allclose(z[toxicity.folds_of(y) == 1], seen, atol=1e-3)
    assert z[y > 0].mean() > z[y == 0].mean() + 1
