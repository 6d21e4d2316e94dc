import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noria.llm import chat, embedding_dedup, line_dedup, lm, metric_search, minmax, mixing, packing, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bad string"


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x") for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_line_dedup(spark):
    rows = docs(spark, [f"menu\nbody {i}\n\n menu " for i in range(20)] + [None, "", "alone"])
    got = {r["doc_id"]: (r["text"], r["n_dropped_lines"]) for r in line_dedup.drop_boilerplate_lines(rows).collect()}
    assert got[3] == ("body 3\n", 2) and got[20] == (None, 0) and got[21] == ("", 0) and got[22] == ("alone", 0)
    assert line_dedup.drop_boilerplate_lines(rows.limit(0)).count() == 0


def test_line_dedup_takes_lines_of_one_to_five_percent_of_a_large_site(spark):
    shares = {"one": 10, "two": 20, "five": 50, "rare": 4}
    rows = [(i, "\n".join([f"body {i}", *(k for k, n in shares.items() if i < n)]), "en", "large", 0, "x") for i in range(1000)]
    rows += [(2000 + i, f"text {i}" + "\nfew" * (i < 4), "en", "small", 0, "x") for i in range(40)]
    got = {r["doc_id"]: (r["text"], r["n_dropped_lines"]) for r in line_dedup.drop_boilerplate_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[0] == ("body 0\nrare", 3) and got[15] == ("body 15", 2) and got[30] == ("body 30", 1) and got[60] == ("body 60", 0)
    assert got[2000] == ("text 0\nfew", 0)


def test_line_dedup_goes_by_the_share_of_a_site_not_by_pages_alone(spark):
    """The same line on 12 pages goes from a site of 1,000 pages and stays on one of 2,000."""
    rows = [(i, f"body {i}" + "\nshared" * (i % 1000 < 12 and i < 2000), "en", "less" if i < 1000 else "more", 0, "x") for i in range(3000)]
    got = {r["doc_id"]: r["n_dropped_lines"] for r in line_dedup.drop_boilerplate_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[i] for i in (0, 11, 12, 1000, 1011)] == [1, 1, 0, 0, 0]


def test_line_dedup_by_salted_join(spark, monkeypatch):
    rows = docs(spark, [f"menu\nbody {i}" for i in range(30)] + [None] * 30)
    want = sorted(map(str, line_dedup.drop_boilerplate_lines(rows).collect()))
    monkeypatch.setattr(line_dedup, "BROADCAST_HASHES", -1)
    assert sorted(map(str, line_dedup.drop_boilerplate_lines(rows).collect())) == want and "n_dropped_lines=1" in want[0]


def test_packing_is_an_exact_partition(spark):
    texts = ["", None, "a  b\n c <|endoftext|>", "word " * 3000, "x", "x"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(docs(spark, texts), path).toPandas()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        ids, at = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in got[got.doc_id == i].sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == list(np.cumsum([0, *g.length[:-1]])) and g.length.sum() <= 2048


def test_packing_ids_equal_those_of_the_plain_tokenizer():
    """Mixed white space, letters of many scripts, digits, contractions, control bytes and the added token."""
    import random
    from pathlib import Path

    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, rng = Tokenizer.from_file(path), random.Random(3)
    bits = [*" \n\t\r", "  ", "\n\n", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", *"aBéßﬁ中가1²½٣.,_-’×÷ªºµǅʰΩƛ", "!?", "'s", "'ll", "can't", "I'M", "x're5", "~~", "<|endoftext|>", "<|", "\x00", "😀", "e\u0301", "\u200b", "word", "Ñandú"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(6000)]
    words = packing.WordTokenizer(Path(path).read_text(encoding="utf-8"), cache_words=50)
    assert words.encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_mixing_fills_siblings_first(spark):
    leaves = spark.createDataFrame([("d", "a", "s", 10), ("d", "b", "s", 1000), ("e", "a", "s", 1000)], "domain string, lang string, source string, tokens long")
    got = {(r["domain"], r["lang"]): r["target_tokens"] for r in mixing.leaf_budgets(leaves, 0.5, 1, {}).collect()}
    assert got == {("d", "a"): 10, ("d", "b"): 492, ("e", "a"): 502}
    one = docs(spark, ["a b c d", "e f g h", None])
    out = mixing.mix_sources(one, F.lit("d"), 0.75, 1, {})
    assert sum(r["mix_take"] + r["mix_epochs"] * r["mix_tokens"] for r in out.collect()) == 6
    assert sum(len(words(r["text"])) for r in mixing.mixed_texts(out).collect()) == 6


def test_search_equals_brute_force(spark):
    x = np.random.default_rng(0).normal(0, 0.3, (300, 6)).astype(np.float32)
    x[50:60] = x[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(900, None), (901, [float("nan")] * 6), (902, [None] * 6)]
    got = metric_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, shard_rows=100).toPandas()
    z = np.floor(64 * x.astype(float)).astype(int)
    for q in range(0, 300, 20):
        s = z @ z[q]
        want = [j for j in np.lexsort((np.arange(300), -s)) if j != q][:20]
        g = got[got.query_id == q].sort_values("rank")
        assert list(g.vec_id) == want and list(g.score) == list(s[want])


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    x = np.repeat(rng.normal(size=(40, 8)), 5, axis=0) + rng.normal(0, 0.12, (200, 8))
    x[7] = x[3]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(500, None), (501, [0.0] * 8), (502, [None] * 8)]
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tile=64).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    comp = np.arange(200)
    while True:
        new = np.array([min(comp[i], *comp[near[i]], 10**9) for i in range(200)])
        if (new == comp).all():
            break
        comp = new
    assert all(got[i]["n_links"] == near[i].sum() and got[i]["component_id"] == comp[i] for i in range(200))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (500, 501, 502))


@pytest.mark.parametrize("spread", [0.02, 0.3, 3.0])
def test_embedding_blocks_give_up_no_link(spread):
    """Tight clusters (whole blocks are rejected), loose ones, and noise; sides of several blocks."""
    rng = np.random.default_rng(9)
    x = np.repeat(rng.normal(size=(30, 24)), 90, axis=0) + rng.normal(0, spread, (2700, 24))
    axes = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    y = x / np.linalg.norm(x, axis=1)[:, None] @ axes
    x = x[embedding_dedup.box_order(y, embedding_dedup.BLOCK)]
    sides = [embedding_dedup.Side(np.arange(len(part)).tobytes(), np.ones(len(part), np.int64).tobytes(), part.tobytes(), axes) for part in (x[:1500], x[1500:])]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T
    assert not (np.abs(near - 0.9) < 1e-12).any()
    found = {(int(i), int(j) + 1500) for p, q in embedding_dedup.linked_pairs(*sides, 0.9, False) for i, j in zip(p, q, strict=True)}
    assert found == {(i, j + 1500) for i, j in zip(*np.nonzero(near[:1500, 1500:] >= 0.9), strict=True)}
    found = {(int(i), int(j)) for p, q in embedding_dedup.linked_pairs(sides[0], sides[0], 0.9, True) for i, j in zip(p, q, strict=True)}
    assert found == {(i, j) for i, j in zip(*np.nonzero(np.triu(near[:1500, :1500], 1) >= 0.9), strict=True)}
    assert len(found) > 1000 or spread > 1


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = [" ".join(rng.choice([f"w{i}" for i in range(500)], 80)) for _ in range(8)]
    texts = []
    for b in base:
        for _ in range(6):
            w = b.split()
            for j in rng.integers(0, 80, 2):
                w[j] = f"n{rng.integers(10**6)}"
            texts.append(" ".join(w))
    texts += [texts[0], texts[0].upper(), None, "", "one two", "one two", "one"]
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set()) for w in map(words, texts)]
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 85 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    got = {r["doc_id"]: r for r in minmax.near_duplicates(docs(spark, texts), shingle=3, percent=85).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == root


def test_toxicity_learns_and_takes_nulls(spark):
    rng = np.random.default_rng(3)
    w = [f"w{i}" for i in range(60)]
    y = [int(i % 4 == 0) for i in range(400)]
    texts = [" ".join([*rng.choice(w, 20), *(["idiot"] if t else []), *rng.choice(w, 20)]) for t in y]
    table = docs(spark, [*texts, None, ""])
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(y)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(table, labels, toxicity.not_held_out())
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(table, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == y[i] for i in held]) > 0.95 and 0 <= got[400] < 0.5 and got[400] == got[401]


def test_toxicity_keeps_the_prior_of_all_labels(spark):
    """The word is no sure sign: half of the toxic documents lack it, and a tenth of the clean ones have it."""
    rng = np.random.default_rng(6)
    w = [f"w{i}" for i in range(40)]
    y = [int(i % 9 == 0) for i in range(3600)]
    texts = [" ".join([*rng.choice(w, 10), *(["idiot"] if rng.random() < (0.5 if t else 0.1) else [])]) for t in y]
    table = docs(spark, texts)
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    model = toxicity.train(table, labels, F.lit(True), sample=150)
    got = [r["toxicity"] for r in toxicity.score(table, model).select("toxicity").collect()]
    assert abs(np.mean(got) - np.mean(y)) < 0.03


def test_toxicity_fits_on_whole_texts():
    texts = pa.array([" ".join(f"w{i}" for i in range(6000)), "a b", None])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), texts, pa.array([1, 0, 0], pa.int32())], ["id", "text", "y"])
    got = [x for b in toxicity._gather([batch]) for x in b.column("words").to_pylist()]
    assert [len(x) for x in got] == [6000 * toxicity.PARTS, 2 * toxicity.PARTS, 0]


def test_chat_round_trip(spark):
    assert all(chat.unescape(chat.escape(x)) == x and "<|" not in chat.escape(x) for x in ("<|", "<\\|", "<<|im_end|>", "\\<\\\\|", ""))
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>"), (2, 0, "user", "hi"), (2, 1, "assistant", "b<"), (3, 0, None, None), (None, 0, "user", "x")]
    nodes, leaves = chat.prefix_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert nodes.count() == 4
    n = sorted(nodes.collect(), key=lambda r: r["start"])
    assert [r["start"] for r in n] == list(np.cumsum([0, *(r["length"] for r in n)])[:-1])
    assert all(r["position"] == sum(a["end"] - a["start"] for a in r["ancestors"]) for r in n)
    got = {r["conv_id"]: r for r in chat.read_back(nodes, leaves).collect()}
    assert set(got) == {1, 2, 3} and got[1]["loss_sha256"] == hashlib.sha256(b"<|im_end|>").hexdigest()
    assert got[2]["turns_sha256"] == hashlib.sha256(b"user\nhi\nassistant\nb<\n").hexdigest() and got[3]["n_turns"] == 1


def test_chat_tree_against_brute_force(spark):
    """Copies, prefixes of others, shared first turns and one long conversation: intervals give back every prefix."""
    rng, convs = np.random.default_rng(5), {}
    for c in range(60):
        convs[c] = [("user" if t % 2 == 0 else "assistant", "abc"[int(rng.integers(0, 2 + t % 2))] * (t + 1)) for t in range(int(rng.integers(1, 7)))]
    convs |= {60: convs[3], 61: convs[3], 62: convs[4] + [("user", "<|im_end|>")], 63: [("user", f"{t}") for t in range(900)]}
    rows = [(c, t, *x) for c, turns in convs.items() for t, x in enumerate(turns)]
    nodes, leaves = chat.prefix_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    n = sorted(nodes.collect(), key=lambda r: r["start"])
    prefixes = {tuple(turns[: k + 1]) for turns in convs.values() for k in range(len(turns))}
    sequence = "".join(r["chunk"] for r in n)
    assert len(n) == len(prefixes) and len({r["node"] for r in n}) == len(n)
    assert [r["start"] for r in n] == list(np.cumsum([0, *(r["length"] for r in n)])[:-1])
    read = ["".join(sequence[a["start"] : a["end"]] for a in r["ancestors"]) + r["chunk"] for r in n]
    assert sorted(read) == sorted("".join(chat.format_turn(*x)[0] for x in p) for p in prefixes)
    assert all(r["position"] == len(x) - r["length"] for r, x in zip(n, read, strict=True))
    depths = [r["depth"] for r in n]
    assert all(b <= a + 1 for a, b in zip(depths, depths[1:], strict=False)) and depths[0] == 0
    spans = {r["conv_id"]: r["spans"] for r in leaves.collect()}
    assert {c: "".join(sequence[x["start"] : x["end"]] for x in s) for c, s in spans.items()} == {c: "".join(chat.format_turn(*x)[0] for x in turns) for c, turns in convs.items()}
    assert len(spans[63]) == 1
    for r in chat.read_back(nodes, leaves).collect():
        turns = convs[r["conv_id"]]
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256("".join(b for a, b in turns if a == "assistant").encode()).hexdigest()


@pytest.mark.parametrize("compress", [True, False])
def test_warc_salvage(compress):
    made = [warc.record("response", "http://a/", str(i), b"x" * 50, hashlib.sha256(b"x" * 50).hexdigest(), 50) for i in range(4)]
    parts = [warc.member(m) if compress else m for m in made]
    bad = bytearray(parts[1])
    bad[len(bad) // 2] ^= 0xFF
    data = parts[0] + bytes(bad) + parts[2] + b"junk" + parts[3] + parts[0][:20]
    found = list(warc.salvage(data))
    assert [f[3]["warc-record-id"] for f in found if f[0] == "record"] == ["<urn:page:0>", "<urn:page:2>", "<urn:page:3>"]
    assert sorted({(f[1], f[2]) for f in found})[0][0] == 0 and sum(b - a for a, b in {(f[1], f[2]) for f in found}) == len(data)


def _foreign(kind, block, i, *headers, mime="text/plain"):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{i}>", f"Content-Type: {mime}", f"Content-Length: {len(block)}", *headers]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_warc_reads_archives_of_others(spark):
    http, sha1, sha256 = b"HTTP/1.1 200 OK\r\n\r\nbody", hashlib.sha1(b"body"), hashlib.sha256(b"body")
    b32 = base64.b32encode(sha1.digest()).decode()
    said = [f"sha1:{b32}", f"sha1:{sha1.hexdigest()}", f"SHA-256:{sha256.hexdigest().upper()}", f"sha256:{base64.b32encode(sha256.digest()).decode()}", "odd:value", f"sha1:{base64.b32encode(b'x' * 20).decode()}"]
    made = [_foreign("response", http, i, f"WARC-Payload-Digest: {d}", mime="application/http; msgtype=response") for i, d in enumerate(said)]
    others = ["resource", "conversion", "request", "metadata", "warcinfo"]
    made += [_foreign(k, f"block of {k}".encode(), k) for k in others]
    made.append(_foreign("resource", b"x", "bad", f"WARC-Block-Digest: sha1:{b32}"))
    rows = spark.createDataFrame([("a", bytearray(b"".join(made)))], "path string, content binary")
    got = {r["record_id"]: r["payload"] and bytes(r["payload"]) for r in warc.read_archives(rows).where("kind = 'record'").collect()}
    assert got == {f"<urn:uuid:{i}>": b"body" for i in range(5)} | {f"<urn:uuid:{k}>": f"block of {k}".encode() for k in others}


def test_warc_member_keeps_what_is_good_around_a_bad_record():
    made = [_foreign("resource", b"x" * 50, i) for i in range(4)]
    made[1] = made[1].replace(b"Content-Length: 50", b"Content-Length: 49")
    data = warc.member(b"".join(made)) + warc.member(made[1]) + warc.member(made[3])
    found = list(warc.salvage(data))
    assert [f[3]["warc-record-id"][10:-1] if f[0] == "record" else "gap" for f in found] == ["0", "gap", "2", "3", "gap", "3"]
    assert sum(b - a for a, b in {(f[1], f[2]) for f in found}) == len(data)


def test_warc_keeps_what_comes_before_a_fault_inside_a_member():
    rng = np.random.default_rng(1)
    made = [_foreign("resource", rng.bytes(3000), i) for i in range(20)]
    whole = warc.member(b"".join(made))
    ids = lambda found: [f[3]["warc-record-id"][10:-1] if f[0] == "record" else "gap" for f in found]
    spans = lambda found: sum(b - a for a, b in {(f[1], f[2]) for f in found})
    cut = whole[: len(whole) * 3 // 4] + warc.member(made[0]) + b"tail"
    found = list(warc.salvage(cut))
    assert spans(found) == len(cut) and ids(found)[-3:] == ["gap", "0", "gap"]
    alone = list(warc.salvage(whole[: len(whole) * 3 // 4]))
    assert ids(alone) == [*map(str, range(14)), "gap", "gap"][: len(alone)] and len(alone) >= 15
    # with digests, records before wrong data stay; the damaged one does not
    made = [warc.record("response", "http://a/", str(i), x := rng.bytes(3000), hashlib.sha256(x).hexdigest(), 3000) for i in range(6)]
    bad = bytearray(warc.member(b"".join(made)))
    bad[len(bad) // 2] ^= 0xFF
    found = list(warc.salvage(bytes(bad) + warc.member(made[0])))
    assert ids(found)[:2] == ["0", "1"] and "gap" in ids(found) and ids(found)[-1] == "0" and spans(found) == len(bad) + len(warc.member(made[0]))


def test_warc_inflates_each_member_once():
    """Time a MB does not grow with the archive: no member touches what follows it."""
    import time

    one = warc.member(warc.record("response", "http://a/", "1", b"x" * 4000, hashlib.sha256(b"x" * 4000).hexdigest(), 4000))
    took = []
    for n in (200, 20_000):
        data, began = one * n, time.process_time()
        assert sum(1 for _ in warc.salvage(data)) == n
        took.append((time.process_time() - began) / n)
    assert took[1] < 4 * took[0]


@pytest.mark.parametrize("most", [200_000, 0])
def test_warc_revisits(spark, monkeypatch, most):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", most)

    pages = spark.createDataFrame([(5, "u", "p" * 200), (2, None, "p" * 200), (3, "u", "short"), (4, "u", "short"), (6, "u", None)], "page_id long, url string, html string")
    got = {int(r["record_id"]): (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.write_and_read(pages).collect()}
    assert got == {5: ("revisit", "2", 200), 2: ("response", None, 200), 3: ("response", None, 5), 4: ("response", None, 5), 6: ("response", None, 0)}


def test_lm_probabilities(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice([f"{a}{i}" for i in range(15)], 40)) for a in "ab" for _ in range(60)] + [None, "unseen words"]
    got = lm.lm_scores(docs(spark, texts), shortlist=20, head=25).toPandas().set_index("doc_id")
    trained = zlib.crc32(b"121") % 10 != 0  # then its words have been counted
    assert got.n_tokens[120] == 1 and got.n_known[121] == (3 if trained else 1)
    held = [i for i in range(120) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert got.score[held].sum() > got.base_score[held].sum()
    m = lm.LogBilinear(np.full(5, 0.2))
    s = (m.r[2] * m.c1 + m.r[3] * m.c2) @ m.q.T + m.b
    assert np.exp(s - m.log_norms()[2, 3]).sum() == pytest.approx(1, abs=1e-5)


def test_lm_against_a_slow_loop(spark, monkeypatch):
    """Counts, base score and score, token by token, from the model that the operator fitted; probabilities add up to 1."""
    kept = {}
    classes, forms = lm.Classes.__init__, lm.LogBilinear.with_parameters

    def classes_init(self, *args):
        classes(self, *args)
        kept["classes"] = self

    def with_parameters(self, flat):
        kept["model"] = forms(self, flat)
        return kept["model"]

    monkeypatch.setattr(lm.Classes, "__init__", classes_init)
    monkeypatch.setattr(lm.LogBilinear, "with_parameters", with_parameters)
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(90)]
    texts = [" ".join(np.minimum(rng.zipf(1.3, rng.integers(1, 30)), 90).astype(str)) for _ in range(80)] + [" ".join(words), "", None, "never Seen BEFORE 1 2"]
    got = lm.lm_scores(docs(spark, texts), shortlist=6, head=40).toPandas().set_index("doc_id")
    c, m = kept["classes"], kept["model"]
    split = [[*(t or "").lower().split(), None] for t in texts]
    count = Counter(w for i, t in enumerate(split) if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(count.values()), len(count)
    key = {w: lm.END if w is None else lm.tokens(pa.array([w]))[0][0] for w in {w for t in split for w in t}}
    place = {w: [int(x[0]) for x in c.look_up(np.array([k]))] for w, k in key.items()}

    def p(word, u, w):
        h = m.r[u] * m.c1 + m.r[w] * m.c2
        s = np.exp((m.q @ h + m.b).astype(float))
        cls, row, _ = place[word]
        out = s[cls] / s.sum()
        if row >= 0:
            lo, hi = c.bounds[cls - c.k], c.bounds[cls - c.k + 1]
            e = np.exp((m.rows[lo:hi] @ h).astype(float)) * c.mass[lo:hi]
            out *= e[row - lo] / e.sum()
            if row >= c.own:
                out *= (count[word] + 0.1) / c.mass[row]
        return out

    assert abs(m.rows).max() > 0 and len(c.mass) > c.own
    for i, t in enumerate(split):
        cls = [c.start, c.start, *(place[w][0] for w in t)]
        assert (got.n_tokens[i], got.n_known[i], got.train_tokens[i]) == (len(t), sum(count[w] > 0 for w in t), n)
        assert got.base_score[i] == pytest.approx(sum(np.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)
        assert got.score[i] == pytest.approx(sum(np.log10(p(w, cls[j + 1], cls[j])) for j, w in enumerate(t)), rel=1e-4)
    total = sum(p(w, c.start, 0) for w in count)
    unseen = 0.0
    for row in range(c.own, len(c.mass)):
        g = int(c.group[row])
        h = m.r[c.start] * m.c1 + m.r[0] * m.c2
        s = np.exp((m.q @ h + m.b).astype(float))
        lo, hi = c.bounds[g], c.bounds[g + 1]
        e = np.exp((m.rows[lo:hi] @ h).astype(float)) * c.mass[lo:hi]
        unseen += s[c.k + g] / s.sum() * e[row - lo] / e.sum() * 0.1 / c.mass[row]
    assert total + unseen == pytest.approx(1, abs=1e-6)


@pytest.mark.parametrize("packed", [False, True])
def test_warc_salvage_takes_time_in_proportion(packed):
    """Archives of bad records, plain and gzip, from 1 to 16 MB."""
    import time

    bad = warc.record("response", "u", "1", b"x" * 900, "0" * 64, 900).replace(b"x" * 10, b"y" * 10, 1)
    good = warc.record("response", "u", "2", b"z" * 50, hashlib.sha256(b"z" * 50).hexdigest(), 50)
    one, last = (warc.member(x) if packed else x for x in (bad, good))
    took = []
    for mb in (1, 16):
        data = one * ((mb << 20) // len(one)) + last
        began = time.process_time()
        kinds = Counter(x[0] for x in warc.salvage(data))
        took.append((time.process_time() - began) / len(data))
        assert kinds["record"] == 1
    assert took[1] < 3 * took[0]
