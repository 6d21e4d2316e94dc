"""The pipeline's stages against brute force, each on what the one before it kept."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from noria.llm import line_dedup
from noria.llm.queries import MIX_FRACTION

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Name -> rows, of the input and of every stage."""
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(120):
        toxic = i % 4 == 0
        body = [*rng.choice(vocabulary, 40), *(["idiot"] * toxic), *rng.choice(vocabulary, 20)]
        text = " ".join(body)
        if i % 6 == 5:  # a near copy of the document before it
            text = rows[-1][1].replace("footer line\n", "").strip() + " tail"
        rows.append((i, "footer line\n" + text, "en", f"src{i % 3}", 0))
        labels.append((i, 1, int("idiot" in text)))
    rows += [(500, None, "en", "src0", None), (501, "", None, None, 0)]
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(rows, COLUMNS).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    out, now = {}, spark.read.parquet(f"{folder}/documents.parquet")
    out["input"] = now.collect()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        out[name] = now.collect()
        if name != "packing":
            assert now.columns == docs.columns
    return out


def test_order_of_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]


def test_toxic_documents_go_and_clean_ones_stay(stages):
    kept = {r["doc_id"] for r in stages["toxicity"]}
    marked = {r["doc_id"]: "idiot" in words(r["text"]) for r in stages["input"]}
    right = [(d in kept) != toxic for d, toxic in marked.items()]
    assert np.mean(right) > 0.95


def test_lines(stages):
    pages, having = Counter(), Counter()
    for r in stages["toxicity"]:
        pages[r["source"]] += 1
        having.update({(r["source"], x.strip(" ")) for x in (r["text"] or "").split("\n")})
    drop = {k for k, n in having.items() if k[1] and n > line_dedup.MAX_RATIO * (pages[k[0]] + line_dedup.SMOOTH)}
    want = {r["doc_id"]: None if r["text"] is None else "\n".join(x for x in r["text"].split("\n") if (r["source"], x.strip(" ")) not in drop) for r in stages["toxicity"]}
    assert drop and {r["doc_id"]: r["text"] for r in stages["line_dedup"]} == want


def test_one_of_each_group_stays(stages):
    sets = {}
    for r in stages["line_dedup"]:
        w = words(r["text"])
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    root = {i: i for i in ids}
    for _ in ids:
        before = dict(root)
        for a in ids:
            for b in ids:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    assert sorted(r["doc_id"] for r in stages["near_dedup"]) == [i for i in ids if root[i] == i] != ids


def test_mixture_takes_whole_documents_and_a_prefix_of_one_a_leaf(stages):
    source = {r["doc_id"]: r for r in stages["near_dedup"]}
    cut = defaultdict(int)
    for r in stages["mixing"]:
        whole = source[r["doc_id"]]
        assert whole["text"].startswith(r["text"]) and r["n_chars"] == len(r["text"])
        cut[whole["lang"], whole["source"]] += words(r["text"]) != words(whole["text"])
    assert max(cut.values()) <= 1 and len({r["doc_id"] for r in stages["mixing"]}) == len(stages["mixing"])
    total = sum(len(words(r["text"])) for r in stages["near_dedup"])
    taken = sum(len(words(r["text"])) for r in stages["mixing"])
    assert 0 <= MIX_FRACTION * total - taken <= 1 + len(cut) + 1


def test_packing_holds_every_id_once(stages):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in stages["packing"]:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == {r["doc_id"] for r in stages["mixing"]}
    for r in stages["mixing"]:
        ids, at = np.array([*t.encode(r["text"], add_special_tokens=False).ids, 1], "<u4"), 0
        for p in sorted(pieces[r["doc_id"]], key=lambda p: p["start"]):
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
