"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

The classifier is the mean of as many models as there are folds, each fitted in a task of
its own on the other folds.  A model starts from the classes' log odds of each word, one
of the embedding's dimensions, so that what few examples say does not hang on its seed.
"""

from __future__ import annotations

import pickle
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noria.llm.common import Scratch, crc_mod, longs, own, prefix_hashes, raw, rolling, slices, word_spans

#: Rows of the embedding table, its width, filters per width, and the widths in words.
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
#: Bytes of a word's two prefixes; with the word itself they make its embedding.
PREFIXES = (4, 6)
PARTS = 1 + len(PREFIXES)
#: Labelled documents of each class that the fit takes at most, each of them whole.
SAMPLE = 4000
#: A bucket met in fewer training documents has no embedding.
MIN_DOCS = 5
#: Share of the words that a step of the fit leaves out, and how fast the embeddings it meets shrink.
DROP, DECAY = 0.5, 0.02
#: Bins a unit of log odds has in the histograms that calibrate, and their ends.
BINS, LEAST, MOST = 256, -32 * 256, 32 * 256 - 1
#: Folds of the fitted documents, each scored by a model of the others for the calibration; the models' mean scores all else.
FOLDS = 3
#: Documents that a word's log odds are smoothed by, and their share in the embedding's first dimension.
SMOOTH, GAIN = 4, 0.25
#: Labelled ids that are broadcast at most, 8 bytes each.
BROADCAST_IDS = 1 << 20
#: Labelled documents of each class a language needs for a threshold of its own.
MIN_LANGUAGE = 20
#: Bytes of letters and digits, and all non-ASCII ones.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Model:
    table: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, DIM), np.float32))
    filters: list = field(default_factory=list)  # per width: (width, DIM, FILTERS)
    bias: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS, np.float32))
    out: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS, np.float32))
    out_bias: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict = field(default_factory=dict)
    share: float = 0.5  # of the toxic labels: the score of a text without words
    members: list = field(default_factory=list)  # models whose mean this one is


def word_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, PARTS) embedding rows of every word, and the first word of each text (one more at the end).

    A word counts without the ASCII punctuation at its ends, if anything is left.
    """
    data, at = raw(texts)
    starts, ends, rows = word_spans(data, at)
    if len(starts):
        place = np.arange(len(data))
        after = np.minimum.accumulate(np.where(_LETTER[data], place, len(data))[::-1])[::-1][starts]
        before = np.maximum.accumulate(np.where(_LETTER[data], place, -1))[ends - 1] + 1
        some = after < ends
        starts, ends = np.where(some, after, starts), np.where(some, before, ends)
    rolled = rolling(data)
    out = np.empty((len(starts), PARTS), np.int32)
    for j, most in enumerate((None, *PREFIXES)):
        stop = ends if most is None else np.minimum(ends, starts + most)
        out[:, j] = (prefix_hashes(rolled, starts, stop) + np.uint64(j * 0x9E3779B9)) % np.uint64(BUCKETS)
    return out, rows


def _embed(model: Model, buckets: np.ndarray) -> np.ndarray:
    e = model.table[buckets[:, 0]]
    for j in range(1, PARTS):
        e = e + model.table[buckets[:, j]]
    return e


def _convolve(model: Model, e: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Per width, every filter's value at every window start; windows past a text's end read zeros."""
    n = len(e)
    last = np.repeat(rows[1:], np.diff(rows))
    out = []
    for i, width in enumerate(WIDTHS):
        z = np.zeros((n, FILTERS), np.float32)
        for j in range(width):
            part = e[j:] @ model.filters[i][j]
            if j:
                part[np.arange(j, n) >= last[: n - j]] = 0
            z[: n - j] += part
        out.append(z)
    return out


def logits(model: Model, buckets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of each text, the members' mean; a text without words has none of the filters."""
    if model.members:
        return np.mean([logits(m, buckets, rows) for m in model.members], axis=0)
    pooled = np.zeros((len(rows) - 1, len(WIDTHS) * FILTERS), np.float32)
    full = np.flatnonzero(np.diff(rows))
    if len(full) and model.filters:
        z = _convolve(model, _embed(model, buckets), rows)
        best = np.hstack([np.maximum.reduceat(x, rows[:-1][full]) for x in z])
        pooled[full] = np.maximum(best + model.bias, 0)
    return pooled @ model.out + model.out_bias


def log_odds(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Of each bucket, how much more often documents of label 1 hold it; smoothed by SMOOTH documents of the whole."""
    n, total = np.zeros((2, BUCKETS)), np.array([(labels == 0).sum(), (labels > 0).sum()])
    for words, y in zip(texts, labels, strict=True):
        n[int(y)][np.unique(words)] += 1
    prior = SMOOTH * total / max(1, total.sum())
    rate = (n + prior[:, None]) / np.maximum(total + prior, 1e-9)[:, None]
    return np.log(rate[1] / rate[0])


def fit(texts: list[np.ndarray], labels: np.ndarray, epochs: int = 6, least_steps: int = 200, batch: int = 32, rate: float = 0.02, drop: float = DROP, decay: float = DECAY, seed: int = 5) -> Model:
    """Adam on the log loss, for at least `least_steps` batches; each max passes its gradient to the window it came from."""
    rng = np.random.default_rng(seed)
    model = Model()
    seen = np.zeros(BUCKETS, np.int32)
    for t in texts:
        seen[np.unique(t)] += 1
    live = seen >= MIN_DOCS
    model.table[live] = rng.normal(0, 0.1, (int(live.sum()), DIM))
    model.filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    model.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
    share = np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3)
    model.out_bias = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return model
    # the first filter of each width begins as the log odds of a word
    model.table[live, 0] = GAIN * log_odds(texts, labels)[live]
    firsts = [i * FILTERS for i in range(len(WIDTHS))]
    for f in model.filters:
        f[:, :, 0] = 0
        f[0, 0, 0] = 1
    model.out[firsts] = 0.5
    model.out[0] = 1.5
    model.bias[firsts] = -1
    params = {"bias": model.bias, "out": model.out, **{f"f{i}": f for i, f in enumerate(model.filters)}}
    m1, m2 = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    t1, t2 = np.zeros_like(model.table), np.zeros_like(model.table)
    step = 0
    for _ in range(max(epochs, -(-least_steps * batch // len(texts)))):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            pick = [i for i in order[lo : lo + batch] if len(texts[i])]
            if not pick:
                continue
            step += 1
            buckets = np.concatenate([texts[i] for i in pick])
            rows = np.cumsum([0, *(len(texts[i]) for i in pick)])
            # words are left out at random, so no few of them can carry a document
            kept = (rng.random(len(buckets)) >= drop).astype(np.float32)[:, None]
            e = _embed(model, buckets) * kept
            zs = _convolve(model, e, rows)
            at = np.stack([np.concatenate([rows[d] + z[rows[d] : rows[d + 1]].argmax(axis=0) for z in zs]) for d in range(len(pick))])
            cols = np.arange(at.shape[1])
            best = np.stack([zs[c // FILTERS][at[:, c], c % FILTERS] for c in cols], axis=1)
            act = np.maximum(best + model.bias, 0)
            p = 1 / (1 + np.exp(-(act @ model.out + model.out_bias)))
            d_logit = ((p - labels[pick]) / len(pick)).astype(np.float32)
            grads = {"out": act.T @ d_logit, **{f"f{i}": np.zeros_like(f) for i, f in enumerate(model.filters)}}
            d_act = d_logit[:, None] * model.out * (act > 0)
            grads["bias"] = d_act.sum(axis=0)
            where, value = [], []
            for i, width in enumerate(WIDTHS):
                for j in range(width):
                    pos = at[:, i * FILTERS : (i + 1) * FILTERS] + j
                    ok = pos < rows[1:, None]
                    pos = np.where(ok, pos, 0)
                    g = d_act[:, i * FILTERS : (i + 1) * FILTERS] * ok
                    grads[f"f{i}"][j] = np.einsum("dfk,df->kf", e[pos], g)
                    where.append(pos.ravel())
                    value.append((g[:, :, None] * model.filters[i][j].T[None]).reshape(-1, DIM) * kept[pos.ravel()])
            model.out_bias -= rate * float(d_logit.sum())
            for k, v in params.items():
                m1[k] = 0.9 * m1[k] + 0.1 * grads[k]
                m2[k] = 0.999 * m2[k] + 0.001 * grads[k] ** 2
                v -= rate * 0.3 * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
            where, value = np.concatenate(where), np.concatenate(value)
            ids = buckets[where].ravel()
            hit, back = np.unique(ids, return_inverse=True)
            g = np.zeros((len(hit), DIM), np.float32)
            np.add.at(g, back, np.repeat(value, PARTS, axis=0))
            keep = live[hit]
            hit, g = hit[keep], g[keep]
            t1[hit] = 0.9 * t1[hit] + 0.1 * g
            t2[hit] = 0.99 * t2[hit] + 0.01 * g**2
            model.table[hit] -= rate * t1[hit] / (np.sqrt(t2[hit]) + 1e-6) + decay * model.table[hit]
    return model


def folds_of(labels: np.ndarray, folds: int = FOLDS) -> np.ndarray:
    """The fold of each document; each class is dealt evenly to the folds."""
    rng, fold = np.random.default_rng(8), np.zeros(len(labels), np.int64)
    for y in (0, 1):
        mine = np.flatnonzero(labels == y)
        fold[rng.permutation(mine)] = np.arange(len(mine)) % folds
    return fold


def fit_fold(texts: list[np.ndarray], labels: np.ndarray, k: int, folds: int = FOLDS) -> tuple[Model, np.ndarray]:
    """A model of all folds but k, and its log odds of the documents of fold k."""
    fold = folds_of(labels, folds)
    model, held = fit([texts[i] for i in np.flatnonzero(fold != k)], labels[fold != k], seed=5 + k), np.flatnonzero(fold == k)
    z = [logits(model, np.concatenate([texts[i] for i in some]), np.cumsum([0, *(len(texts[i]) for i in some)])) for some in np.array_split(held, len(held) // 256 + 1) if len(some)]
    return model, np.concatenate([np.zeros(0), *z])


def calibrate(model: Model, z: np.ndarray, labels: np.ndarray, langs: list, counts: np.ndarray | None = None, share: float | None = None) -> None:
    """Platt scaling on log odds of models that have not seen the document, then the threshold of best F1 for each language.

    counts: documents of each (z, label, language), 1 where it is missing.  share: that of
    the toxic ones in all labels, by which the classes weigh.
    """
    counts = np.ones(len(z)) if counts is None else counts
    pos, neg = float(counts[labels > 0].sum()), float(counts[labels == 0].sum())
    if not pos or not neg:
        return
    share = pos / (pos + neg) if share is None else share
    weight = counts * np.where(labels > 0, share / pos, (1 - share) / neg) * (pos + neg)
    target = np.where(labels > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = np.array([1.0, 0.0])
    x = np.stack([z, np.ones_like(z)], axis=1).astype(np.float64)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(h, x.T @ (weight * (p - target)) + 1e-3 * (w - [1.0, 0.0]))
        w = w - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    model.scale = (float(w[0]), float(w[1]))
    p = probability(model, z)
    for lang in sorted({x for x in langs if x is not None}):
        mine = np.array([x == lang for x in langs])
        y, s, w = labels[mine], p[mine], weight[mine]
        if counts[mine][y > 0].sum() < MIN_LANGUAGE or counts[mine][y == 0].sum() < MIN_LANGUAGE:
            continue
        grid = np.round(np.arange(0.4, 0.85, 0.05), 2)
        f1 = [2 * w[(s >= t) & (y > 0)].sum() / (w[s >= t].sum() + w[y > 0].sum()) for t in grid]
        best = np.flatnonzero(np.array(f1) >= max(f1) - 1e-12)
        model.thresholds[lang] = float(grid[best[np.abs(grid[best] - 0.5).argmin()]])


def probability(model: Model, z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.scale[0] * z.astype(np.float64) + model.scale[1], -30, 30)))


def _gather(batches):
    for batch in batches:
        for lo, texts in slices(batch.column(1)):
            buckets, rows = word_buckets(texts)
            parts = [buckets[a:b].ravel().astype(np.uint64) for a, b in zip(rows[:-1], rows[1:], strict=True)]
            rest = {batch.schema.names[i]: c.slice(lo, len(texts)) for i, c in enumerate(batch.columns) if i != 1}
            yield pa.RecordBatch.from_pydict(rest | {"words": longs(parts).cast(pa.list_(pa.int32()))})


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from labelled rows for which `learn` (over labels) holds.

    The fit takes at most `sample` rows of each class, those with the least hash of
    their id, and their whole texts, which the driver and the task of each fold hold (12
    bytes a word).  It is calibrated on all labelled rows: each of those it took by the
    model of the other folds, all others by the models' mean, scored in Spark over their
    whole texts and counted by language, label and log odds.  The classes weigh as in all
    labels, so the prior is the same at every size.  Rows with a null label or id teach
    nothing; a row whose id has both labels counts as each, and repeated rows of an id
    teach each.  Without rows of both classes, or of an empty table, the model has no
    filters, and every text gets the same score.  Languages choose a threshold, never a
    score.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows = labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).distinct()
    order, total = F.xxhash64("id", F.lit(3)), {y: n for y, n in rows.groupBy("y").count().collect()}
    picked = scratch.cut(rows.where("y = 1").orderBy(order, "id").limit(sample).unionAll(rows.where("y = 0").orderBy(order, "id").limit(sample)), "picked")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    # at most 2 * sample rows of two numbers
    joined = texts.join(F.broadcast(picked), "id").select("id", "text", "y", "lang")
    got = joined.mapInArrow(_gather, "id long, y int, lang string, words array<int>").toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    flat = got.column("words").combine_chunks()
    at, values = np.asarray(flat.offsets), np.asarray(flat.values)
    words = [values[a:b].reshape(-1, PARTS) for a, b in zip(at[:-1], at[1:], strict=True)]
    y = np.asarray(got.column("y")).astype(np.float64)
    model, z = _fit_folds(spark, words, y)
    langs, counts = got.column("lang").to_pylist(), np.ones(len(y))
    left = sum(total.values()) - picked.count()
    if left:
        others = rows.join(F.broadcast(picked), ["id", "y"], "left_anti")
        if left <= BROADCAST_IDS:
            texts = texts.join(F.broadcast(others.select("id").distinct()), "id", "left_semi").select("id", "text", "lang")
        sent = spark.sparkContext.broadcast(model)
        # scored before the join with the labels, so texts are not shuffled
        scored = texts.where("id is not null").mapInArrow(_log_odds(sent), "id long, lang string, bin int")
        seen = scored.join(others, "id").groupBy("lang", "y", "bin").agg(F.count("*").alias("n")).orderBy("lang", "y", "bin").toPandas()
        sent.unpersist()
        z = np.concatenate([z, (seen["bin"].to_numpy(np.float64) + 0.5) / BINS])
        y, counts = np.concatenate([y, seen["y"].to_numpy(np.float64)]), np.concatenate([counts, seen["n"].to_numpy(np.float64)])
        langs += [x if isinstance(x, str) else None for x in seen["lang"]]
    if total:
        model.share = total.get(1, 0) / sum(total.values())
    calibrate(model, z, y, langs, counts, model.share)
    scratch.drop(picked)
    return model


def _fit_folds(spark, words: list[np.ndarray], y: np.ndarray) -> tuple[Model, np.ndarray]:
    """The mean of the folds' models, each fitted in a task, and every document's log odds by the model that has not seen it."""
    sent = spark.sparkContext.broadcast((words, y))  # of the bounded sample

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                model, z = fit_fold(*sent.value, k)
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([zlib.compress(pickle.dumps(model), 1)], pa.binary()), pa.array([z.tolist()], pa.list_(pa.float64()))], ["k", "model", "z"])

    fitted = spark.range(0, FOLDS, 1, FOLDS).mapInArrow(run, "k long, model binary, z array<double>").orderBy("k").collect()
    sent.unpersist()
    fold, z = folds_of(y), np.zeros(len(y))
    for r in fitted:
        z[fold == r["k"]] = r["z"]
    return Model(table=np.zeros((0, DIM), np.float32), members=[pickle.loads(zlib.decompress(r["model"])) for r in fitted]), z


def _log_odds(sent):
    def run(batches):
        for batch in batches:
            for lo, texts in slices(batch.column(1)):
                z = np.clip(np.floor(logits(sent.value, *word_buckets(texts)).astype(np.float64) * BINS), LEAST, MOST)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), batch.column(2).slice(lo, len(texts)), pa.array(z.astype(np.int32))], ["id", "lang", "bin"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang", out: str = "toxicity", threshold_col: str = "toxicity_threshold") -> DataFrame:
    """`docs` with the columns out (probability that the whole text is toxic) and threshold_col.

    A text without words, or null, says nothing: its score is the share of toxic labels.
    A language without a threshold of its own, or null, has 0.5.  Columns of these two
    names are replaced.
    """
    docs = docs.drop(out, threshold_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: FOLDS * BUCKETS * DIM floats

    # over Arrow's own strings: no Python object is made of a text
    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        found = [np.zeros(0)]
        for _, part in slices(texts):
            buckets, rows = word_buckets(part)
            p = probability(sent.value, logits(sent.value, buckets, rows))
            p[rows[1:] == rows[:-1]] = sent.value.share
            found.append(p)
        return pa.array(np.concatenate(found))

    limit = F.lit(0.5)
    for lang, t in sorted(model.thresholds.items()):
        limit = F.when(F.col(lang_col) == lang, F.lit(t)).otherwise(limit)
    return docs.withColumn(out, toxicity(F.col(text_col).cast("string"))).withColumn(threshold_col, limit)


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`docs` without the rows whose score reaches their language's threshold; texts without words, or null, stay."""
    n = own(docs.columns, "score", "limit")
    scored = score(docs, model, text_col, lang_col, n["score"], n["limit"])
    says = F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return scored.where((F.col(n["score"]) < F.col(n["limit"])) | ~says).select(*docs.columns)


def not_held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return crc_mod(F.col(id_col), folds) != 0
