"""Language-model scores by a log-bilinear neural model trained with noise-contrastive estimation."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noria.llm.common import Scratch, crc_mod, longs, slices, word_hashes

#: Words that are classes of their own; the others are dealt into groups of equal mass.
SHORTLIST, GROUPS = 1023, 512
#: Words with an output vector of their own: HEAD[0] times the root of the number of distinct words, within the other two.
#: Their counts and vectors are broadcast, 80 bytes each; the others' counts are joined, and they share a sixteenth as many vectors.
HEAD = (64, 1 << 16, 1 << 18)
SHARED = 16
DIM, MINIBATCH, NOISE, ROUNDS, RATE = 16, 2048, 32, 2, 0.08
#: Within a group: noise words a step, tokens of a group in a step, and the learning rate.
GROUP_NOISE, GROUP_STEP, GROUP_RATE = 8, 32, 0.05
#: Tokens that a copy is trained on, at least on average: smaller partitions are put together, so that copies stay few.
COPY_TOKENS = 1 << 20
#: The end token's key.
END = np.uint64(0xE0D0E0D0E0D0E0D1)
ALPHA = 0.1


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of each text and an end after each; and the first token of each text (one more at the end)."""
    h, rows = word_hashes(texts)
    n = len(rows) - 1
    ends = rows[1:] + np.arange(n)
    out = np.empty(len(h) + n, np.uint64)
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[is_end], out[~is_end] = END, h
    return out, rows + np.arange(n + 1)


def _counts(batches):
    held, size = [], 0

    def merged(parts):
        k, c = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        u, back = np.unique(k, return_inverse=True)
        return u, np.bincount(back, weights=c, minlength=len(u)).astype(np.int64)

    def rows(k, c):
        for lo in range(0, len(k), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(k[lo : lo + (1 << 17)].view(np.int64)), pa.array(c[lo : lo + (1 << 17)])], ["h", "c"])

    for batch in batches:
        for _, texts in slices(batch.column(0)):  # as in every other pass: larger ones leave a worker larger tables of powers
            held.append(np.unique(tokens(texts)[0], return_counts=True))
            size += len(held[-1][0])
            if size > 1 << 21:
                held = [merged(held)]
                size = len(held[0][0])
                if size > 1 << 20:  # hand on what has been counted; the shuffle adds it up
                    yield from rows(*held.pop())
                    size = 0
    if held:
        yield from rows(*merged(held))


class Classes:
    """Token key -> class and row: the shortlist's classes by rank, then the groups; a group is a range of rows.

    Rows are the head's other words by rank, then `shared` ones for the hashes of all words
    outside the head.  Groups are cut at equal mass: of many rare rows, or few frequent ones.
    """

    def __init__(self, head: list[tuple[int, int]], shortlist: int, shared: np.ndarray):
        keys = np.array([k for k, _ in head], np.int64).view(np.uint64)
        order = np.argsort(keys)
        by_rank = np.array([c for _, c in head], np.int64)
        self.keys, self.rank, self.count = keys[order], order.astype(np.int32), by_rank[order]
        self.k = min(shortlist, len(head))
        self.own, self.shared = len(head) - self.k, shared
        self.mass = np.append(by_rank[self.k :], shared).astype(np.float64)
        before = np.cumsum(self.mass) - self.mass
        _, first, group = np.unique((before / self.mass.sum() * GROUPS).astype(np.int64), return_index=True, return_inverse=True)
        self.bounds, self.group = np.append(first, len(self.mass)).astype(np.int64), group.astype(np.int32)
        self.start = self.k + len(first)
        self.noise = np.append(by_rank[: self.k], np.add.reduceat(self.mass, first))
        self.log_share = np.log(self.mass / self.noise[self.k :][group]).astype(np.float32)

    def look_up(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, row and count of each token; the row is -1 in the shortlist, the count where the head lacks it."""
        u, back = np.unique(t, return_inverse=True)
        row, count = self.own + (u & np.uint64(len(self.shared) - 1)).astype(np.int64), np.full(len(u), -1)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, u), len(self.keys) - 1)
            hit = self.keys[at] == u
            row, count = np.where(hit, self.rank[at] - self.k, row), np.where(hit, self.count[at], -1)
        cls = np.where(row < 0, row + self.k, self.k + self.group[np.maximum(row, 0)]).astype(np.int32)
        return cls[back], np.maximum(row, -1)[back], count[back]

    def contexts(self, cls: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes one and two tokens before, `start` where a text has none."""
        one, two = np.full(len(cls), self.start, np.int32), np.full(len(cls), self.start, np.int32)
        one[1:], two[2:] = cls[:-1], cls[:-2]
        first = rows[:-1][np.diff(rows) > 0]
        one[first] = two[first] = self.start
        second = first[first + 1 < len(cls)] + 1
        two[second] = self.start
        return one, two


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class LogBilinear:
    """s(class | u, v) = h . q[class] + b[class], with h = r[u] * c1 + r[v] * c2 of the two classes before.

    Within a group, s(row | u, v) = h . rows[row] + ln of the row's share of the group's mass.
    """

    def __init__(self, noise: np.ndarray, rows: int = 0, seed: int = 1):
        rng = np.random.default_rng(seed)
        n = len(noise)
        self.noise = noise
        self.flat = np.concatenate([rng.normal(0, 0.1, (n + 1) * DIM), np.ones(DIM), np.full(DIM, 0.5), rng.normal(0, 0.1, n * DIM), np.log(noise), np.zeros(rows * DIM)]).astype(np.float32)
        self._view()

    def _view(self):
        n = len(self.noise)
        cut = np.cumsum([(n + 1) * DIM, DIM, DIM, n * DIM, n])
        r, self.c1, self.c2, q, self.b, rows = np.split(self.flat, cut)
        self.r, self.q, self.rows = r.reshape(-1, DIM), q.reshape(-1, DIM), rows.reshape(-1, DIM)

    def with_parameters(self, flat: np.ndarray) -> LogBilinear:
        out = LogBilinear.__new__(LogBilinear)
        out.noise, out.flat = self.noise, flat.astype(np.float32).copy()
        out._view()
        return out

    def train(self, batches, seed: int, rate: float) -> int:
        """Noise-contrastive steps with Adagrad over (target, one before, two before); returns the tokens seen."""
        rng = np.random.default_rng(seed)
        cum, log_kn = np.cumsum(self.noise), np.log(NOISE * self.noise).astype(np.float32)
        g = {k: np.full(getattr(self, k).shape, 1e-4, np.float32) for k in ("r", "q", "b", "c1", "c2")}
        seen = 0

        kind = np.uint16 if len(self.noise) < 1 << 16 else np.int32  # small integers are sorted by radix

        def sparse(ids, *grads):
            """Adds the gradients (name, rows) of repeated ids up, which are sorted once for all of them."""
            ids = ids.astype(kind)
            order = np.argsort(ids, kind="stable")
            s = ids[order]
            at = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            rows = s[at]
            for name, grad in grads:
                total = np.add.reduceat(grad.take(order, axis=0), at, axis=0)
                squares = g[name].take(rows, axis=0) + total**2
                g[name][rows] = squares
                getattr(self, name)[rows] -= rate * total / np.sqrt(squares)

        def dense(name, total):
            g[name] += total**2
            getattr(self, name)[:] -= rate * total / np.sqrt(g[name])

        for w, u, v in batches:
            seen += len(w)
            z = np.minimum(np.searchsorted(cum, rng.random(NOISE) * cum[-1]), len(cum) - 1)
            ru, rv = self.r.take(u, axis=0), self.r.take(v, axis=0)  # take: rows are gathered in a third of the time that indexing needs
            h = ru * self.c1 + rv * self.c2
            qw, qz = self.q.take(w, axis=0), self.q.take(z, axis=0)
            pos = np.einsum("ij,ij->i", h, qw) + self.b[w] - log_kn[w]
            dp = (_sigmoid(pos) - 1) / np.float32(len(w))
            dn = _sigmoid(h @ qz.T + (self.b[z] - log_kn[z]))
            dn /= np.float32(len(w))
            dh = dp[:, None] * qw + dn @ qz
            sparse(np.concatenate([w, z]), ("q", np.concatenate([dp[:, None] * h, dn.T @ h])), ("b", np.concatenate([dp, dn.sum(axis=0)])))
            sparse(np.concatenate([u, v]), ("r", np.concatenate([dh * self.c1, dh * self.c2])))
            dense("c1", np.einsum("ij,ij->j", dh, ru))
            dense("c2", np.einsum("ij,ij->j", dh, rv))
        return seen

    def train_rows(self, batches, classes: Classes, seed: int, rate: float):
        """Noise-contrastive steps for the rows of every group at once; then hands each batch on, without its rows, in minibatches.

        A step takes at most GROUP_STEP tokens of each group, against GROUP_NOISE rows that
        are drawn from the group by mass.
        """
        rng = np.random.default_rng(seed)
        cum = np.append(0.0, np.cumsum(classes.mass))
        g = np.ones(self.rows.shape, np.float32)
        log_k = np.float32(math.log(GROUP_NOISE))
        for w, u, v, row in batches:
            tail = np.flatnonzero(row >= 0)
            group = (w[tail] - classes.k).astype(np.uint16 if classes.start < 1 << 16 else np.int32)
            order = np.argsort(group, kind="stable")
            tail, group = tail[order], group[order].astype(np.int64)
            at = np.arange(len(tail)) - np.searchsorted(group, group)
            for lo in range(0, int(at.max(initial=-1)) + 1, GROUP_STEP):
                now = np.flatnonzero((at >= lo) & (at < lo + GROUP_STEP))
                t, mine = tail[now], group[now]
                new = np.append(True, mine[1:] != mine[:-1])
                gs, place = mine[new], np.cumsum(new) - 1
                low, high = cum[classes.bounds[gs]], cum[classes.bounds[gs + 1]]
                z = np.searchsorted(cum, low[:, None] + rng.random((len(gs), GROUP_NOISE)) * (high - low)[:, None], side="right") - 1
                z = np.clip(z, classes.bounds[gs][:, None], classes.bounds[gs + 1][:, None] - 1)
                h = np.zeros((len(gs), int(at[now].max()) - lo + 1, DIM), np.float32)
                inside = (place, at[now] - lo)
                own = self.r.take(u[t], axis=0) * self.c1 + self.r.take(v[t], axis=0) * self.c2
                h[inside] = own
                real = np.zeros(h.shape[:2], bool)
                real[inside] = True
                qw, qz = self.rows.take(row[t], axis=0), self.rows.take(z, axis=0)
                dp = _sigmoid(np.einsum("ij,ij->i", own, qw) - log_k) - 1
                dn = _sigmoid(h @ qz.transpose(0, 2, 1) - log_k) * real[:, :, None]
                grad = np.concatenate([dp[:, None] * own, (dn.transpose(0, 2, 1) @ h).reshape(-1, DIM)])
                ids = np.append(row[t], z)
                order = np.argsort(ids, kind="stable")
                ids = ids[order]
                first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
                rows, total = ids[first], np.add.reduceat(grad.take(order, axis=0), first, axis=0)
                squares = g.take(rows, axis=0) + total**2
                g[rows] = squares
                self.rows[rows] -= rate * total / np.sqrt(squares)
            for lo in range(0, len(w), MINIBATCH):
                yield w[lo : lo + MINIBATCH], u[lo : lo + MINIBATCH], v[lo : lo + MINIBATCH]

    def row_logs(self, h: np.ndarray, cls: np.ndarray, row: np.ndarray, classes: Classes) -> np.ndarray:
        """ln of each token's row within its group, normalised over the group's rows by matrix products; 0 in the shortlist."""
        out = np.zeros(len(row), np.float64)
        tail = np.flatnonzero(row >= 0)
        tail = tail[np.argsort(cls[tail], kind="stable")]
        cuts = np.searchsorted(cls[tail], np.arange(classes.k, classes.start + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            lo, hi = classes.bounds[i : i + 2]
            q, share = self.rows[lo:hi].T, classes.log_share[lo:hi]
            step = max(1, (1 << 16) // int(hi - lo))
            for j in range(cuts[i], cuts[i + 1], step):
                t = tail[j : min(j + step, cuts[i + 1])]
                s = h.take(t, axis=0) @ q
                s += share
                s -= s.max(axis=1, keepdims=True)
                own = s[np.arange(len(t)), row[t] - lo]
                out[t] = own - np.log(np.exp(s, out=s).sum(axis=1))
        return out

    def log_norms(self) -> np.ndarray:
        """ln of the sum over all classes, for every pair of contexts: one matrix product of the two contexts' factors."""
        factors, tops = [], 0.0
        for x, axis in ((self.r * self.c1 @ self.q.T, 1), (self.r * self.c2 @ self.q.T + self.b, 0)):
            top = x.max(axis=1, keepdims=True).astype(np.float64)
            factors.append(np.exp(x - top))
            tops = tops + (top if axis else top.T)
        return (np.log(factors[0] @ factors[1].T + np.finfo(np.float64).tiny) + tops).astype(np.float32)


def _trained(model, classes, seed: int, rate: float):
    def run(batches):
        m, c = model.value, classes.value
        local = m.with_parameters(m.flat)

        def steps():
            held = []
            for batch in batches:
                for _, texts in slices(batch.column(0)):
                    t, rows = tokens(texts)
                    cls, row, _ = c.look_up(t)
                    held.append(np.stack([cls, *c.contexts(cls, rows), row]))
                    if sum(x.shape[1] for x in held) >= 1 << 16:
                        yield shuffled(np.hstack(held))
                        held = []
            if held:
                yield shuffled(np.hstack(held))

        def shuffled(x):
            return x[:, np.random.default_rng(seed).permutation(x.shape[1])]

        own = seed + TaskContext.get().partitionId()
        n = local.train(local.train_rows(steps(), c, own, GROUP_RATE), own, rate)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([local.flat.tobytes()])], ["n", "flat"])

    return run


def _scored(classes, model, vectors):
    log10 = 1 / math.log(10)

    def run(batches):
        c, m = classes.value, model.value
        a, b2, norms = vectors.value
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, texts in slices(batch.column(1)):
                t, rows = tokens(texts)
                cls, row, count = c.look_up(t)
                one, two = c.contexts(cls, rows)
                h = a.take(one, axis=0) + b2.take(two, axis=0)
                s = np.einsum("ij,ij->i", h, m.q.take(cls, axis=0)) + m.b[cls] - norms[one, two] + m.row_logs(h, cls, row, c)
                shares = row >= c.own
                s[shares] -= np.log(c.mass[row[shares]])
                known = count >= 0
                logc = np.log10(np.where(known, count, 1) + ALPHA) * known
                first = rows[:-1]
                sums = [np.add.reduceat(x, first) for x in (s * log10, logc, known.astype(np.int64))]
                tail = [t[i:j][~known[i:j]] for i, j in zip(rows[:-1], rows[1:], strict=True)]
                n = len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + n)), batch.column(0).slice(lo, n), pa.array(np.diff(rows)), *map(pa.array, sums), longs(tail)], ["uid", "id", "n_tokens", "lm", "head_log", "known", "tail"])
                uid += n

    return run


def lm_scores(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", shortlist: int = SHORTLIST, head: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """-> (id_col, n_tokens, n_known, train_tokens, base_score, score), one row per row of `docs`.

    Tokens are the words of the whole text (A-Z lower-cased) and one end.  c, N and V
    are counted over all rows for which `learn` holds; base_score is the add-0.1
    unigram's log10 probability.

    score is the log-bilinear model's: p(class) * p(row in the class) * p(token in the row).
    The `shortlist` most frequent tokens are classes of their own.  The other tokens of the
    `head` most frequent ones have rows of their own, and all the rest share rows by their
    hash, a sixteenth as many; GROUPS classes are ranges of those rows.  Both softmaxes are
    normalised exactly.  In a shared row of c', V' a token has (c + 0.1) / (c' + 0.1 (V' + 1)),
    so probabilities over all words add up to 1.  head: by default it grows with the root
    of V (HEAD).
    Every task trains a copy on all its training texts by noise-contrastive estimation;
    the copies are averaged by their tokens in a tree, `rounds` times.  Normalisers are
    a table over pairs of contexts, made by matrix products once.

    The counts of the `head` most frequent tokens are broadcast (a fixed size), which
    takes the frequent keys out of the join that the remaining tokens make with their
    counts.

    Nulls: a null text is empty, one end; a null id is kept.  Repeated rows are scored
    each.  Without training rows N and V are 0.  Only id_col and text_col are read,
    besides what `learn` names.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    sc = spark.sparkContext
    learn = F.coalesce(crc_mod(F.col(id_col), 10) != 0, F.lit(False)) if learn is None else learn
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    training = docs.where(learn).select(text)
    counts = scratch.cut(training.mapInArrow(_counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    if head is None:
        head = min(max(int(HEAD[0] * math.sqrt(v)), HEAD[1]), HEAD[2])
    top = [tuple(r) for r in counts.orderBy(F.desc("c"), "h").limit(head).collect()]
    slots = 1 << max(0, (head // SHARED).bit_length() - 1)
    shared = np.zeros((slots, 2), np.int64)
    for slot, c, kinds in counts.groupBy(F.col("h").bitwiseAND(F.lit(slots - 1)).alias("slot")).agg(F.sum("c"), F.count("*")).collect():
        shared[slot] = c, kinds
    owned = np.array(top, np.int64).reshape(-1, 2)
    np.subtract.at(shared, owned[:, 0] & (slots - 1), np.stack([owned[:, 1], np.ones(len(owned), np.int64)], axis=1))
    classes = Classes(top, shortlist, shared[:, 0] + ALPHA * (shared[:, 1] + 1))
    model = LogBilinear(classes.noise / classes.noise.sum(), len(classes.mass))
    sent = sc.broadcast(classes)
    copies = max(sc.defaultParallelism, -(-n // COPY_TOKENS))
    few = copies if copies < training.rdd.getNumPartitions() else None
    for i in range(rounds if n else 0):
        now = sc.broadcast(model)
        parts = (training if few is None else training.coalesce(few)).mapInArrow(_trained(now, sent, 100 * i, RATE / (1 + i)), "n long, flat binary").rdd
        zero = (0, np.float32(0))
        total, flat = parts.treeAggregate(zero, lambda acc, r: (acc[0] + r["n"], acc[1] + np.float32(r["n"] / n) * np.frombuffer(r["flat"], np.float32)), lambda x, y: (x[0] + y[0], x[1] + y[1]), 3)
        if total:
            model = model.with_parameters(flat * np.float32(n / total))
    vectors = sc.broadcast((model.r * model.c1, model.r * model.c2, model.log_norms()))
    fitted = sc.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), text)
    fields = f"uid long, id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, lm double, head_log double, known long, tail array<long>"
    scored = scratch.cut(rows.mapInArrow(_scored(sent, fitted, vectors), fields), "scored")
    tail = scored.select("uid", F.explode("tail").alias("h")).join(counts, "h", "left")
    tail = tail.groupBy("uid").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(ALPHA))).alias("tail_log"), F.count("c").alias("tail_known"))
    every = scored.drop("tail").join(tail, "uid", "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    base = F.col("head_log") + tail_log - F.col("n_tokens") * math.log10(n + ALPHA * (v + 1))
    full = F.col("lm") + tail_log
    return every.select(F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), full.alias("score"))
