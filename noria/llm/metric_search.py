"""Exact top-k search by inner product in M-trees."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noria.llm.common import Scratch
from noria.llm.embedding_dedup import usable

#: Rows of a tree, entries of a node, queries of a block, trees that a block meets in one task.
SHARD, PAGE, QUERIES, RUN = 8192, 256, 1024, 16


class MTree:
    """A paged M-tree over integer vectors with Euclidean distances.

    Nodes stand in arrays.  Node i has a routing object, a covering radius, the
    distance of its routing object to its parent's, the greatest norm below it, and
    either children first[i]:last[i] or, in a leaf, items first[i]:last[i].  Each
    item has its distance to its leaf's routing object.
    """

    FIELDS = ("center", "radius", "parent", "norm", "first", "last", "leaf", "items", "ids", "item_parent", "item_norm")

    def __init__(self, ids: np.ndarray, x: np.ndarray, page: int = PAGE):
        x = x.astype(np.float64)
        norms = np.sqrt(np.einsum("ij,ij->i", x, x))
        rng = np.random.default_rng(11)
        order, far = [], []
        node: dict[str, list] = {k: [] for k in ("center", "radius", "parent", "norm", "first", "last", "leaf")}

        def new(rows, center, dist, parent):
            for k, v in (("center", center), ("radius", dist.max()), ("parent", parent), ("norm", norms[rows].max()), ("first", 0), ("last", 0), ("leaf", False)):
                node[k].append(v)
            return len(node["leaf"]) - 1

        rows = np.arange(len(ids))
        mean = np.rint(x.mean(axis=0))
        dist = np.linalg.norm(x - mean, axis=1)
        todo = [(new(rows, mean, dist, 0.0), rows, dist)]
        while todo:
            i, rows, dist = todo.pop()
            if len(rows) <= page:
                node["leaf"][i], node["first"][i], node["last"][i] = True, len(order), len(order) + len(rows)
                order.extend(rows)
                far.extend(dist)
                continue
            picked = rng.choice(rows, min(page, -(-len(rows) // page)) if len(rows) > page * 2 else 2, replace=False)
            d2 = norms[rows][:, None] ** 2 + norms[picked][None] ** 2 - 2 * (x[rows] @ x[picked].T)
            own = d2.argmin(axis=1)
            if (own == own[0]).all():  # copies: nothing to tell them apart by
                own = np.arange(len(rows)) * len(picked) // len(rows)
            groups = [(picked[g], rows[own == g]) for g in range(len(picked)) if (own == g).any()]
            node["first"][i] = len(node["leaf"])
            made = []
            for c, members in groups:
                d = np.linalg.norm(x[members] - x[c], axis=1)
                made.append((new(members, x[c], d, float(np.linalg.norm(x[c] - node["center"][i]))), members, d))
            node["last"][i] = len(node["leaf"])
            todo += made
        for k, v in node.items():
            setattr(self, k, np.array(v))
        order = np.array(order, dtype=np.int64)
        self.items, self.ids, self.item_parent, self.item_norm = x[order], ids[order], np.array(far), norms[order]

    def dump(self) -> list[bytes]:
        most = max(np.abs(self.items).max(), np.abs(self.center).max())
        exact = {"items": np.int16, "center": np.int16} if most < 2**15 else {"items": np.int32, "center": np.int32} if most < 2**31 else {}
        kinds = [exact.get(f, getattr(self, f).dtype) for f in self.FIELDS]
        return [np.dtype(k).str.encode() + b":" + getattr(self, f).astype(k).tobytes() for f, k in zip(self.FIELDS, kinds, strict=True)]

    @classmethod
    def load(cls, parts: list[bytes], dim: int) -> MTree:
        tree = cls.__new__(cls)
        for f, part in zip(cls.FIELDS, parts, strict=True):
            kind, _, data = part.partition(b":")
            x = np.frombuffer(data, np.dtype(kind.decode()))
            setattr(tree, f, x.reshape(-1, dim).astype(np.float64) if f in ("items", "center") else x)
        tree.largest = float(np.abs(tree.items).max())
        tree.center_norm = np.einsum("ij,ij->i", tree.center, tree.center)
        return tree

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k best by (score desc, id), without the id `own`."""
        best = Best(1, k)
        self.search_block(query.reshape(1, -1), np.array([own]), best)
        return best.ids[: best.n[0]], best.scores[: best.n[0]]

    def search_block(self, queries: np.ndarray, own: np.ndarray, best: Best) -> None:
        """Adds what this tree holds to the queries' best; best node first, for all queries together.

        A node is entered by the queries that its bound does not rule out, and their
        products with a leaf's items are one matrix product.  Queries that have found k
        elsewhere already come with that bound.
        """
        q = queries.astype(np.float64)
        qq = np.einsum("ij,ij->i", q, q)
        qn = np.sqrt(qq)
        slack = 1e-6 * (1 + qq)
        # single precision is exact as long as every sum of products is below 2**24
        kind = np.float32 if float(np.abs(q).max()) * self.largest * q.shape[1] < 2**24 else np.float64
        exact, items = q.astype(kind), self.items.astype(kind)
        # q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2, and d(q, x) >= d(q, center) - radius
        bound = lambda live, near, norm: np.minimum((qq[live] + norm**2 - np.maximum(near, 0.0) ** 2) / 2, qn[live] * norm) + slack[live]
        d0 = np.sqrt(((q - self.center[0]) ** 2).sum(axis=1))
        every = np.arange(len(q))
        first = bound(every, d0 - self.radius[0], self.norm[0])
        heap = [(-float(first.max()), 0, every, d0, first)]
        while heap:
            _, i, live, d, b = heapq.heappop(heap)
            on = b >= best.least[live]
            live, d = live[on], d[on]
            if not len(live):
                continue
            lo, hi = self.first[i], self.last[i]
            if self.leaf[i]:
                # the stored distances to the routing object bound the items' scores before they are computed
                off = np.maximum(np.maximum(d.min() - self.item_parent[lo:hi], self.item_parent[lo:hi] - d.max()), 0.0)
                reach = np.minimum((qq[live].max() + self.item_norm[lo:hi] ** 2 - off**2) / 2, qn[live].max() * self.item_norm[lo:hi]) + slack[live].max()
                near = np.flatnonzero(reach >= best.least[live].min()) + lo
                if len(near):
                    best.add(live, self.ids[near], exact[live] @ items[near].T, own)
                continue
            c, cn = self.center[lo:hi], self.center_norm[lo:hi]
            dist = np.sqrt(np.maximum(qq[live][:, None] + cn[None] - 2 * (q[live] @ c.T), 0.0))
            for j in range(hi - lo):
                bj = bound(live, dist[:, j] - self.radius[lo + j], self.norm[lo + j])
                some = bj >= best.least[live]
                if some.any():
                    heapq.heappush(heap, (-float(bj.max()), int(lo + j), live[some], dist[some, j], bj[some]))


class Best:
    """The k best of many queries by (score desc, id), of all that was added."""

    def __init__(self, queries: int, k: int):
        self.k, self.n = k, np.zeros(queries, np.int64)
        self.ids, self.scores = np.zeros(queries * k, np.int64), np.zeros(queries * k)
        self.least = np.full(queries, -np.inf)

    def add(self, live: np.ndarray, ids: np.ndarray, scores: np.ndarray, own: np.ndarray) -> None:
        """scores: the queries `live` times ids, each id once in all calls; own: the id that each query leaves out."""
        k = self.k
        if scores.shape[1] > 4 * k and np.isneginf(self.least[live]).any():
            # a query takes part with its k + 1 highest and their equals only: one may be its own
            cut = np.partition(scores, scores.shape[1] - k - 1, axis=1)[:, -k - 1]
            row, col = np.nonzero(scores >= np.maximum(cut, self.least[live])[:, None])
        else:
            row, col = np.nonzero(scores >= self.least[live][:, None])
        other = ids[col] != own[live[row]]
        row, col = row[other], col[other]
        if not len(row):
            return
        hit = np.unique(row)
        owner, place = live[hit], np.repeat(live[hit] * k, self.n[live[hit]])
        place = place + np.arange(len(place)) - np.repeat(np.cumsum(self.n[owner]) - self.n[owner], self.n[owner])
        who = np.concatenate([np.repeat(owner, self.n[owner]), live[row]])
        s, i = np.concatenate([self.scores[place], scores[row, col].astype(np.float64)]), np.concatenate([self.ids[place], ids[col]])
        order = np.lexsort((i, -s, who))
        who, s, i = who[order], s[order], i[order]
        start = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        rank = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who))))
        top = rank < k
        who, rank = who[top], rank[top]
        self.ids[who * k + rank], self.scores[who * k + rank] = i[top], s[top]
        np.maximum.at(self.n, who, rank + 1)
        full = who[rank == k - 1]
        self.least[full] = self.scores[full * k + k - 1]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id, score), one after the other."""
        at = np.arange(len(self.ids)).reshape(-1, self.k)
        at = at[np.arange(self.k)[None] < self.n[:, None]]
        return at // self.k, self.ids[at], self.scores[at]


def _integers(column: pa.ChunkedArray | pa.Array, dim: int, scale: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.floor(np.asarray(column.flatten()).astype(np.float64) * scale).reshape(-1, dim)
    if len(x) and float(np.abs(x).max()) ** 2 * dim >= 2**53:
        raise ValueError("components are too large for exact scores")
    return x


def _build(scale: int):
    def run(key, table):
        dim = key[0].as_py()
        t = table.sort_by("id")
        x, ids = _integers(t.column("v"), dim, scale), np.asarray(t.column("id"))
        order = np.lexsort((*x.T[::-1], ids))
        x, ids = x[order], ids[order]
        once = np.append(True, ids[1:] != ids[:-1])
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()), "tree": pa.array([MTree(ids[once], x[once]).dump()], pa.list_(pa.binary()))})

    return run


def _block(scale: int):
    def run(key, table):
        dim = key[0].as_py()
        t = table.sort_by("id")
        x, ids = _integers(t.column("v"), dim, scale), np.asarray(t.column("id"))
        order = np.lexsort((*x.T[::-1], ids))
        x, ids = x[order], ids[order]
        once = np.append(True, ids[1:] != ids[:-1])
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "ids": pa.array([ids[once].tobytes()]), "qs": pa.array([x[once].tobytes()])})

    return run


def _search(k: int):
    """One part of the queries against a run of trees, one tree after the other: what is found bounds what is looked for."""

    def run(key, table):
        dim = key[0].as_py()
        asked, trees = table.filter(pc.is_valid(table.column("ids"))), table.filter(pc.is_valid(table.column("tree")))
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(asked) and len(trees):
            own = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in asked.column("ids")])
            qs = np.concatenate([np.frombuffer(x.as_py(), np.float64) for x in asked.column("qs")]).reshape(-1, dim)
            best = Best(len(own), k)
            for tree in trees.column("tree"):
                MTree.load(tree.as_py(), dim).search_block(qs, own, best)
            at, ids, scores = best.rows()
            out = {"query_id": own[at], "vec_id": ids, "score": scores.astype(np.int64)}
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, shard_rows: int = SHARD) -> DataFrame:
    """-> (query_id, rank, vec_id, score): each query's k highest inner products, ties to the smaller id.

    A component x counts as floor(scale * x).  Rows are dealt by a hash of their id to
    shards of about shard_rows; each shard's M-tree is built once and written to the
    shared folder.  A task holds a block of queries and meets RUN trees with it, one after
    the other, each best node first: a node's radius and the distances stored at it bound
    what is below, and nodes and items that these rule out for every query are not
    computed.  The rest is a matrix product of the queries that enter a leaf, and what one
    tree gave bounds the next.  A run gives k rows a query.

    Vectors that are null, empty or hold null or non-finite components, and rows with
    a null id, take no part; vectors of different lengths do not meet.  The id is a
    key: of rows that share it the least vector takes part, and a query never finds its
    own id.  If there are fewer than k other rows, all are returned.  Components of
    which a sum of products passes 2**53 are refused.  Only id_col and vector_col are
    read, besides what is_query names.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q"))
    rows = scratch.cut(rows.where(usable(F.col("v")) & F.col("id").isNotNull()).withColumn("dim", F.size("v")), "vectors")
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    dealt = rows.select("dim", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "id", "v")
    trees = scratch.cut(dealt.groupBy("dim", "shard").applyInArrow(_build(scale), "dim int, shard int, tree array<binary>"), "trees")
    asked = rows.where("q")
    blocks = max(1, -(-asked.count() // QUERIES))
    asked = asked.select("dim", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), "id", "v")
    asked = scratch.cut(asked.groupBy("dim", "block").applyInArrow(_block(scale), "dim int, block int, ids binary, qs binary"), "queries")
    runs = -(-shards // RUN)
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    every = trees.select("dim", F.pmod("shard", F.lit(runs)).alias("run"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "tree", none("ids", "binary"), none("qs", "binary"))
    every = every.unionByName(asked.select("dim", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"), "block", none("tree", "array<binary>"), "ids", "qs"))
    found = every.groupBy("dim", "run", "block").applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
