"""Embedding near-duplicates by PCA-ordered tiled comparison."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noria.llm.common import Scratch, running
from noria.llm.components import connected_components

#: Rows of a tile, and of the blocks that a pair of tiles is compared in.
TILE, BLOCK = 8192, 1024
#: Dimensions that are added at a time once the leading ones have left a pair.
STEP = 12
#: Leading axes that tiles are ordered by, and those whose ranges bound a tile or a block.
ORDER_AXES, BOX_AXES = 4, 8
#: What a pair that the leading dimensions leave costs, in leading dimensions of a pair.
LEFT_COST = 1500
#: Slack of the bounds in double precision, far over the rounding of a dot product.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Neither null nor empty, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


def _moments(dim: int):
    """Per task: sums of the unit vectors and of their products, as (place, value)."""

    def run(batches):
        total = np.zeros(dim * dim + dim + 1)
        for batch in batches:
            x = _matrix(batch.column(0), dim).astype(np.float64)
            x /= np.linalg.norm(x, axis=1)[:, None]
            total[: dim * dim] += (x.T @ x).ravel()
            total[dim * dim : -1] += x.sum(axis=0)
            total[-1] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "value"])

    return run


def principal_axes(vectors: DataFrame, dim: int) -> tuple[np.ndarray, int]:
    """Columns are the axes of falling variance, over all rows of vectors(embedding); and the row count."""
    sums = vectors.select(F.col("embedding").cast("array<double>")).mapInArrow(_moments(dim), "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(dim * dim + dim + 1)
    for place, value in sums.collect():
        total[place] = value
    n = max(total[-1], 1.0)
    mean = total[dim * dim : -1] / n
    _, axes = np.linalg.eigh(total[: dim * dim].reshape(dim, dim) / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1]), int(total[-1])


def reach(threshold: float) -> float:
    """Unit vectors of a cosine of at least the threshold are no farther apart, on every axis and in all."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK


def _placed(axes: np.ndarray, width: float):
    """+ the cell of a grid over the first axes that a row is in, and its place on the first axis."""

    def run(batches):
        base = 2 * int(np.ceil(1 / width)) + 3
        for batch in batches:
            x = _matrix(batch.column(2), len(axes)).astype(np.float64)
            y = (x @ axes[:, :ORDER_AXES]) / np.linalg.norm(x, axis=1)[:, None]
            cell = np.zeros(len(y), np.int64)
            for j in range(y.shape[1]):
                cell = cell * base + np.floor(y[:, j] / width).astype(np.int64) + base // 2
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(y[:, 0])], ["rep", "copies", "embedding", "cell", "first"])

    return run


def box_order(y: np.ndarray, most: int) -> np.ndarray:
    """Row order in which each run of `most` rows lies in a small box: halves along the widest of the leading axes."""
    out, todo = [], [np.arange(len(y))]
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            out.append(rows)
            continue
        z = y[rows, :BOX_AXES]
        half = most * -(-len(rows) // (2 * most))
        parts = np.argpartition(z[:, np.ptp(z, axis=0).argmax()], half - 1)
        todo += [rows[parts[half:]], rows[parts[:half]]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _tiles(axes: np.ndarray):
    dim = len(axes)

    def run(key, table):
        t = table.sort_by("rep")
        x = np.ascontiguousarray(_matrix(t.column("embedding").combine_chunks(), dim), dtype=np.float64)
        y = (x @ axes[:, :BOX_AXES]) / np.linalg.norm(x, axis=1)[:, None]
        order = box_order(y, BLOCK)
        x, lo, hi = x[order], y.min(axis=0), y.max(axis=0)
        x32 = x.astype(np.float32)
        blob = x32.tobytes() if np.array_equal(x32.astype(np.float64), x) else x.tobytes()
        column = lambda c: np.asarray(t.column(c))[order].tobytes()
        return pa.table({"tile": [key[0].as_py()], "lo": pa.array([lo]), "hi": pa.array([hi]), "reps": [column("rep")], "copies": [column("copies")], "data": [blob]})

    return run


class Side:
    """A tile as it is compared: its vectors, turned to the axes, and the norms of what follows each dimension."""

    def __init__(self, reps: bytes, copies: bytes, data: bytes, axes: np.ndarray):
        self.ids, self.copies = np.frombuffer(reps, np.int64), np.frombuffer(copies, np.int64)
        kind = np.float32 if len(data) == 4 * len(self.ids) * len(axes) else np.float64
        self.x = np.frombuffer(data, kind).reshape(len(self.ids), -1).astype(np.float64)
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))
        self.y = (self.x / self.norm[:, None]) @ axes
        rest = np.sqrt(np.cumsum((self.y**2)[:, ::-1], axis=1)[:, ::-1])
        self.rest = np.hstack([rest, np.zeros((len(rest), 1))])

    def leading(self, k: int) -> np.ndarray:
        """k dimensions and the norm of all that follow: a product of two such rows bounds the cosine."""
        return np.hstack([self.y[:, :k], self.rest[:, k : k + 1]])

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of each block, on the leading axes and in the norm of the rest."""
        z = self.leading(min(BOX_AXES, self.y.shape[1]))
        parts = [z[i : i + BLOCK] for i in range(0, len(z), BLOCK)]
        return np.array([p.min(axis=0) for p in parts]), np.array([p.max(axis=0) for p in parts])


def leading_dimensions(a: Side, b: Side, threshold: float) -> int:
    """How many dimensions to accumulate at first, which decides the cost only: fewer leave more pairs to go on with."""
    dim, costs = a.y.shape[1], {}
    some = lambda s, k: s.leading(k)[:: max(1, len(s.ids) // 256)]
    for k in {*range(4, dim, 4), dim}:
        costs[k] = k + LEFT_COST * float((some(a, k) @ some(b, k).T >= threshold).mean())
    return min(costs, key=lambda k: (costs[k], k))


def linked_pairs(a: Side, b: Side, threshold: float, same: bool):
    """Index pairs of two sides whose cosine is at least the threshold (i < j where both are one tile)."""
    dim, k = a.y.shape[1], leading_dimensions(a, b, threshold)
    la, lb = a.leading(k).astype(np.float32), b.leading(k).astype(np.float32)
    slack = (k + 8) * 2.0**-22 + SLACK  # over the rounding of k + 1 products of a sum below 1 in single precision
    (alo, ahi), (blo, bhi), far = a.boxes(), b.boxes(), reach(threshold) ** 2 + SLACK
    for i in range(0, len(a.ids), BLOCK):
        gap = np.maximum(0, np.maximum(alo[i // BLOCK] - bhi, blo - ahi[i // BLOCK]))
        near = (gap**2).sum(axis=1) <= far
        for j in range(i if same else 0, len(b.ids), BLOCK):
            if not near[j // BLOCK]:
                continue
            p, q = np.nonzero(la[i : i + BLOCK] @ lb[j : j + BLOCK].T >= np.float32(threshold - slack))
            p, q = p + i, q + j
            if same:
                p, q = p[p < q], q[p < q]
            # further dimensions, a few at a time, with the norms that remain
            at = k
            part = np.einsum("ij,ij->i", a.y[p, :k], b.y[q, :k]) if len(p) else np.zeros(0)
            while at < dim and len(p):
                to = min(at + STEP, dim)
                part = part + np.einsum("ij,ij->i", a.y[p, at:to], b.y[q, at:to])
                live = part + a.rest[p, to] * b.rest[q, to] >= threshold - SLACK
                p, q, part, at = p[live], q[live], part[live], to
            for lo in range(0, len(p), 1 << 16):
                r, s = p[lo : lo + (1 << 16)], q[lo : lo + (1 << 16)]
                exact = np.einsum("ij,ij->i", a.x[r], b.x[s]) / (a.norm[r] * b.norm[s])
                yield r[exact >= threshold], s[exact >= threshold]


def _compare(axes: np.ndarray, threshold: float):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                same = r["a"] == r["b"]
                a = Side(r["ra"], r["ca"], r["xa"], axes)
                b = a if same else Side(r["rb"], r["cb"], r["xb"], axes)
                m = len(a.ids)
                ids = a.ids if same else np.concatenate([a.ids, b.ids])
                links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
                for p, q in linked_pairs(a, b, threshold, same):
                    np.add.at(links, p, b.copies[q])
                    np.add.at(links, q if same else q + m, a.copies[p])
                    _join(root, p, q if same else q + m)
                hit = np.flatnonzero(links)
                if len(hit):
                    least = np.full(len(ids), np.iinfo(np.int64).max)
                    np.minimum.at(least, root[hit], ids[hit])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(links[hit]), pa.array(least[root[hit]])], ["rep", "links", "root"])

    return run


def _join(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Joins the components of p and q; root[i] stays the least index of i's component."""
    while len(p):
        rp, rq = root[p], root[q]
        apart = rp != rq
        if not apart.any():
            return
        p, q, rp, rq = p[apart], q[apart], rp[apart], rq[apart]
        np.minimum.at(root, np.maximum(rp, rq), np.minimum(rp, rq))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def embedding_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, tile: int = TILE) -> DataFrame:
    """-> (id_col, n_links, component_id, kept), one row per row of `vectors`.

    Equal vectors are one class with a count.  The classes' unit vectors are turned
    to their principal axes (moments over all rows, summed by Spark), ordered by the
    cells of a grid over the first axes, and cut into tiles of `tile` rows.  Two tiles,
    and two blocks of 1,024 rows in them, are compared unless their ranges on the leading
    axes are too far apart.  A pair's cosine is accumulated from the leading dimensions
    on, first of whole blocks in single precision (with slack over its rounding), and
    given up when what is summed plus the product of the norms of the remaining
    dimensions cannot reach the threshold; what is left is decided by the cosine of the
    vectors themselves in double precision.

    A pair of tiles returns each vector's number of links and its component within
    the two tiles, never the links themselves; components are joined by Spark.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, as do rows with a null id (component null, kept).  Vectors of different
    lengths are not compared.  Rows that share an id are counted each; their
    components meet in the id.  Only id_col and vector_col are read.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("embedding"))
    e = F.col("embedding")
    good = usable(e) & F.coalesce(F.exists(e, lambda x: x != 0), F.lit(False)) & F.col("id").isNotNull()
    keyed = rows.withColumn("good", good).withColumn("k1", F.xxhash64("embedding")).withColumn("k2", F.xxhash64("embedding", F.lit(1))).withColumn("dim", F.size("embedding"))
    classes = keyed.where("good").groupBy("k1", "k2", "dim").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding"))
    classes = scratch.cut(classes, "classes")
    found = None
    for (dim,) in sorted(classes.select("dim").distinct().collect()):
        part = classes.where(F.col("dim") == dim)
        axes, _ = principal_axes(part, dim)
        width = max(reach(threshold) / 2, 1e-3)
        placed = part.select("rep", "copies", "embedding")
        placed = placed.mapInArrow(_placed(axes, width), T.StructType([*placed.schema.fields, T.StructField("cell", T.LongType()), T.StructField("first", T.DoubleType())]))
        ranked = running(placed.withColumn("one", F.lit(1).cast("long")), ["cell", "first", "rep"], "one", scratch, "ranked")
        tiles = ranked.withColumn("tile", F.floor(F.col("run") / tile)).select("tile", "rep", "copies", "embedding")
        tiles = scratch.cut(tiles.groupBy("tile").applyInArrow(_tiles(axes), "tile long, lo array<double>, hi array<double>, reps binary, copies binary, data binary"), "tiles")
        span = reach(threshold)
        cell = lambda x: F.floor(x[0] / span)
        spans = tiles.select("tile", "lo", "hi")
        left = spans.select(F.col("tile").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"), F.explode(F.sequence(cell(F.col("lo")) - 1, cell(F.col("hi")) + 1)).alias("cell"))
        right = spans.select(F.col("tile").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))).alias("cell"))
        gap = lambda x, y: F.zip_with(x, y, lambda u, v: F.greatest(u - v, F.lit(0.0)))
        apart = F.aggregate(F.zip_with(gap("alo", "bhi"), gap("blo", "ahi"), lambda u, v: u * u + v * v), F.lit(0.0), lambda x, y: x + y)
        pairs = left.join(right, "cell").where((F.col("a") <= F.col("b")) & (apart <= span * span + SLACK)).select("a", "b").distinct()
        side = lambda x: tiles.select(F.col("tile").alias(x), F.col("reps").alias("r" + x), F.col("copies").alias("c" + x), F.col("data").alias("x" + x))
        some = pairs.join(side("a"), "a").join(side("b"), "b").repartition(F.xxhash64("a", "b"))
        # one pair of tiles at a time reaches a worker's memory
        out = some.mapInArrow(_compare(axes, threshold), "rep long, links long, root long")
        found = out if found is None else found.unionAll(out)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = scratch.cut(found, "links")
    comp = scratch.cut(connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch), "components")
    per = classes.select("k1", "k2", "dim", "rep", "copies").join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    per = per.select("k1", "k2", "dim", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("comp", "rep").alias("component_id"))
    slim = keyed.select("id", "good", "k1", "k2", "dim")
    linked = slim.where("good").join(per, ["k1", "k2", "dim"]).select("id", "n_links", "component_id")
    rest = slim.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(rest).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
