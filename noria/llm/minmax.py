"""Near-duplicate documents by min-max hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noria.llm.common import Scratch, longs, mix, own, running, shingle_sets, slices
from noria.llm.components import connected_components

#: Permutations; each gives its minimum and its maximum, so a signature has twice as many values.
PERMUTATIONS = 144
#: Permutations of a band: at a similarity s, a band agrees with a chance of about s ** (2 * BAND).
BAND = 3
#: Shingles of a block in which what is still apart is compared exactly, and columns of a matrix product.
BLOCK_ITEMS, COLUMNS = 1 << 17, 4096
#: Bytes of text that a worker hashes at once.
SLICE = 1 << 19

_RNG = np.random.default_rng(7)
_A = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)


def band_keys(sets: list[np.ndarray], permutations: int = PERMUTATIONS, band: int = BAND) -> np.ndarray:
    """One row of band keys per non-empty set."""
    values = np.concatenate(sets)
    at = np.zeros(len(sets), dtype=np.int64)
    np.cumsum([len(x) for x in sets[:-1]], out=at[1:])
    keys = np.zeros((len(sets), permutations // band), dtype=np.uint64)
    for k in range(permutations):
        moved = values * _A[k] + _B[k]
        j = k // band
        for extreme in (np.minimum.reduceat(moved, at), np.maximum.reduceat(moved, at)):
            keys[:, j] = mix(keys[:, j] * np.uint64(0x9E3779B97F4A7C15) + extreme + np.uint64(j + 1))
    return keys


def _sketches(shingle: int):
    def run(batches):
        for batch in batches:
            for lo, texts in slices(batch.column(1), SLICE):
                sets = shingle_sets(texts, shingle)
                full = [x for x in sets if len(x)]
                keys = iter(band_keys(full)) if full else iter(())
                bands = [next(keys) if len(x) else x for x in sets]
                sums = np.array([(x.sum(dtype=np.uint64), mix(x + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) for x in sets], dtype=np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), pa.array([len(x) for x in sets], pa.int64()), pa.array(sums[:, 0]), pa.array(sums[:, 1]), longs(bands)], ["id", "n", "d1", "d2", "bands"])

    return run


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            for lo, texts in slices(batch.column(1), SLICE):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), longs(shingle_sets(texts, shingle))], ["id", "items"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """-> (id_col, n_shingles, component_id, kept), one row per row of `docs`.

    Documents are linked when 100 * |A & B| >= percent * |A | B| for their sets of
    `shingle`-word shingles (A-Z lower-cased; words are `[^\\x20\\x09-\\x0D]+`).

    1. Equal sets are one class from then on, represented by their smallest id, so
       a group of copies of any size costs an aggregate.
    2. Each class has a min-max signature: the least and the greatest value under
       each of 144 permutations, banded by six values.  At a similarity of 0.85 all
       48 bands disagree with a chance of 1e-10, at 0.8 of 5e-7.
    3. Classes that share a band are candidates.  Each is first tried against the
       most central member (the one with most companions over all bands) it shares
       most bands with; what full sets confirm is joined into components.
    4. Buckets whose members are in different components still are joined into
       clusters, and these compared in full in blocks of bounded size: intersections
       are counted by matrix products over the shingles that occur twice, and only a
       spanning forest of the confirmed links leaves a pair of blocks.  Blocks that
       lie in a cluster's largest component are not compared with each other.  So no
       link is lost and no group is expanded into all its pairs.

    Nulls: a null text is an empty set and linked with nothing; a row with a null id
    is returned unlinked, with a null component, and kept.  Rows that share an id are
    one document: linked when any of their texts are.  Only id_col and text_col are
    read, so other columns of any name do no harm.
    """
    scratch = Scratch(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketched = scratch.cut(two.mapInArrow(_sketches(shingle), "id long, n long, d1 long, d2 long, bands array<long>"), "sketches")
    full = sketched.where("n > 0 and id is not null")
    classes = full.groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"))
    member = scratch.cut(full.join(classes, ["d1", "d2", "n"]).select("id", "n", "rep", F.when(F.col("id") == F.col("rep"), F.col("bands")).alias("bands")), "classes")
    banded = member.where("bands is not null").select("rep", "n", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("c"), F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    buckets = scratch.cut(banded.join(shared.select("key", "c"), "key"), "buckets")
    ids = buckets.select(F.col("rep").alias("id")).distinct()
    items = scratch.cut(two.join(ids, "id", "left_semi").mapInArrow(_sets(shingle), "id long, items array<long>"), "sets")
    degree = buckets.groupBy("rep").agg(F.sum("c").alias("degree"))
    centers = buckets.join(degree, "rep").groupBy("key").agg(F.max_by(F.struct("rep", "n"), F.struct("degree", -F.col("rep"))).alias("mid"))
    near = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    votes = buckets.join(centers, "key").where((F.col("rep") != F.col("mid.rep")) & near(F.col("n"), F.col("mid.n"))).groupBy("rep", F.col("mid.rep").alias("mid")).agg(F.count("*").alias("c"))
    best = votes.groupBy("rep").agg(F.max_by("mid", F.struct("c", -F.col("mid"))).alias("mid"))
    comp = connected_components(_confirmed(best.select(F.col("mid").alias("a"), F.col("rep").alias("b")), items, percent), scratch)
    placed = buckets.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("comp", "rep").alias("comp"))
    apart = placed.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("rep").alias("low")).where("c0 < c1").select("key", "low")
    apart = scratch.cut(placed.join(apart, "key").select("rep", "comp", "low").distinct(), "apart")
    if not apart.isEmpty():
        more = _between(apart, items, percent, scratch)
        comp = connected_components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionAll(more), scratch)

    placed = member.select("id", "n", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("id", "n", F.coalesce("comp", "rep").alias("component_id"))
    rest = sketched.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    out = placed.unionAll(rest)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _between(apart: DataFrame, items: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): a spanning forest of the links between components that share a bucket; apart(rep, comp, low), items(id, items)."""
    cluster = connected_components(apart.select(F.col("low").alias("a"), F.col("rep").alias("b")), scratch).select(F.col("node").alias("rep"), F.col("comp").alias("cluster"))
    left = apart.select("rep", "comp").distinct().join(cluster, "rep")
    main = left.groupBy("cluster", "comp").agg(F.count("*").alias("c")).groupBy("cluster").agg(F.max_by("comp", F.struct("c", -F.col("comp"))).alias("main"))
    sets = left.join(main, "cluster").join(items.groupBy(F.col("id").alias("rep")).agg(F.flatten(F.collect_list("items")).alias("items"), F.count("*").alias("texts")), "rep")
    ordered = running(sets.select("cluster", (F.col("comp") == F.col("main")).cast("int").alias("is_main"), "rep", "comp", "items", F.size("items").cast("long").alias("weight")), ["cluster", "is_main", "rep"], "weight", scratch, "ordered")
    ordered = ordered.withColumn("block", F.floor(F.col("run") / BLOCK_ITEMS))
    blocks = scratch.cut(ordered.groupBy("block").applyInArrow(_block, "block long, clusters array<long>, reps array<long>, comps array<long>, sizes array<long>, data binary"), "blocks")
    spans = ordered.groupBy("cluster").agg(F.min("block").alias("first"), F.max(F.when(F.col("is_main") == 0, F.col("block"))).alias("rest"), F.max("block").alias("last"))
    pairs = spans.where("rest is not null").select("last", F.explode(F.sequence("first", "rest")).alias("x")).select("x", F.explode(F.sequence("x", "last")).alias("y")).distinct()
    side = lambda x: blocks.select(F.col("block").alias(x), F.struct("clusters", "reps", "comps", "sizes", "data").alias("s" + x))
    return pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "sx", "sy").repartition(F.xxhash64("x", "y")).mapInArrow(_compare(percent), "a long, b long")


def _block(key, table):
    t = table.sort_by([("cluster", "ascending"), ("rep", "ascending")])
    lists = t.column("items").combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    column = lambda c: pa.array([np.asarray(t.column(c))], pa.list_(pa.int64()))
    return pa.table({"block": [key[0].as_py()], "clusters": column("cluster"), "reps": column("rep"), "comps": column("comp"), "sizes": pa.array([sizes], pa.list_(pa.int64())), "data": [np.asarray(lists.flatten()).tobytes()]})


def _unpack(side: dict) -> dict[int, tuple]:
    """cluster -> (reps, comps, sizes, items of all, row of each item)."""
    clusters, reps, comps, sizes = (np.array(side[k], np.int64) for k in ("clusters", "reps", "comps", "sizes"))
    items, ends, out = np.frombuffer(side["data"], np.int64), np.cumsum(sizes), {}
    at = np.flatnonzero(np.append(True, clusters[1:] != clusters[:-1]))
    for lo, hi in zip(at, [*at[1:], len(clusters)], strict=True):
        out[int(clusters[lo])] = (reps[lo:hi], comps[lo:hi], sizes[lo:hi], items[ends[lo] - sizes[lo] : ends[hi - 1]], np.repeat(np.arange(hi - lo), sizes[lo:hi]))
    return out


def overlaps(a: tuple, b: tuple) -> np.ndarray:
    """Sizes of the intersections of two sides' sets, by matrix products over the items that both sides have."""
    out = np.zeros((len(a[0]), len(b[0])), np.float32)
    both = np.intersect1d(a[3], b[3])
    sides = []
    for s in (a, b):
        col = np.minimum(np.searchsorted(both, s[3]), max(len(both) - 1, 0))
        hit = both[col] == s[3] if len(both) else np.zeros(0, bool)
        order = np.argsort(col[hit], kind="stable") if len(both) else np.zeros(0, np.int64)
        sides.append((col[hit][order], s[4][hit][order]) if len(both) else (order, order))
    for c in range(0, len(both), COLUMNS):
        dense = []
        for (col, row), s in zip(sides, (a, b), strict=True):
            lo, hi = np.searchsorted(col, (c, c + COLUMNS))
            m = np.zeros((len(s[0]), min(COLUMNS, len(both) - c)), np.float32)
            m[row[lo:hi], col[lo:hi] - c] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _compare(percent: int):
    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                x, y, sx, sy = (c[i].as_py() for c in batch.columns)
                left = _unpack(sx)
                right = left if x == y else _unpack(sy)
                for k in left.keys() & right.keys():
                    a, b = left[k], right[k]
                    shared = overlaps(a, b).astype(np.int64)
                    p, q = np.nonzero((shared * 100 >= (a[2][:, None] + b[2][None] - shared) * percent) & (a[1][:, None] != b[1][None]))
                    # a spanning forest: a link counts if it joins two components that nothing here has joined yet
                    root: dict[int, int] = {}
                    out = []
                    for i1, i2 in zip(p.tolist(), q.tolist(), strict=True):
                        r1, r2 = _root(root, int(a[1][i1])), _root(root, int(b[1][i2]))
                        if r1 != r2:
                            root[max(r1, r2)] = min(r1, r2)
                            out.append((int(a[0][i1]), int(b[0][i2])))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    return run


def _root(root: dict[int, int], x: int) -> int:
    while x in root:
        x = root[x]
    return x


def _confirmed(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(items.select(F.col("id").alias("a"), F.col("items").alias("ia")), "a").join(items.select(F.col("id").alias("b"), F.col("items").alias("ib")), "b")
    both = both.select("a", "b", F.size("ia").alias("na"), F.size("ib").alias("nb"), F.size(F.array_intersect("ia", "ib")).alias("i"))
    return both.where(F.col("i") * 100 >= (F.col("na") + F.col("nb") - F.col("i")) * percent).select("a", "b")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each group: the one with the smallest id.

    Of rows that share that id the first by content stays (a group may be one id
    repeated).  Rows with a null id, and rows without words, stay.
    """
    groups = near_duplicates(docs, id_col, text_col, shingle, percent)
    n = own(docs.columns, "keep", "rank")
    keep = groups.where(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias(n["keep"])).distinct()
    kept = docs.join(keep, F.col(id_col).cast("long") == F.col(n["keep"]), "left_semi")
    order = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col), *[F.col(c).cast("string") for c in docs.columns if c not in (id_col, text_col)])
    once = kept.withColumn(n["rank"], F.row_number().over(order)).where(F.col(n["rank"]) == 1).drop(n["rank"])
    return once.unionByName(docs.where(F.col(id_col).isNull()))
