"""Shared helpers: the shared folder, and vectorised hashing of whole texts.

Hashes are 64-bit.  Two different words, shingles or lines are taken for equal
with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noria.session import ship_package
from noria.store import shared_dir

#: Bytes of text that are hashed at once; bounds the temporary arrays of a worker.
SLICE_BYTES = 1 << 20

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSE = np.ones(1, dtype=np.uint64)


class Scratch:
    """Tables written to the shared folder, which cut lineage and survive lost executors.

    What a shuffle brings is written in files of the advisory partition size, not in as
    many as there are cores: a small table is one file.
    """

    FEW_FILES = "spark.sql.adaptive.coalescePartitions.parallelismFirst"

    def __init__(self, spark: SparkSession):
        ship_package(spark)
        self.spark, self.base, self.names = spark, f"{shared_dir(spark)}/noria-{uuid.uuid4().hex}", []

    def path(self, name: str) -> str:
        return f"{self.base}/{len(self.names)}-{name}"

    def cut(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """df, written and read again; a folder for each value of the columns `by`."""
        path = self.path(name)
        self.names.append(path)
        before = self.spark.conf.get(self.FEW_FILES)
        self.spark.conf.set(self.FEW_FILES, "false")
        try:
            df.write.mode("overwrite").partitionBy(*by).parquet(path)
        finally:
            self.spark.conf.set(self.FEW_FILES, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._noria_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in tables:
            path = jvm.org.apache.hadoop.fs.Path(df._noria_path)
            path.getFileSystem(conf).delete(path, True)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = max(n, SLICE_BYTES + 4096)
        for base, name in ((_P, "_POWERS"), (_P_INV, "_INVERSE")):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            globals()[name] = np.multiply.accumulate(x)
    return _POWERS[:n], _INVERSE[:n]


def slices(texts: pa.Array, most: int = SLICE_BYTES):
    """Ranges of rows with about `most` bytes of text; a longer text stands alone."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    sizes = np.asarray(pa.compute.binary_length(texts).fill_null(0)).astype(np.int64)
    ends, lo = np.cumsum(sizes), 0
    while lo < n:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, side="right")))
        hi = min(hi, n, lo + 65536)
        yield lo, texts.slice(lo, hi - lo)
        lo = hi


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the row offsets in them; a null is empty."""
    texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, at: np.ndarray, apart: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each row (one more at the end).

    apart: which bytes stand between words; by default words are `[^\\x20\\x09-\\x0D]+`.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(at), dtype=np.int64)
    word = ~apart[data]
    first = np.ones(n, dtype=bool)
    first[1:] = ~word[:-1]
    inner = at[(at > 0) & (at < n)]
    first[inner] = True
    last = np.ones(n, dtype=bool)
    last[:-1] = ~word[1:]
    last[inner - 1] = True
    starts, ends = np.flatnonzero(word & first), np.flatnonzero(word & last) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans, A-Z as a-z."""
    return prefix_hashes(rolling(data), starts, ends)


def rolling(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    powers, _ = _powers(len(data) + 1)
    np.cumsum(_BYTE[data] * powers[: len(data)], out=out[1:])
    return out


def prefix_hashes(rolled: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = _powers(len(rolled))
    h = (rolled[ends] - rolled[starts]) * inverse[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and the first word of each row (one more at the end)."""
    data, at = raw(texts)
    starts, ends, rows = word_spans(data, at)
    return span_hashes(data, starts, ends), rows


_FOLD = tuple(mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; of fewer words, the whole sequence is one."""
    h, rows = word_hashes(texts)
    n = len(h)
    if n >= k:
        s = h[: n - k + 1] * _FOLD[0]
        for j in range(1, k):
            s = s + h[j : n - k + 1 + j] * _FOLD[j]
        s = mix(s)
    out = []
    for lo, hi in zip(rows[:-1], rows[1:], strict=True):
        size = hi - lo
        if size >= k:
            out.append(np.unique(s[lo : hi - k + 1]))
        elif size:
            short = np.uint64(size)
            for j in range(size):
                short = short + h[lo + j : lo + j + 1] * _FOLD[32 + j]
            out.append(mix(short))
        else:
            out.append(h[:0])
    return out


def longs(parts: list[np.ndarray]) -> pa.Array:
    """A list<int64> column."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.uint64).view(np.int64)))


def crc_mod(column, m: int):
    """crc32 of the id as text, modulo m."""
    return F.crc32(column.cast("string").cast("binary")) % m


def own(columns: list[str], *names: str) -> dict[str, str]:
    """Names for working columns that clash with none of `columns`."""
    taken = {c.lower() for c in columns}
    out = {}
    for name in names:
        made = f"__{name}"
        while made.lower() in taken:
            made += "_"
        taken.add(made.lower())
        out[name] = made
    return out


def running(df: DataFrame, order: list[str], weight: str, scratch: Scratch, name: str, cheap: bool = False) -> DataFrame:
    """df with `run`: the sum of `weight` over the rows before, in a total order.

    Rows are dealt out by ranges of `order` and summed within each partition; the
    partitions' totals, one number each, are summed by the driver.  No partition
    holds more than its range.  cheap: df is quick to compute again, as it is once for
    the ranges and once for the sums; else it is written first.
    """
    fields = df.schema

    def sums(batches):
        at = 0
        for batch in batches:
            w = np.asarray(batch.column(batch.schema.get_field_index(weight))).astype(np.int64)
            ends = at + np.cumsum(w)
            at = int(ends[-1]) if len(ends) else at
            pid = pa.array(np.full(len(w), TaskContext.get().partitionId(), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - w), pid], [*batch.schema.names, "run", "pid"])

    spark = df.sparkSession
    schema = T.StructType([*fields.fields, T.StructField("run", T.LongType()), T.StructField("pid", T.IntegerType())])
    cut = df if cheap else scratch.cut(df, name + "-in")
    out = scratch.cut(cut.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sums, schema), name)
    totals = sorted(tuple(r) for r in out.groupBy("pid").agg(F.max(F.col("run") + F.col(weight))).collect())
    starts = np.cumsum([0, *(t for _, t in totals)]).tolist()
    offsets = spark.createDataFrame([(p, s) for (p, _), s in zip(totals, starts, strict=False)], "pid int, base long")
    return out.join(F.broadcast(offsets), "pid").withColumn("run", F.col("run") + F.col("base")).drop("pid", "base")
