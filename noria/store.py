"""Tables kept in the folder that all executors share, and row numbers over them."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.  Where it is unset, a temporary one, on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="noria-")
    atexit.register(shutil.rmtree, made, True)
    spark.sparkContext.setCheckpointDir("file://" + made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


class Store:
    """Stages that are read more than once: written as Parquet in the shared folder, so they are computed once and survive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.n = spark, f"{shared_dir(spark)}/noria-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path, self.n = f"{self.base}/{self.n}-{name}", self.n + 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Deletes all tables of this store; whoever made it has read them to the end."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, order: list, store: Store, out: str = "number") -> DataFrame:
    """df with `out`: 1, 2, 3, ... in a total order.

    Rows are dealt out by ranges of `order` and numbered within each partition; the
    partitions' counts, one number each, are summed by the driver.  No task holds more
    than its range.
    """
    at = "__at"
    kept = store.keep(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(at, 33).cast("int")
    counts = sorted(tuple(r) for r in kept.groupBy(part.alias("part")).count().collect())
    starts, total = [(-1, 0)], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, "__part int, __start long")
    within = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return kept.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn(out, F.col("__start") + within + 1).drop(at, "__part", "__start")
