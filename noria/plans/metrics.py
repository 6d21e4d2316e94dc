"""What a stage of the pipeline did: rows from the plan itself, and the times of its Python partitions."""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass

from pyspark import AccumulatorParam
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from noria.session import ship_package

#: Partitions of tagging whose least time is under this share of the greatest are uneven.
UNEVEN = 0.8


class ByPartition(AccumulatorParam):
    """partition -> (documents, failures, seconds); a partition that ran twice counts once."""

    def zero(self, value):
        return {}

    def addInPlace(self, a, b):  # noqa: N802  Spark's name
        return {**a, **b}


def partition_times(spark: SparkSession):
    ship_package(spark)
    return spark.sparkContext.accumulator({}, ByPartition())


@dataclass(frozen=True)
class StageMetrics:
    stage: str
    rows: int
    seconds: float
    rows_per_second: float
    documents: int | None = None
    failures: int | None = None
    success_rate: float | None = None
    partitions: int | None = None
    efficiency: float | None = None
    uneven: bool | None = None


class Watch:
    """Counts a table's rows while it is written, and sums up its stage.

    with Watch("nouns") as w: w.seen(df).write...; then w.metrics().
    """

    def __init__(self, stage: str, times=None):
        self.stage, self.times, self._observations, self.seconds = stage, times, [], 0.0

    def __enter__(self) -> Watch:
        self._began = time.time()
        return self

    def __exit__(self, *_) -> None:
        self.seconds = time.time() - self._began

    def seen(self, df: DataFrame) -> DataFrame:
        """df, whose rows are counted by the job that writes it; no job of its own."""
        o = Observation()
        self._observations.append(o)
        return df.observe(o, F.count(F.lit(1)).alias("rows"))

    def metrics(self) -> StageMetrics:
        rows = self._observations[-1].get["rows"] if self._observations else 0
        found = list(self.times.value.values()) if self.times is not None else []
        if not found:
            return StageMetrics(self.stage, rows, self.seconds, rows / max(self.seconds, 1e-9))
        docs, failures, seconds = (sum(x[i] for x in found) for i in range(3))
        busy = [x[2] for x in found if x[0]]
        efficiency = min(busy) / max(max(busy), 1e-9) if busy else 1.0
        return StageMetrics(self.stage, rows, self.seconds, rows / max(self.seconds, 1e-9), docs, failures, 1 - failures / docs if docs else 1.0, len(found), efficiency, efficiency < UNEVEN)


_SCHEMA = "stage string, rows long, seconds double, rows_per_second double, documents long, failures long, success_rate double, partitions int, efficiency double, uneven boolean"


def write_metrics(spark: SparkSession, path: str, m: StageMetrics) -> None:
    spark.createDataFrame([tuple(asdict(m).values())], _SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).json(list(paths))
