"""Sessions, and shipping this package to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def get_spark(cores: int | str = "*", partitions: int = 8, name: str = "noria", driver_memory: str = "8g") -> SparkSession:
    """A local session with the settings this engine is tested with."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Make `noria` importable in the Python workers of this application, once."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="noria-")) / "noria_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("noria") / p.relative_to(root))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)
