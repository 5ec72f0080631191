"""Session helpers: builder defaults, table loading and shipping this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = Path(__file__).resolve().parent


def local_session(cpus: int = 8, app: str = "tablesift") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("TABLESIFT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")  # few bytes can be much work here
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Spark's own reader opens it, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once for each SparkContext, so that Python operators import there."""
    context = spark.sparkContext
    if getattr(context, "_tablesift_shipped", False):
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tablesift_"))
    archive = os.path.join(folder, "tablesift_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(PACKAGE_ROOT.rglob("*")):
            if source.suffix in {".py", ".yaml"}:
                z.write(source, Path("tablesift") / source.relative_to(PACKAGE_ROOT))
    context.addPyFile(archive)
    context._tablesift_shipped = True
