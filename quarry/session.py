"""Session helpers.

Library functions never create or configure a session themselves; they take
DataFrames.  These helpers are for the bench, the tests and command-line use.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quarry") -> SparkSession:
    """A local session with AQE on and the web UI off (tests, bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Only a session whose
    executors are threads of the driver (``local[..]``) may leave it unset:
    it gets a scratch folder.  On a cluster an unset folder is an error."""
    d = checkpoint_dir(spark)
    if d is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint): the data is written to
    the folder named by ``spark.checkpoint.dir`` and re-read from there.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    the passes that run there import it from any working directory."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-ship-"), "quarry.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, files in os.walk(os.path.join(root, "quarry")):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    out.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
