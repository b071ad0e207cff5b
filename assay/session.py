"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, so that Python functions find it there."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="assay-ship-"), "assay_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f"{root.name}/{f.relative_to(root)}")
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def with_checkpoints(spark: SparkSession) -> None:
    """Set the folder of ``spark.checkpoint.dir`` for checkpoints; in local mode a fresh one where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="assay-"))


def written(df: DataFrame) -> DataFrame:
    """The table written once, compressed, to the folder for checkpoints, and read again."""
    spark = df.sparkSession
    with_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/assay-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
