"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where none is set, a fresh local folder in local mode and an error elsewhere."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    found = found or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="assay-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


_opened: ContextVar[list[Scratch] | None] = ContextVar("opened", default=None)


@contextmanager
def passing() -> Iterator[None]:
    """Whatever is opened inside is deleted at the end, when the frames that read it have been written."""
    token = _opened.set([])
    try:
        yield
    finally:
        for scratch in _opened.get():
            scratch.drop_all()
        _opened.reset(token)


class Scratch:
    """Tables written once and read again: they cut lineage and survive the loss of any executor.

    Those that a returned frame still reads stay below ``root`` until its owner deletes it.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.paths, self.count = spark, f"{shared_dir(spark)}/assay-{uuid.uuid4().hex}", {}, 0
        if (held := _opened.get()) is not None:
            held.append(self)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{self.count}"
        self.count += 1
        df.write.option("compression", "zstd").parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def rename(self, old: str, new: str) -> None:
        self.paths.setdefault(new, []).extend(self.paths.pop(old, []))

    def drop(self, *names: str) -> None:
        """Delete tables that no frame still to be read depends on."""
        for name in names:
            for path in self.paths.pop(name, []):
                self._delete(path)

    def drop_all(self) -> None:
        self.paths.clear()
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
