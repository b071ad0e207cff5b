"""Streams of attempts: each attempt counted once, deficits to a target, and windows over events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def once(stream: DataFrame, key: str, at: str, late: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark: a finished attempt that is seen again is not counted again."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def running_deficit(stream: DataFrame, target: int) -> DataFrame:
    """Genuine attempts of each task so far and what is missing to the target (update or complete mode)."""
    n = stream.groupBy("task").agg(F.sum(F.col("genuine").cast("long")).alias("genuine"))
    return n.withColumn("deficit", F.greatest(F.lit(target) - F.col("genuine"), F.lit(0)))


def windowed(stream: DataFrame, at: str, width: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), "event_type").agg(F.count("*").alias("n")).select("w.start", "event_type", "n")


TOPPED = "task string, genuine long, attempts long, need long, exhausted boolean"


class TopUp(StatefulProcessor):
    """Counts of one task: a value for the sums, and a map with an entry for each attempt's id that lives for ``ttl``."""

    def __init__(self, target: int, cap: int, ttl: int | None):
        self.target, self.cap, self.ttl = target, cap, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "genuine long, attempts long")
        self.seen = handle.getMapState("seen", "id string", "good boolean", self.ttl)

    def handleInitialState(self, key, rows, timers) -> None:  # noqa: N802
        self._take(rows)

    def _take(self, rows: pd.DataFrame) -> None:
        genuine, attempts = self.sums.get() if self.sums.exists() else (0, 0)
        for i, good in zip(rows["id"], rows["genuine"], strict=True):
            if not self.seen.containsKey((str(i),)):
                self.seen.updateValue((str(i),), (bool(good),))
                attempts += 1
                genuine += int(bool(good))
        self.sums.update((genuine, attempts))

    def handleInputRows(self, key, rows, timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        for frame in rows:
            self._take(frame)
        genuine, attempts = self.sums.get() if self.sums.exists() else (0, 0)
        spent = attempts >= self.target * self.cap
        need = 0 if spent else max(self.target - genuine, 0)
        yield pd.DataFrame({"task": [key[0]], "genuine": [genuine], "attempts": [attempts], "need": [need], "exhausted": [spent and genuine < self.target]})

    def close(self) -> None:
        pass


def top_up(stream: DataFrame, target: int, cap: int, resume: DataFrame | None = None, days: int | None = None) -> DataFrame:
    """(task, genuine, attempts, need, exhausted) after each batch of (id, task, genuine): what is missing to ``target``,
    and 0 once ``target * cap`` attempts were made.

    An attempt counts once, complete and exhausted tasks included, however often and late its id is delivered: ids are
    entries of a map state, so a batch touches those it brings and no list is rewritten. With ``days`` an id is forgotten
    so long after it came. ``resume`` has the attempts (id, task, genuine) of an earlier run. Needs the RocksDB state
    store. A null id is the attempt "None"; a null ``genuine`` counts as none.
    """
    rows = [x.select("task", F.col("id").cast("string").alias("id"), F.coalesce("genuine", F.lit(False)).alias("genuine")) for x in (stream, resume) if x is not None]
    initial = rows[1].groupBy("task") if resume is not None else None
    ttl = days * 24 * 3600 * 1000 if days else None
    return rows[0].groupBy("task").transformWithStateInPandas(TopUp(target, cap, ttl), TOPPED, "Update", "ProcessingTime" if ttl else "None", initial)
