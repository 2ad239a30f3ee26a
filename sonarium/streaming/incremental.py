"""The streaming side: incremental upserts into a snapshot folder, and windowed counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.history import latest_wins
from ..session import folders, is_whole, remove_folder


class SnapshotSink:
    """A table in a folder, a version a batch; a batch that comes again writes the same version again.

    Rows are bucketed by a hash of their key; a batch writes only the buckets it touches, and a
    small list of where each bucket is last, so a restarted stream repeats a batch without
    doubling it and readers see only whole versions. The last ``keep`` versions stay readable.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], time: str, buckets: int = 64, keep: int = 3):
        self.spark, self.path, self.keys, self.time, self.buckets, self.keep = spark, path, list(keys), time, buckets, keep

    def versions(self) -> list[int]:
        """The whole versions there are."""
        found = (int(name[1:]) for name in folders(self.spark, f"{self.path}/lists"))
        return sorted(v for v in found if is_whole(self.spark, f"{self.path}/lists/v{v}"))

    def _list(self, version: int) -> dict[int, int]:
        """For each bucket that isn't empty the version that wrote it."""
        if not is_whole(self.spark, f"{self.path}/lists/v{version}"):
            raise ValueError(f"version {version} of {self.path} is missing")
        rows = self.spark.read.parquet(f"{self.path}/lists/v{version}").collect()  # a row a bucket
        return {r.bucket: r.version for r in rows if r.bucket is not None}

    def _buckets(self, at: dict[int, int]) -> DataFrame | None:
        paths = [f"{self.path}/data/v{v}/bucket={b}" for b, v in at.items()]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, version: int) -> DataFrame:
        """A version's rows; an error if it is missing or without any row."""
        rows = self._buckets(self._list(version))
        if rows is None:
            raise ValueError(f"version {version} of {self.path} is empty")
        return rows

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Write version ``batch_id``: the version before with the batch's rows, the latest of a key holding.

        Batch 0 begins the table; for any other one the version before must be there.
        """
        at = self._list(batch_id - 1) if batch_id else {}
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        touched = [r.bucket for r in batch.select(bucket.alias("bucket")).distinct().collect()]  # at most self.buckets
        before = self._buckets({b: v for b, v in at.items() if b in touched})
        merged = latest_wins(batch.limit(0) if before is None else before.select(batch.columns), batch, self.keys, self.time)
        merged.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/v{batch_id}")
        at = at | {b: batch_id for b in touched}
        rows = list(at.items()) or [(None, batch_id)]
        self.spark.createDataFrame(rows, "bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/lists/v{batch_id}")
        self._prune(batch_id)

    def _prune(self, last: int) -> None:
        old = [v for v in self.versions() if v <= last - self.keep]
        for v in old:
            remove_folder(self.spark, f"{self.path}/lists/v{v}")
        used = {v for kept in self.versions() for v in self._list(kept).values()} | {last}
        for name in folders(self.spark, f"{self.path}/data"):
            if int(name[1:]) not in used:
                remove_folder(self.spark, f"{self.path}/data/{name}")


def publish(stream: DataFrame, sink: SnapshotSink, checkpoint: str) -> StreamingQuery:
    """Bring the sink up to date with all that the stream has now, then stop."""
    return stream.writeStream.foreachBatch(sink.upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Counts of each key in tumbling windows; rows later than ``late`` are dropped."""
    counted = stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), key, "n")


def _judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    before = state.get[0] if state.exists else 0
    now = before + sum(len(b) for b in batches)
    state.update((now,))
    if now > before:
        yield pd.DataFrame({"key": [key[0]], "before": [before], "n": [now]})


def gate_grown(stream: DataFrame, key: str) -> DataFrame:
    """(key, before, n): in each batch the keys that are new or grew, with their numbers of rows; a null key is left out.

    Only the number of rows is kept for a key, and a hot key's rows arrive in Arrow batches, never at once.
    """
    keyed = stream.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"))
    return keyed.groupBy("key").applyInPandasWithState(_judge, "key string, before long, n long", "n long", "update", GroupStateTimeout.NoTimeout)
