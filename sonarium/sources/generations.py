"""A table loaded anew as a whole, beside the one in use, which readers leave only once the new one is complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import folders, is_whole, remove_folder


class Generations:
    """A folder of generations of a table; the last whole one in ``current`` counts."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.path, self.keep = spark, path, keep

    def _accepted(self) -> list[int]:
        found = (int(name[1:]) for name in folders(self.spark, f"{self.path}/current"))
        return sorted(n for n in found if is_whole(self.spark, f"{self.path}/current/g{n}"))

    def load(self, rows: DataFrame, least: int = 1) -> int:
        """Write the next generation; it comes into use if it has ``least`` rows, else that is an error and the old one stays."""
        accepted = self._accepted()
        number = (accepted[-1] if accepted else 0) + 1
        path = f"{self.path}/data/g{number}"
        rows.write.mode("overwrite").parquet(path)
        if self.spark.read.parquet(path).count() < least:
            raise ValueError(f"generation {number} of {self.path} has fewer than {least} rows")
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/current/g{number}")
        for old in accepted[: max(0, len(accepted) + 1 - self.keep)]:
            remove_folder(self.spark, f"{self.path}/current/g{old}")
            remove_folder(self.spark, f"{self.path}/data/g{old}")
        return number

    def current(self) -> DataFrame:
        accepted = self._accepted()
        if not accepted:
            raise ValueError(f"{self.path} has no generation yet")
        return self.spark.read.parquet(f"{self.path}/data/g{accepted[-1]}")
