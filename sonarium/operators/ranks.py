"""Positions within groups of any size: a range-partitioned sort and counts of what lies before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle, shuffle_width


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """``rows`` with their position from 1 in their group by ``order``, ascending, nulls first.

    ``order`` must end in a column that is unique in its group. A group may span many
    tasks: each task counts its own rows, and a group's counts, one a task, are summed
    over the tasks before. Nulls in ``group`` form a group of their own; an empty frame
    stays empty.
    """
    keys = [*group, *order]
    cut = rows.repartitionByRange(shuffle_width(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    held = settle(cut.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    parts = held.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    p, h = parts.alias("p"), held.alias("h")
    on = F.col("h._part") == F.col("p._part")
    for g in group:
        on = on & F.col(f"h.{g}").eqNullSafe(F.col(f"p.{g}"))
    return h.join(p, on).select("h.*", (F.col("h._at") - F.col("p._first") + F.col("p._before") + 1).alias(name)).drop("_at", "_part")


def page_after(rows: DataFrame, key: str, after, n: int) -> DataFrame:
    """The next ``n`` rows by ``key`` past ``after`` (from the start if null): a page of a resumable walk."""
    rest = rows if after is None else rows.where(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(n)
