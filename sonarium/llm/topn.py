"""The N highest-scoring items of every group, exactly, however large a group is.

All rows are range-partitioned and sorted by group, score and item, so that a hot
group is spread over many partitions. Each partition counts positions along its run
of a group; the counts of a group's earlier partitions, prefix-summed, turn them into
positions in the whole group. A partition need report no more than N rows of a
group: if it has N, no later partition holds a position up to N.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle, shuffle_width, table


def _positions(width: int, limit: int):
    """Number the rows of each group (the first ``width`` columns) in a sorted partition."""

    def run(batches):
        last, count = None, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            change = np.zeros(n, bool)
            for i in range(width):
                a, b = batch.column(i)[1:], batch.column(i)[:-1]
                differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
                differ |= pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False)
                change[1:] |= differ
            group = [batch.column(i)[0].as_py() for i in range(width)]
            change[0] = group != last
            begin = np.where(change, np.arange(n), 0)
            begin = np.maximum.accumulate(begin)
            place = np.arange(n) - begin + 1
            if not change[0]:  # the first run goes on from the batch before
                until = int(np.argmax(change)) if change.any() else n
                place[:until] += count
            last, count = [batch.column(i)[n - 1].as_py() for i in range(width)], int(place[-1])
            batch = pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "local"])
            yield batch.filter(pa.array(place <= limit))

    return run


def top_n(rows: DataFrame, group: Sequence[str], score: str, item: Sequence[str], n: int) -> DataFrame:
    """The columns group, item and score, and ``place``, 1 to ``n``, by score downward.

    Equal scores go by item upward, strings in byte order; rows equal in all of these
    take consecutive places. Rows with a null or NaN score don't take part. A null in
    a group column is a group of its own, and a null item comes before the others.
    Other columns are ignored; an empty table gives no rows.
    """
    g = [f"g{i}" for i in range(len(group))]
    t = [f"t{i}" for i in range(len(item))]
    value = F.col(score) + F.lit(0).cast(rows.schema[score].dataType)  # -0.0 is 0.0
    keep = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    flat = rows.where(keep).select(
        *(F.col(c).alias(x) for c, x in zip(group, g)), value.alias("s"), *(F.col(c).alias(x) for c, x in zip(item, t))
    )
    order = [*(F.col(x).asc() for x in g), F.col("s").desc(), *(F.col(x).asc() for x in t)]
    laid = flat.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
    laid = laid.withColumn("part", F.spark_partition_id())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in laid.schema) + ", local bigint"
    local = settle(laid.mapInArrow(_positions(len(g), n), fields))

    # At most one row a partition: a run that a partition goes on with from an earlier one.
    runs = local.groupBy(*g, "part").agg(F.max("local").alias("count"))
    before = F.sum("count").over(Window.partitionBy(*g).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = runs.withColumn("before", before).where("before > 0").select(*(F.col(x).alias(f"o{x}") for x in g), F.col("part").alias("opart"), "before")
    same = (F.col("part") == F.col("opart"))
    for x in g:
        same &= F.col(x).eqNullSafe(F.col(f"o{x}"))
    place = (F.col("local") + F.coalesce("before", F.lit(0))).cast("int")
    placed = local.join(F.broadcast(offsets), same, "left").withColumn("place", place).where(F.col("place") <= n)
    return placed.select(*(F.col(x).alias(c) for c, x in zip(group, g)), *(F.col(x).alias(c) for c, x in zip(item, t)), F.col("s").alias(score), "place")


def latest_scores(scores: DataFrame) -> DataFrame:
    """(artist_id, tag, model, score): the row with the latest computed_at for each of the first three.

    Rows of one time are settled by the greater score, NaN above all, null below.
    """
    held = F.max(F.struct("computed_at", "score")).alias("held")
    return scores.groupBy("artist_id", "tag", "model").agg(held).select("artist_id", "tag", "model", "held.score")


def p6_found(spark, sf_dir: str) -> DataFrame:
    best = top_n(latest_scores(table(spark, sf_dir, "artist_tag_scores")), ["artist_id", "model"], "score", ["tag"], 5)
    return best.select("artist_id", "model", "place", "tag")


QUERIES = {"p6_found": p6_found}
SQL = {
    "p6_found": """
    with held as (
      select artist_id, tag, model, score, row_number() over (partition by artist_id, tag, model order by computed_at desc nulls last, score desc nulls last) as rn
      from artist_tag_scores),
    placed as (
      select artist_id, model, tag, row_number() over (partition by artist_id, model order by score desc, tag) as place
      from held where rn = 1 and score is not null and not isnan(score))
    select artist_id, model, place::integer as place, tag from placed where place <= 5"""
}
