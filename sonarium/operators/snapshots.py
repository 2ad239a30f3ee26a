"""What changed between consecutive full snapshots of a table.

The snapshots, all in one frame, are range-partitioned and sorted by key. Each
sorted run is cut into content-defined chunks: a chunk begins at a key whose hash
ends in zero bits, so that an added or removed key moves no other boundary. Chunks
whose digest is the same in two consecutive snapshots are discarded, and only the
rows of the others are joined, by key, and classified.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import same_text
from ..session import settle, shuffle_width, table

#: Rows of a chunk, on average.
CHUNK_ROWS = 64


def holding_versions(rows: DataFrame, snapshot: str, key: str, version: str, values: Sequence[str]) -> DataFrame:
    """One row for each snapshot and key: the one with the latest ``version``.

    Equal versions are settled by the greatest values, so the result is the same in
    every run. Rows with a null snapshot or key belong to nothing and are left out.
    """
    latest = F.max(F.struct(version, *values)).alias("held")
    held = rows.where(F.col(snapshot).isNotNull() & F.col(key).isNotNull()).groupBy(snapshot, key).agg(latest)
    return held.select(F.col(snapshot).alias("snapshot"), F.col(key).alias("key"), *(F.col(f"held.{v}").alias(v) for v in values))


def _chunk_starts(batches):
    """The key of the chunk that each row is in, over rows sorted by snapshot and key."""
    last_snapshot, start = None, ""
    for batch in batches:
        snapshots, keys, cuts = (batch.column(i) for i in (0, 1, 2))
        n = batch.num_rows
        if n == 0:
            continue
        first = np.ones(n, bool)
        if n > 1:
            first[1:] = pc.not_equal(snapshots[1:], snapshots[:-1]).to_numpy(zero_copy_only=False)
        first[0] = snapshots[0].as_py() != last_snapshot
        opens = first | cuts.to_numpy(zero_copy_only=False)
        # 0 stands for the chunk still open from the batch before, i + 1 for one opened at row i
        at = np.maximum.accumulate(np.where(opens, np.arange(1, n + 1), 0))
        head = pa.array(np.where(first & ~cuts.to_numpy(zero_copy_only=False), True, False))
        names = pc.if_else(head, pa.scalar("", pa.string()), keys.cast(pa.string()))
        pool = pa.concat_arrays([pa.array([start], pa.string()), names.cast(pa.string())])
        starts = pool.take(pa.array(at))
        last_snapshot, start = snapshots[n - 1].as_py(), starts[n - 1].as_py()
        yield pa.RecordBatch.from_arrays([*batch.columns, starts], names=[*batch.schema.names, "chunk"])


def snapshot_changes(
    rows: DataFrame,
    order: DataFrame,
    snapshot: str,
    key: str,
    version: str,
    values: Sequence[str],
    normal: dict[str, Column] | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Rows (snapshot, key, old, new) for each key that differs between a snapshot and the one before.

    ``order`` has one column, the snapshots to compare, which sort in time order;
    others in ``rows`` don't count. ``old`` and ``new`` are structs of ``values``
    after ``normal``, null where the key isn't in that snapshot. The first snapshot
    has no changes. Repeated rows, extra columns and an empty table change nothing;
    a null snapshot or key is left out.
    """
    spark = rows.sparkSession
    normal = normal or {}
    # As many rows as deliveries, so the window over all of them is small.
    named = order.select(F.col(order.columns[0]).alias("snapshot")).where("snapshot is not null").distinct()
    steps = named.withColumn("later", F.lead("snapshot").over(Window.orderBy("snapshot")))
    steps = settle(steps)

    wanted = rows.join(steps.select(F.col("snapshot").alias(snapshot)), snapshot, "left_semi")
    held = holding_versions(wanted, snapshot, key, version, values)
    held = held.select("snapshot", "key", *(normal.get(v, F.col(v)).alias(v) for v in values))
    cut = F.pmod(F.xxhash64("key"), F.lit(chunk_rows)) == 0
    laid = (
        held.select("snapshot", "key", cut.alias("cut"), *values)
        .repartitionByRange(shuffle_width(spark), "key")
        .sortWithinPartitions("snapshot", "key")
        .withColumn("part", F.spark_partition_id())
    )
    types = {f.name: f.dataType.simpleString() for f in laid.schema}
    laid = laid.mapInArrow(_chunk_starts, ", ".join(f"`{c}` {t}" for c, t in types.items()) + ", chunk string")
    laid = settle(laid.drop("cut"))

    # A digest of the count and two sums of hashes begun with different numbers; the key is
    # part of a hash, and so is, since a hash skips nulls, whether each value is one.
    marked = [x for v in values for x in (F.isnull(v), F.col(v))]
    digest = [F.count("*").alias("n")] + [
        F.sum(F.xxhash64(F.lit(seed), "key", *marked).cast("decimal(20,0)")).alias(f"d{seed}") for seed in (1, 2)
    ]
    chunks = laid.groupBy("snapshot", "part", "chunk").agg(*digest)
    seq = steps.withColumnRenamed("snapshot", "s")
    sided = (
        chunks.join(seq, chunks.snapshot == seq.s)
        .withColumn("pair", F.explode(F.array("snapshot", "later")))
        .where("pair is not null")
    )
    unmatched = (
        sided.groupBy("pair", "part", "chunk", "n", "d1", "d2")
        .agg(F.count("*").alias("sides"), F.max("snapshot").alias("snapshot"))
        .where("sides = 1")
        .select("pair", "part", "chunk", "snapshot")
    )
    suspects = laid.join(unmatched, ["snapshot", "part", "chunk"])
    record = F.struct(*values)
    compared = suspects.groupBy("pair", "key").agg(
        F.max(F.when(F.col("snapshot") == F.col("pair"), record)).alias("new"),
        F.max(F.when(F.col("snapshot") != F.col("pair"), record)).alias("old"),
    )
    first = steps.agg(F.min("snapshot").alias("first"))
    return (
        compared.join(F.broadcast(first), F.col("pair") != F.col("first"))  # one row
        .where(~F.col("old").eqNullSafe(F.col("new")))
        .select(F.col("pair").alias("snapshot"), "key", "old", "new")
    )


ARTIST_TEXTS = ("display_name", "status", "mbid", "embedding_source")


def applied_serials(runs: DataFrame) -> DataFrame:
    """The deliveries that some run applied."""
    return runs.where("applied_at is not null and serial is not null").select("serial").distinct()


def artist_changes(snapshots: DataFrame, runs: DataFrame) -> DataFrame:
    """(serial, artist_id, change) of each artist that differs between applied deliveries."""
    normal = {c: same_text(F.col(c)) for c in ARTIST_TEXTS}
    diff = snapshot_changes(snapshots, applied_serials(runs), "serial", "id", "delivered_at", ARTIST_TEXTS, normal)
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(~F.col("old.display_name").eqNullSafe(F.col("new.display_name")), "renamed")
        .otherwise("changed")
    )
    return diff.select(F.col("snapshot").alias("serial"), F.col("key").alias("artist_id"), change.alias("change"))


def p2_found(spark, sf_dir: str) -> DataFrame:
    return artist_changes(table(spark, sf_dir, "artist_snapshot"), table(spark, sf_dir, "mb_refresh_run"))


def p2_renames(spark, sf_dir: str) -> DataFrame:
    """What the runs of each applied delivery counted as renames, beside the renames derived."""
    runs = table(spark, sf_dir, "mb_refresh_run")
    derived = p2_found(spark, sf_dir).groupBy("serial").agg(F.sum(F.when(F.col("change") == "renamed", 1).otherwise(0)).alias("derived"))
    counted = (
        runs.dropDuplicates(["id"]).where("applied_at is not null and serial is not null").groupBy("serial").agg(F.count("*").alias("runs"), F.sum("renames").alias("counted"))
    )
    return counted.join(derived, "serial", "left").select("serial", "runs", "counted", F.coalesce("derived", F.lit(0)).cast("bigint").alias("derived"))


_TEXT = "nullif(trim(regexp_replace(nfc_normalize({0}), '[ \t]+', ' ', 'g')), '')"
_CHANGES_SQL = f"""
with steps as (
  select serial, lag(serial) over (order by serial) as before
  from (select distinct serial from mb_refresh_run where applied_at is not null and serial is not null)
), held as (
  select serial, id, {', '.join(_TEXT.format(c) + ' as ' + c for c in ARTIST_TEXTS)}
  from (select *, row_number() over (partition by serial, id order by delivered_at desc nulls last,
          {', '.join(c + ' desc nulls last' for c in ARTIST_TEXTS)}) as rn
        from artist_snapshot where serial is not null and id is not null)
  where rn = 1
), new as (select h.*, s.before from held h join steps s using (serial) where s.before is not null),
old as (select s.serial, h.* exclude (serial) from held h join steps s on h.serial = s.before)
, both_sides as (
  select coalesce(n.serial, o.serial) as serial, coalesce(n.id, o.id) as artist_id,
    case when o.id is null then 'added' when n.id is null then 'removed'
         when n.display_name is distinct from o.display_name then 'renamed'
         when (n.status, n.mbid, n.embedding_source) is distinct from (o.status, o.mbid, o.embedding_source) then 'changed'
    end as change
  from new n full join old o on n.serial = o.serial and n.id = o.id
), changes as (select * from both_sides where change is not null)
"""

QUERIES = {"p2_found": p2_found, "p2_renames": p2_renames}
SQL = {
    "p2_found": _CHANGES_SQL + "select serial, artist_id, change from changes",
    "p2_renames": _CHANGES_SQL
    + """, counted as (
      select serial, count(*) as runs, sum(renames) as counted
      from (select distinct on (id) * from mb_refresh_run order by id) where applied_at is not null and serial is not null group by 1)
    select c.serial, c.runs, c.counted, coalesce(d.derived, 0) as derived
    from counted c left join (select serial, count(*) filter (where change = 'renamed') as derived from changes group by 1) d using (serial)""",
}
