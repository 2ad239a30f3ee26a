"""Changes in time: upserts, inserts, replacements, marks of progress and windows of counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import table


def latest_wins(kept: DataFrame, new: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Rows of both frames, for each key the latest; of equal times the greatest row, so runs agree."""
    rows = kept.unionByName(new)
    rest = [c for c in rows.columns if c not in keys and c != time]
    held = rows.groupBy(*keys).agg(F.max(F.struct(time, *rest)).alias("held"))
    return held.select(*keys, *(F.col(f"held.{c}").alias(c) for c in (time, *rest)))


def insert_absent(kept: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``kept`` and the rows of ``new`` whose key it lacks, one a key (the least row)."""
    rest = [c for c in new.columns if c not in keys]
    least = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("held")).select(*keys, *(F.col(f"held.{c}").alias(c) for c in rest))
    return kept.unionByName(least.join(kept.select(*keys), list(keys), "left_anti").select(*kept.columns))


def replace_groups(kept: DataFrame, new: DataFrame, group: Sequence[str]) -> DataFrame:
    """``kept`` with every group that ``new`` has any row of replaced by those rows."""
    return kept.join(new.select(*group).distinct(), list(group), "left_anti").select(*new.columns).unionByName(new)


def merge_fields(kept: DataFrame, new: DataFrame, keys: Sequence[str], replaced: Sequence[str], filled: Sequence[str]) -> DataFrame:
    """An upsert field by field: ``replaced`` are the new row's, null included; ``filled`` keep the old value where the new is null."""
    k, n = kept.alias("k"), new.alias("n")
    on = [F.col(f"k.{c}") == F.col(f"n.{c}") for c in keys]
    both = k.join(n, on, "full_outer")
    fresh = F.col(f"n.{keys[0]}").isNotNull()
    return both.select(
        *(F.coalesce(f"n.{c}", f"k.{c}").alias(c) for c in keys),
        *(F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"k.{c}")).alias(c) for c in replaced),
        *(F.coalesce(f"n.{c}", f"k.{c}").alias(c) for c in filled),
    )


def events(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _halves(spark, sf_dir: str):
    rows = events(spark, sf_dir).select("user_id", "event_type", "ts", "value", "event_id")
    return rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")  # two deliveries of one table; all rows are used


def latest_wins_upsert(spark, sf_dir: str) -> DataFrame:
    kept, new = _halves(spark, sf_dir)
    return latest_wins(kept, new, ["user_id", "event_type"], "ts").select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"))


def insert_if_absent(spark, sf_dir: str) -> DataFrame:
    kept, new = (h.withColumn("day", F.to_date("ts")).groupBy("user_id", "day").agg(F.min("event_id").alias("event_id")) for h in _halves(spark, sf_dir))
    return insert_absent(kept, new, ["user_id", "day"]).select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "event_id")


def replace_wholesale(spark, sf_dir: str) -> DataFrame:
    kept, new = _halves(spark, sf_dir)
    cols = ["user_id", "event_type", "event_id"]
    return replace_groups(kept.select(*cols), new.where("value > 50").select(*cols), ["user_id", "event_type"])


def field_merge(spark, sf_dir: str) -> DataFrame:
    """Artists with the fields of their latest snapshot: status replaced, mbid and source filled in."""
    old = table(spark, sf_dir, "artist").where("id is not null").select("id", "status", "mbid", "embedding_source").distinct()
    held = table(spark, sf_dir, "artist_snapshot").where("id is not null").groupBy("id").agg(F.max(F.struct("serial", "delivered_at", "status", "mbid", "embedding_source")).alias("h"))
    new = held.select("id", "h.status", "h.mbid", "h.embedding_source")
    return merge_fields(old, new, ["id"], ["status"], ["mbid", "embedding_source"])


def changed_since(rows: DataFrame, key: str, time: str, mark: DataFrame) -> DataFrame:
    """Keys with a row at or after the mark, one row and column, and the latest time of each."""
    since = rows.crossJoin(F.broadcast(mark.select(F.col(mark.columns[0]).alias("_mark")))).where(F.col(time) >= F.col("_mark"))
    return since.groupBy(key).agg(F.max(time).alias(time), F.count("*").alias("n"))


def incremental_watermark(spark, sf_dir: str) -> DataFrame:
    """Users with events on the last seven days."""
    rows = events(spark, sf_dir)
    mark = rows.agg((F.max("ts") - F.expr("interval 7 days")).alias("mark"))
    return changed_since(rows, "user_id", "ts", mark).select("user_id", "n", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_seen"))


def trailing_counts(spark, sf_dir: str) -> DataFrame:
    """Events of each type in the last hour, day and week of the table."""
    rows = events(spark, sf_dir)
    now = rows.agg(F.max("ts").alias("now"))
    aged = rows.crossJoin(F.broadcast(now))  # one row
    within = lambda name, span: F.count_if(F.col("ts") > F.col("now") - F.expr(f"interval {span}")).alias(name)
    return aged.groupBy("event_type").agg(within("hour", "1 hour"), within("day", "1 day"), within("week", "7 days"))


def tumbling_counts(spark, sf_dir: str) -> DataFrame:
    w = events(spark, sf_dir).groupBy(F.window("ts", "6 hours"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", "total")


def sliding_counts(spark, sf_dir: str) -> DataFrame:
    w = events(spark, sf_dir).groupBy(F.window("ts", "1 day", "12 hours"), "event_type").agg(F.count("*").alias("n"))
    return w.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


def session_counts(spark, sf_dir: str) -> DataFrame:
    """Sessions of a user, parted by more than eight hours without an event."""
    w = events(spark, sf_dir).groupBy(F.session_window("ts", "8 hours"), "user_id").agg(F.count("*").alias("n"))
    return w.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start"), "n")


def json_props_agg(spark, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "map<string,double>")
    rows = events(spark, sf_dir).select("event_type", F.explode(props).alias("key", "val"))
    return rows.groupBy("event_type", "key").agg(F.count("*").alias("n"), F.round(F.sum("val"), 4).alias("total"))


def sanity_gates(spark, sf_dir: str) -> DataFrame:
    """Rows and mbids of each delivery against those of the one before."""
    s = table(spark, sf_dir, "artist_snapshot").where("serial is not null and id is not null")
    sizes = s.groupBy("serial").agg(F.count_distinct("id").alias("ids"), F.count_distinct("mbid").alias("mbids"))
    before = Window.orderBy("serial")  # as many rows as deliveries
    rated = sizes.withColumn("was", F.lag("ids").over(before)).withColumn("was_mbids", F.lag("mbids").over(before))
    return rated.select("serial", "ids", "mbids", F.coalesce((F.col("ids") >= 0.98 * F.col("was")) & (F.col("mbids") >= 0.95 * F.col("was_mbids")), F.lit(True)).alias("passes"))


def tag_latency(spark, sf_dir: str) -> DataFrame:
    """Per model and month, artists first scored then and rows computed."""
    rows = table(spark, sf_dir, "artist_tag_scores").where("artist_id is not null and computed_at is not null")
    month = F.date_format("computed_at", "yyyy-MM")
    first = rows.groupBy("model", "artist_id").agg(F.min("computed_at").alias("computed_at")).groupBy("model", month.alias("month")).agg(F.count("*").alias("artists"))
    return rows.groupBy("model", month.alias("month")).agg(F.count("*").alias("rows")).join(first, ["model", "month"], "left").select("model", "month", "rows", F.coalesce("artists", F.lit(0)).alias("artists"))


def flag_changes(breaches: DataFrame, open_flags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, action): ``open`` for a breach without a flag, ``close`` for a flag without a breach, else ``keep``; one row a key."""
    b, f = breaches.select(*keys).distinct().withColumn("_b", F.lit(True)), open_flags.select(*keys).distinct().withColumn("_f", F.lit(True))
    action = F.when(F.col("_f").isNull(), "open").when(F.col("_b").isNull(), "close").otherwise("keep")
    return b.join(f, list(keys), "full_outer").select(*keys, action.alias("action"))


def flag_lifecycle(spark, sf_dir: str) -> DataFrame:
    """Flags of users with errors: those of the second to last week are open, those of the last week are breaches."""
    errors = events(spark, sf_dir).where("event_type = 'error' and user_id is not null")
    now = F.broadcast(events(spark, sf_dir).agg(F.max("ts").alias("now")))  # one row
    aged = errors.crossJoin(now).select("user_id", (F.col("ts") > F.col("now") - F.expr("interval 7 days")).alias("new"), (F.col("ts") > F.col("now") - F.expr("interval 14 days")).alias("recent"))
    return flag_changes(aged.where("new"), aged.where("recent and not new"), ["user_id"])


def grown_keys(now: DataFrame, seen: DataFrame, key: str, n: str) -> DataFrame:
    """Keys never judged, or with more than they had when they were: what a gate has to judge again."""
    before = seen.groupBy(key).agg(F.max(n).alias("_seen"))
    return now.join(before, key, "left").where(F.col(n) > F.coalesce(F.col("_seen"), F.lit(-1))).drop("_seen")


def regate_users(spark, sf_dir: str) -> DataFrame:
    """Users who have more events than before the last day of the table."""
    rows = events(spark, sf_dir).where("user_id is not null")
    aged = rows.crossJoin(F.broadcast(rows.agg((F.max("ts") - F.expr("interval 1 day")).alias("mark"))))  # one row
    return grown_keys(aged.groupBy("user_id").agg(F.count("*").alias("n")), aged.where("ts < mark").groupBy("user_id").agg(F.count("*").alias("n")), "user_id", "n")


def stalls(spark, sf_dir: str) -> DataFrame:
    """Hours without an event of a type between hours with one: start, end and length, over one row an hour."""
    hours = events(spark, sf_dir).select("event_type", F.date_trunc("hour", "ts").alias("hour")).distinct()
    rows = hours.withColumn("was", F.lag("hour").over(Window.partitionBy("event_type").orderBy("hour")))
    gap = (F.unix_timestamp("hour") - F.unix_timestamp("was")) / 3600 - 1
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return rows.where(gap >= 1).select("event_type", text(F.col("was")).alias("last_before"), text(F.col("hour")).alias("first_after"), gap.cast("int").alias("hours"))


def stale_users(spark, sf_dir: str) -> DataFrame:
    """Users silent for more than a day at the end of the table, and for how many whole hours."""
    rows = events(spark, sf_dir)
    last = rows.where("user_id is not null").groupBy("user_id").agg(F.max("ts").alias("last")).crossJoin(F.broadcast(rows.agg(F.max("ts").alias("now"))))  # one row
    return last.where(F.col("now") - F.expr("interval 1 day") > F.col("last")).select("user_id", F.floor((F.unix_micros("now") - F.unix_micros("last")) / 3600000000).cast("int").alias("hours"))


_E = "e as (select * from events), a as (select * from e where event_id % 2 = 0), b as (select * from e where event_id % 2 = 1)"
QUERIES = {
    f.__name__: f
    for f in (latest_wins_upsert, insert_if_absent, replace_wholesale, field_merge, incremental_watermark, trailing_counts, tumbling_counts, sliding_counts, session_counts, json_props_agg, sanity_gates, tag_latency, flag_lifecycle, regate_users, stalls, stale_users)
}
SQL = {
    "latest_wins_upsert": "select user_id, event_type, event_id, round(value, 6) as value from (select *, row_number() over (partition by user_id, event_type order by ts desc, value desc, event_id desc) as rn from events) where rn = 1",
    "insert_if_absent": f"""with {_E}, x as (select user_id, ts::date as day, min(event_id) as event_id from a group by all), y as (select user_id, ts::date as day, min(event_id) as event_id from b group by all)
      select user_id, strftime(day, '%Y-%m-%d') as day, event_id from (select * from x union all select * from y where (user_id, day) not in (select (user_id, day) from x))""",
    "replace_wholesale": f"with {_E}, n as (select user_id, event_type, event_id from b where value > 50) select user_id, event_type, event_id from a where (user_id, event_type) not in (select (user_id, event_type) from n) union all select * from n",
    "field_merge": """with o as (select distinct id, status, mbid, embedding_source from artist where id is not null),
      n as (select * from (select *, row_number() over (partition by id order by serial desc nulls last, delivered_at desc nulls last, status desc nulls last, mbid desc nulls last, embedding_source desc nulls last) as rn from artist_snapshot where id is not null) where rn = 1)
      select coalesce(n.id, o.id) as id, case when n.id is not null then n.status else o.status end as status, coalesce(n.mbid, o.mbid) as mbid, coalesce(n.embedding_source, o.embedding_source) as embedding_source from o full join n on o.id = n.id""",
    "incremental_watermark": "select user_id, count(*) as n, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_seen from events where ts >= (select max(ts) - interval 7 days from events) group by 1",
    "trailing_counts": "with n as (select max(ts) as now from events) select event_type, count(*) filter (where ts > now - interval 1 hour) as hour, count(*) filter (where ts > now - interval 1 day) as day, count(*) filter (where ts > now - interval 7 days) as week from events, n group by 1",
    "tumbling_counts": "select strftime(time_bucket(interval 6 hours, ts, timestamp '1970-01-01'), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
    "sliding_counts": "select strftime(time_bucket(interval 12 hours, ts, timestamp '1970-01-01') - s * interval 12 hours, '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as n from events, (values (0), (1)) x(s) group by 1, 2",
    "session_counts": """with g as (select *, case when ts >= lag(ts) over w + interval 8 hours then 1 else 0 end as new from events window w as (partition by user_id order by ts)), s as (select *, sum(new) over (partition by user_id order by ts) as k from g)
      select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as start, count(*) as n from s group by user_id, k""",
    "json_props_agg": "select event_type, key, count(*) as n, round(sum(val), 4) as total from (select event_type, unnest(json_keys(props)) as key, unnest(list_transform(json_keys(props), lambda k: json_extract(props, '$.' || k)::double)) as val from events) group by all",
    "sanity_gates": """with s as (select serial, count(distinct id) as ids, count(distinct mbid) as mbids from artist_snapshot where serial is not null and id is not null group by 1), r as (select *, lag(ids) over (order by serial) as was, lag(mbids) over (order by serial) as was_mbids from s)
      select serial, ids, mbids, coalesce(ids >= 0.98 * was and mbids >= 0.95 * was_mbids, true) as passes from r""",
    "tag_latency": """with r as (select * from artist_tag_scores where artist_id is not null and computed_at is not null), f as (select model, strftime(c, '%Y-%m') as month, count(*) as artists from (select model, artist_id, min(computed_at) as c from r group by all) group by all)
      select model, month, rows, coalesce(artists, 0) as artists from (select model, strftime(computed_at, '%Y-%m') as month, count(*) as rows from r group by all) left join f using (model, month)""",
    "flag_lifecycle": """with n as (select max(ts) as now from events), e as (select distinct user_id, ts > now - interval 7 days as new from events, n where event_type = 'error' and user_id is not null and ts > now - interval 14 days)
      select user_id, case when not bool_or(not new) then 'open' when not bool_or(new) then 'close' else 'keep' end as action from e group by 1""",
    "regate_users": "select user_id, count(*) as n from events where user_id is not null group by 1 having max(ts) >= (select max(ts) - interval 1 day from events where user_id is not null)",
    "stalls": """with h as (select distinct event_type, date_trunc('hour', ts) as hour from events), g as (select *, lag(hour) over (partition by event_type order by hour) as was from h)
      select event_type, strftime(was, '%Y-%m-%d %H:%M:%S') as last_before, strftime(hour, '%Y-%m-%d %H:%M:%S') as first_after, (datediff('hour', was, hour) - 1)::int as hours from g where hour > was + interval 1 hour""",
    "stale_users": "select user_id, floor((epoch_us((select max(ts) from events)) - epoch_us(max(ts))) / 3600000000)::int as hours from events where user_id is not null group by 1 having max(ts) < (select max(ts) - interval 1 day from events)",
}
