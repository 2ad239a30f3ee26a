"""A catalogue brought up to date from a delivery: records matched by either key, redirects followed, what is pending or stale."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle, table
from .entities import artists, pages
from .history import merge_fields
from .vectors import block_search, norm


def upsert_by_either(kept: DataFrame, new: DataFrame, replaced: Sequence[str], filled: Sequence[str], time: str) -> DataFrame:
    """``kept``, (id, mbid, fields), with the rows of ``new``, which also have ``time``: a row belongs to the record with
    its mbid or, where none has it, to the one with its id; else it is a record of its own.

    Of several rows for one record the latest holds. ``replaced`` fields are the new row's, ``filled`` ones keep the
    old value where the new one is null, as does the mbid. Rows without an id and ids in ``kept`` are whole.
    """
    fields = [*replaced, *filled]
    rows = new.where("id is not null").select("id", "mbid", *fields, time)
    by_mbid = rows.join(kept.where("mbid is not null").groupBy("mbid").agg(F.min("id").alias("_record")), "mbid", "left")
    named = by_mbid.withColumn("_record", F.coalesce("_record", "id"))
    held = named.groupBy("_record").agg(F.max(F.struct(time, "mbid", *fields)).alias("h")).select(F.col("_record").alias("id"), "h.mbid", *(F.col(f"h.{c}").alias(c) for c in fields))
    return merge_fields(kept.select("id", "mbid", *fields), held, ["id"], replaced, ["mbid", *filled])


def artist_upsert(spark, sf_dir: str) -> DataFrame:
    """The artists with all that their snapshots say: names and status replaced, sources filled in."""
    kept = artists(spark, sf_dir).select("id", F.nullif("mbid", F.lit("")).alias("mbid"), "display_name", "status", "embedding_source")
    s = table(spark, sf_dir, "artist_snapshot").where("delivered_at is not null")
    new = s.select("id", F.nullif("mbid", F.lit("")).alias("mbid"), "display_name", "status", "embedding_source", F.struct("delivered_at", "serial", "id").alias("at"))
    return upsert_by_either(kept, new, ["display_name", "status"], ["embedding_source"], "at")


def resolve_redirects(edges: DataFrame) -> DataFrame:
    """(source, final): where following (source, target) ends; null for what leads into a circle.

    A source with several targets goes to the least. Each round doubles the steps taken, so there are as many rounds as
    the longest chain has binary digits.
    """
    once = edges.where("source <> target").groupBy("source").agg(F.min("target").alias("target"))
    now = settle(once.select("source", "target", F.lit(True).alias("moving")))
    steps, most = 1, now.count()
    while steps <= 2 * most:
        ahead = now.select(F.col("source").alias("target"), F.col("target").alias("further"))
        now = settle(now.join(ahead, "target", "left").select("source", F.coalesce("further", "target").alias("target"), F.col("further").isNotNull().alias("moving")))
        steps *= 2
        if now.where("moving").isEmpty():
            break
    return now.select("source", F.when(~F.col("moving"), F.col("target")).alias("final"))


def mbid_redirects(spark, sf_dir: str) -> DataFrame:
    """(source, target): mbids that an artist had in one delivery and another one in the next that it is in."""
    s = table(spark, sf_dir, "artist_snapshot").where("serial is not null and id is not null and mbid <> ''")
    held = s.groupBy("serial", "id").agg(F.max(F.struct("delivered_at", "mbid"))["mbid"].alias("mbid"))
    was = F.lag("mbid").over(Window.partitionBy("id").orderBy("serial"))
    return held.withColumn("was", was).where("was <> mbid").select(F.col("was").alias("source"), F.col("mbid").alias("target")).distinct()


def redirect_ends(spark, sf_dir: str) -> DataFrame:
    return resolve_redirects(mbid_redirects(spark, sf_dir))


def refresh_actions(spark, sf_dir: str) -> DataFrame:
    """What the last delivery means for the live artists with an mbid: ``add``, ``rename``, ``keep``, ``merge`` into the
    record that redirects lead to, or ``review`` where it is gone without trace."""
    s = table(spark, sf_dir, "artist_snapshot").where("serial is not null and id is not null and mbid <> ''")
    last = s.join(F.broadcast(s.agg(F.max("serial").alias("last"))), F.col("serial") == F.col("last"))  # one row
    next_ = last.groupBy("mbid").agg(F.min("display_name").alias("name"), F.lit(True).alias("there"))
    live = artists(spark, sf_dir).where("mbid <> ''").groupBy("mbid").agg(F.min("display_name").alias("live_name"), F.lit(True).alias("known"))
    both = next_.join(live, "mbid", "full_outer")
    ends = redirect_ends(spark, sf_dir).join(next_.select(F.col("mbid").alias("final")), "final", "left_semi").select(F.col("source").alias("mbid"), F.col("final").alias("into"))
    found = both.join(ends, "mbid", "left")
    action = (
        F.when(F.col("known").isNull(), "add").when(F.col("there").isNull() & F.col("into").isNotNull(), "merge").when(F.col("there").isNull(), "review")
        .when(F.col("name").eqNullSafe(F.col("live_name")), "keep").otherwise("rename")
    )
    return found.select("mbid", action.alias("action"), F.when(action == "merge", F.col("into")).alias("into"))


def stale_vectors(spark, sf_dir: str) -> DataFrame:
    """Artists and models of which a vector is missing, or older than the model's median time: heads by records."""
    v = table(spark, sf_dir, "artist_embedding").where("artist_id is not null and model is not null").groupBy("artist_id", "model").agg(F.max("computed_at").alias("t"))
    required = v.groupBy("model").agg(F.expr("percentile_disc(0.5) within group (order by unix_micros(t))").alias("since"))
    wanted = artists(spark, sf_dir).select(F.col("id").alias("artist_id")).crossJoin(F.broadcast(required))  # a row a model
    rows = wanted.join(v, ["artist_id", "model"], "left")
    return rows.where("t is null or unix_micros(t) < since").select("artist_id", "model", F.when(F.col("t").isNull(), "missing").otherwise("old").alias("state"))


def pending_pages(spark, sf_dir: str) -> DataFrame:
    """Pages found by a search with several candidates whose artist has no vector."""
    told = pages(spark, sf_dir).where("artist_id is not null").select("id", "artist_id", F.get_json_object("binding_evidence", "$.candidates_total").try_cast("int").alias("total"))
    return told.where("total > 1").join(table(spark, sf_dir, "artist_embedding").select("artist_id"), "artist_id", "left_anti").select("id", "artist_id", "total")


def uncorroborated_pages(spark, sf_dir: str) -> DataFrame:
    """Pages of artists that had no page on another platform before: an anti-join with a residual test, by the two earliest
    platforms of an artist."""
    p = pages(spark, sf_dir).where("artist_id is not null and first_seen_at is not null").select("id", "artist_id", "platform", "first_seen_at")
    first = p.groupBy("artist_id", "platform").agg(F.min("first_seen_at").alias("t"))
    a, b = p.alias("a"), first.alias("b")
    return a.join(b, (F.col("a.artist_id") == F.col("b.artist_id")) & (F.col("a.platform") != F.col("b.platform")) & (F.col("b.t") < F.col("a.first_seen_at")), "left_anti").select("id", "artist_id", "platform")


def both_ends(spark, sf_dir: str) -> DataFrame:
    """The 50 pages seen first and the 50 seen last: two limited frames united."""
    p = pages(spark, sf_dir).where("first_seen_at is not null").select("id", "first_seen_at")
    ends = [p.orderBy(*order).limit(50).select("id", F.lit(end).alias("end")) for end, order in (("first", ["first_seen_at", "id"]), ("last", [F.desc("first_seen_at"), "id"]))]
    return reduce(DataFrame.unionByName, ends)


def zeroed_means(spark, sf_dir: str) -> DataFrame:
    """The mean of each coordinate of a model's latest vectors of its length, with 0 for null, NaN and infinite values."""
    held = table(spark, sf_dir, "artist_embedding").groupBy("artist_id", "model").agg(F.max(F.struct("computed_at", "dim", "embedding")).alias("h")).where("size(h.embedding) = h.dim")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    zeroed = F.transform("h.embedding", lambda x: F.when(odd(x), 0.0).otherwise(x.cast("double")))
    cells = held.select("model", F.posexplode(zeroed).alias("pos", "x"))
    return cells.groupBy("model", "pos").agg(F.round(F.avg("x"), 5).alias("mean"), F.count("*").alias("n"))


def nearest_centroids(spark, sf_dir: str) -> DataFrame:
    """For every vector the three labels with the most similar centroids: a dense top-k against a vocabulary."""
    rows = table(spark, sf_dir, "embeddings").where("embedding is not null").select("vec_id", "label", "embedding").dropDuplicates(["vec_id"])
    def unit(side: DataFrame, v: str) -> DataFrame:
        return settle(side.withColumn("len", norm(F.col(v))).where("len > 0").select("vec_id", F.transform(v, lambda x: x / F.col("len")).alias("v")))

    cells = rows.where("label is not null").select("label", F.posexplode("embedding").alias("pos", "x")).groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    centroids = cells.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("c")).select(F.col("label").cast("long").alias("vec_id"), F.col("c.x").alias("v"))
    asked = rows.select((-1 - F.col("vec_id").cast("long")).alias("vec_id"), "embedding")  # no id is a label's
    near = block_search(unit(asked, "embedding"), unit(centroids, "v"), 3)
    return near.select((-1 - F.col("vec_id")).alias("vec_id"), F.col("near_id").alias("label"), "sim", "place")


def vector_texts(spark, sf_dir: str) -> DataFrame:
    """Clip vectors written as text in brackets and read again: per model how many there are and the sum of the first values read."""
    clips = table(spark, sf_dir, "clip_embedding").where("embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) > 1e30)").select("id", "model", "embedding").dropDuplicates(["id"])
    text = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: F.format_string("%.6f", x.cast("double"))), ","), F.lit("]"))
    read = clips.select("model", F.size("embedding").alias("size"), F.from_json(text, "array<double>").alias("v"))
    return read.groupBy("model").agg(F.count("*").alias("n"), F.count_if(F.size("v") == F.col("size")).alias("whole"), F.round(F.sum(F.col("v")[0]), 3).alias("first_sum"))


_A = "a as (select distinct * from artist where id is not null)"
_P = "p as (select distinct * from platform_identity where id is not null)"
_S = "s as (select * from artist_snapshot where serial is not null and id is not null and mbid <> '')"
_EDGES = f"""{_S}, hs as (select *, row_number() over (partition by serial, id order by delivered_at desc nulls last, mbid desc) as rn from s),
  l as (select mbid, lag(mbid) over (partition by id order by serial) as was from hs where rn = 1), e as (select was as source, min(mbid) as target from l where was <> mbid group by 1),
  w as (select source, target, 1 as k from e union all select w.source, e.target, k + 1 from w join e on w.target = e.source where k <= (select count(*) from e)),
  ends as (select source, case when max(k) <= (select count(*) from e) then max_by(target, k) end as final from w group by 1)"""
QUERIES = {f.__name__: f for f in (artist_upsert, redirect_ends, refresh_actions, stale_vectors, pending_pages, uncorroborated_pages, both_ends, zeroed_means, nearest_centroids, vector_texts)}
SQL = {
    "artist_upsert": f"""with {_A}, n as (select *, nullif(mbid, '') as m from artist_snapshot where id is not null and delivered_at is not null),
      k as (select mbid as m, min(id) as record from a where mbid <> '' group by 1), r as (select coalesce(record, id) as record, n.* from n left join k using (m)),
      h as (select * from (select *, row_number() over (partition by record order by delivered_at desc, serial desc nulls last, id desc, m desc nulls last, display_name desc nulls last, status desc nulls last, embedding_source desc nulls last) as rn from r) where rn = 1)
      select coalesce(h.record, a.id) as id, coalesce(h.m, nullif(a.mbid, '')) as mbid, case when h.record is not null then h.display_name else a.display_name end as display_name,
        case when h.record is not null then h.status else a.status end as status, coalesce(h.embedding_source, a.embedding_source) as embedding_source from a full join h on h.record = a.id""",
    "redirect_ends": f"with recursive {_EDGES} select * from ends",
    "refresh_actions": f"""with recursive {_A}, {_EDGES}, n as (select mbid, min(display_name) as name from s where serial = (select max(serial) from s) group by 1), v as (select mbid, min(display_name) as live_name, true as known from a where mbid <> '' group by 1),
      g as (select mbid, case when v.known is null then 'add' when n.mbid is null and final in (select mbid from n) then 'merge' when n.mbid is null then 'review' when name is not distinct from live_name then 'keep' else 'rename' end as action, final
        from (select mbid from n union select mbid from v) left join n using (mbid) left join v using (mbid) left join ends on source = mbid) select mbid, action, case when action = 'merge' then final end as into from g""".replace("left join n using (mbid) left join v", "left join (select *, mbid as nm from n) n using (mbid) left join v").replace("n.mbid is null", "nm is null"),
    "stale_vectors": f"""with {_A}, v as (select artist_id, model, max(computed_at) as t from artist_embedding where artist_id is not null and model is not null group by all), q as (select model, quantile_disc(t, 0.5) as since from v group by 1)
      select a.id as artist_id, q.model, case when t is null then 'missing' else 'old' end as state from a cross join q left join v on v.artist_id = a.id and v.model = q.model where t is null or t < since""",
    "pending_pages": f"with {_P}, t as (select id, artist_id, try_cast(json_extract_string(binding_evidence, '$.candidates_total') as int) as total from p where artist_id is not null) select * from t where total > 1 and artist_id not in (select artist_id from artist_embedding where artist_id is not null)",
    "uncorroborated_pages": f"with {_P} select id, artist_id, platform from p where artist_id is not null and first_seen_at is not null and not exists (select 1 from p q where q.artist_id = p.artist_id and q.platform <> p.platform and q.first_seen_at < p.first_seen_at)",
    "both_ends": f"with {_P}, w as (select * from p where first_seen_at is not null) select * from (select id, 'first' as end from w order by first_seen_at, id limit 50) union all select * from (select id, 'last' from w order by first_seen_at desc, id limit 50)".replace("as end", 'as "end"'),
    "zeroed_means": """with h as (select *, row_number() over (partition by artist_id, model order by computed_at desc nulls last, dim desc, embedding desc) as rn from artist_embedding)
      select model, pos::int as pos, round(avg(case when x is null or isnan(x) or isinf(x) then 0 else x end), 5) as mean, count(*) as n from (select model, unnest(range(0, len(embedding))) as pos, unnest(embedding)::double as x from h where rn = 1 and len(embedding) = dim) group by all""",
    "nearest_centroids": """with e as (select distinct on (vec_id) vec_id, label, embedding::double[] as v from embeddings where embedding is not null), c as (select label, list(m order by pos) as m from (select label, pos, avg(x) as m from (select label, unnest(range(0, len(v))) as pos, unnest(v) as x from e where label is not null) group by all) group by 1),
      s as (select vec_id, c.label::bigint as label, round(list_cosine_similarity(v, m), 6) as sim from e cross join c), k as (select *, row_number() over (partition by vec_id order by sim desc, label) as place from s) select vec_id, label, sim, place::int as place from k where place <= 3""",
    "vector_texts": """with c as (select distinct on (id) id, model, embedding as v from clip_embedding where len(embedding) > 0 and not list_bool_or(list_transform(embedding, lambda x: x is null or isnan(x) or abs(x) > 1e30)))
      select model, count(*) as n, count(*) as whole, round(sum(round(v[1]::double, 6)), 3) as first_sum from c group by 1""",
}
