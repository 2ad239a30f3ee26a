"""The serving side of the catalogue: what is complete, what changed since, addresses, and refreshes compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import table
from .entities import artists, candidates, pages, sql_key
from .vectors import sound_vectors

# Where a platform's address holds the id of a page, and how an address is built from it.
PLATFORM_PATTERNS = {
    "deezer": r"deezer\.com/(?:[a-z]{2}/)?artist/([0-9]+)",
    "bandcamp": r"^https?://([a-z0-9][a-z0-9-]*)\.bandcamp\.com",
    "soundcloud": r"soundcloud\.com/([a-zA-Z0-9_-]+)",
    "youtube": r"youtube\.com/channel/([A-Za-z0-9_-]+)",
    "tidal": r"tidal\.com/(?:browse/)?artist/([0-9]+)",
    "apple_music": r"music\.apple\.com/[a-z]{2}/artist/(?:[^/]+/)?([0-9]+)",
    "qobuz": r"qobuz\.com/(?:[a-z]{2}-[a-z]{2}/interpreter/[^/]+|artist)/([0-9]+)",
}
PLATFORM_ADDRESSES = {
    "deezer": ("https://www.deezer.com/artist/", ""),
    "bandcamp": ("https://", ".bandcamp.com"),
    "soundcloud": ("https://soundcloud.com/", ""),
    "youtube": ("https://www.youtube.com/channel/", ""),
    "tidal": ("https://tidal.com/browse/artist/", ""),
}


def platform_ids(url: Column) -> Column:
    """(platform, platform_id) of an address, for each platform whose pattern it holds; an empty array if for none, or null."""
    found = [F.struct(F.lit(name).alias("platform"), F.nullif(F.regexp_extract(url, pattern, 1), F.lit("")).alias("platform_id")) for name, pattern in PLATFORM_PATTERNS.items()]
    return F.filter(F.array(*found), lambda x: x["platform_id"].isNotNull())


def platform_address(platform: Column, platform_id: Column) -> Column:
    """The address of a page; null for a platform without one."""
    known = [(platform == name, F.concat(F.lit(head), platform_id, F.lit(tail))) for name, (head, tail) in PLATFORM_ADDRESSES.items()]
    return reduce(lambda c, k: c.when(*k), known[1:], F.when(*known[0]))


def page_addresses(spark, sf_dir: str) -> DataFrame:
    """One row an artist with a column a platform: the address of its page with the least id there."""
    bound = pages(spark, sf_dir).where("artist_id is not null and platform_id is not null").select("artist_id", "platform", platform_address(F.col("platform"), F.col("platform_id")).alias("url"))
    kinds = ["bandcamp", "deezer", "soundcloud", "youtube"]
    return bound.groupBy("artist_id").pivot("platform", kinds).agg(F.min("url")).select("artist_id", *(F.col(k).alias(f"{k}_url") for k in kinds))


def address_round_trip(spark, sf_dir: str) -> DataFrame:
    """Platforms found again in the addresses built from their ids, with the number of equal and of other ids."""
    built = pages(spark, sf_dir).where("platform_id is not null").select("platform", "platform_id", platform_address(F.col("platform"), F.col("platform_id")).alias("url"))
    read = built.select("platform", "platform_id", F.explode(platform_ids(F.col("url"))).alias("r"))
    return read.groupBy("platform", F.col("r.platform").alias("read_as")).agg(F.count("*").alias("n"), F.count_if(F.col("r.platform_id") == F.col("platform_id")).alias("equal_ids"))


def widget_ids(spark, sf_dir: str) -> DataFrame:
    """The first three page ids of each artist and platform as a JSON array."""
    rows = pages(spark, sf_dir).where("artist_id is not null and platform_id is not null").select("artist_id", "platform", "platform_id").distinct()
    place = F.row_number().over(Window.partitionBy("artist_id", "platform").orderBy("platform_id"))
    few = rows.withColumn("place", place).where("place <= 3")
    return few.groupBy("artist_id", "platform").agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("place", "platform_id"))), lambda x: x["platform_id"])).alias("ids"))


def complete_set(spark, sf_dir: str) -> DataFrame:
    """Artists with a sound base vector, but not those that a hidden record names, by id or by mbid: two anti-joins."""
    vectors = sound_vectors(spark, sf_dir).where("model = 'auralis-base'").select(F.col("artist_id").alias("id"))
    hidden = artists(spark, sf_dir).where("status = 'hidden'")
    rows = artists(spark, sf_dir).select("id", "mbid", "embedding_source").join(vectors, "id", "left_semi")
    rows = rows.join(hidden.select("id"), "id", "left_anti")
    return rows.join(hidden.where("mbid is not null").select("mbid"), "mbid", "left_anti").select("id", "mbid", "embedding_source")


def changed_artists(spark, sf_dir: str) -> DataFrame:
    """Artists with a vector, a score or a wish to be published anew in the last 30 days of the table: three equi branches."""
    scores = table(spark, sf_dir, "artist_tag_scores").where("artist_id is not null").select(F.col("artist_id").alias("id"), F.col("computed_at").alias("t"))
    vectors = table(spark, sf_dir, "artist_embedding").where("artist_id is not null").select(F.col("artist_id").alias("id"), F.col("computed_at").alias("t"))
    asked = artists(spark, sf_dir).select("id", F.col("republish_requested_at").alias("t"))
    mark = F.broadcast(scores.agg((F.max("t") - F.expr("interval 30 days")).alias("mark")))  # one row
    branches = [
        rows.crossJoin(mark).where("t >= mark").groupBy("id").agg(F.lit(why).alias("why"), F.max("t").alias("t")) for rows, why in ((scores, "scores"), (vectors, "vector"), (asked, "asked"))
    ]
    rows = reduce(DataFrame.unionByName, branches).groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("why")), "+").alias("why"), F.max("t").alias("t"))
    return rows.join(artists(spark, sf_dir).select("id"), "id", "left_semi").select("id", "why", F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("last_change"))


def hidden_candidates(spark, sf_dir: str) -> DataFrame:
    """Candidates that a hidden artist covers: by one of its pages or, for an artist without pages, by name."""
    hidden = artists(spark, sf_dir).where("status = 'hidden'").select(F.col("id").alias("artist_id"), sql_key(F.col("display_name")).alias("key"))
    owned = pages(spark, sf_dir).where("artist_id is not null").select("artist_id", "platform", "platform_id")
    c = candidates(spark, sf_dir).select("id", "platform_id", sql_key(F.col("band_name")).alias("key"))
    by_page = c.join(owned.where("platform = 'bandcamp'").join(hidden, "artist_id", "left_semi"), "platform_id").select("id", "artist_id", F.lit("page").alias("via"))
    bare = hidden.where("key <> ''").join(owned.select("artist_id"), "artist_id", "left_anti")
    return by_page.unionByName(c.join(bare, "key").select("id", "artist_id", F.lit("name").alias("via"))).distinct()


def unbound_artists(spark, sf_dir: str) -> DataFrame:
    """Artists without a page on three platforms that were looked at in vain fewer than three times."""
    p = pages(spark, sf_dir).where("artist_id is not null")
    bound = p.where("platform in ('deezer', 'bandcamp', 'soundcloud')").select(F.col("artist_id").alias("id"))
    vain = p.where("scan_status = 'empty'").groupBy(F.col("artist_id").alias("id")).agg(F.count("*").alias("n"))
    rest = artists(spark, sf_dir).select("id").join(bound, "id", "left_anti").join(vain, "id", "left")
    return rest.select("id", F.coalesce("n", F.lit(0)).alias("tries")).where("tries < 3")


def queue_counts(spark, sf_dir: str) -> DataFrame:
    """Artists that wait for a look, by whether a fast platform is among them and whether they have an mbid."""
    waiting = pages(spark, sf_dir).where("artist_id is not null and scan_status = 'pending'").groupBy("artist_id").agg(F.bool_or(F.col("platform") != "youtube").alias("fast"))
    joined = waiting.join(artists(spark, sf_dir).select(F.col("id").alias("artist_id"), "mbid"), "artist_id")
    return joined.groupBy("fast", F.col("mbid").isNull().alias("provisional")).agg(F.count("*").alias("n"))


def tier_counts(spark, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).groupBy("platform", "binding_tier", "scan_status").agg(F.count("*").alias("n"), F.count("artist_id").alias("bound"))


def refresh_diff_counts(spark, sf_dir: str) -> DataFrame:
    """Each delivery against the live artists, by mbid: records to add, names that differ byte for byte, equal ones."""
    s = table(spark, sf_dir, "artist_snapshot").where("serial is not null and id is not null and mbid <> ''")
    held = s.groupBy("serial", "id").agg(F.max(F.struct("delivered_at", "display_name", "mbid")).alias("h"))
    per = held.groupBy("serial", F.col("h.mbid").alias("mbid")).agg(F.min("h.display_name").alias("name"))
    live = artists(spark, sf_dir).where("mbid <> ''").groupBy("mbid").agg(F.min("display_name").alias("live_name"), F.lit(True).alias("known"))
    same = F.col("name").eqNullSafe(F.col("live_name"))
    return per.join(live, "mbid", "left").groupBy("serial").agg(
        F.count_if(F.col("known").isNull()).alias("adds"), F.count_if(F.col("known") & ~same).alias("renames"), F.count_if(F.col("known") & same).alias("equal")
    )


def run_ledger(spark, sf_dir: str) -> DataFrame:
    """Runs of each serial, dry ones too, with their counts summed and whether every gate of the JSON was passed."""
    gates = F.from_json("gates", "struct<artists:struct<current:bigint,next:bigint,ok:boolean>,ok:boolean>")
    runs = table(spark, sf_dir, "mb_refresh_run").where("id is not null").dropDuplicates(["id"]).withColumn("g", gates)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return runs.groupBy("serial").agg(
        F.count("*").alias("runs"), F.count("applied_at").alias("applied"), total("adds"), total("new_identities"), total("renames"), F.max("g.artists.next").alias("artists"), F.coalesce(F.bool_and("g.ok"), F.lit(False)).alias("passed")
    )


_A = "a as (select distinct * from artist where id is not null)"
_C = "c as (select id, max(platform_id) as platform_id, max(band_name) as band_name from bc_candidate where id is not null group by 1)"
_P = "p as (select distinct * from platform_identity where id is not null)"
_KEY = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"
_URL = "case platform " + " ".join(f"when '{k}' then '{h}' || platform_id || '{t}'" for k, (h, t) in PLATFORM_ADDRESSES.items()) + " end"
_READ = " union all ".join(f"select platform, platform_id, '{k}' as read_as, regexp_extract(url, '{v}', 1) as got from u" for k, v in PLATFORM_PATTERNS.items())
QUERIES = {f.__name__: f for f in (page_addresses, address_round_trip, widget_ids, complete_set, changed_artists, hidden_candidates, unbound_artists, queue_counts, tier_counts, refresh_diff_counts, run_ledger)}
SQL = {
    "page_addresses": f"""with {_P}, u as (select artist_id, platform, {_URL} as url from p where artist_id is not null and platform_id is not null) select artist_id, min(url) filter (where platform = 'bandcamp') as bandcamp_url,
      min(url) filter (where platform = 'deezer') as deezer_url, min(url) filter (where platform = 'soundcloud') as soundcloud_url, min(url) filter (where platform = 'youtube') as youtube_url from u group by 1""",
    "address_round_trip": f"with {_P}, u as (select platform, platform_id, {_URL} as url from p where platform_id is not null), r as ({_READ}) select platform, read_as, count(*) as n, count(*) filter (where got = platform_id) as equal_ids from r where got <> '' group by all",
    "widget_ids": f"""with {_P}, d as (select distinct artist_id, platform, platform_id from p where artist_id is not null and platform_id is not null), k as (select *, row_number() over (partition by artist_id, platform order by platform_id) as place from d)
      select artist_id, platform, to_json(list(platform_id order by place))::varchar as ids from k where place <= 3 group by all""",
    "complete_set": f"""with {_A}, h as (select *, row_number() over (partition by artist_id, model order by computed_at desc nulls last, dim desc, embedding desc) as rn from artist_embedding where model = 'auralis-base'),
      sv as (select artist_id from h where rn = 1 and len(embedding) = dim and not list_bool_or(list_transform(embedding, lambda x: x is null or isnan(x) or isinf(x))) and list_sum(list_transform(embedding, lambda x: x::double * x::double)) > 0)
      select id, mbid, embedding_source from a where id in (select artist_id from sv) and status is distinct from 'hidden' and (mbid is null or mbid not in (select mbid from a where status = 'hidden' and mbid is not null))""",
    "changed_artists": f"""with {_A}, m as (select max(computed_at) - interval 30 days as mark from artist_tag_scores where artist_id is not null), u as (select artist_id as id, computed_at as t, 'scores' as why from artist_tag_scores
      union all select artist_id, computed_at, 'vector' from artist_embedding union all select id, republish_requested_at, 'asked' from a)
      select id, string_agg(distinct why, '+' order by why) as why, strftime(max(t)::timestamp, '%Y-%m-%d %H:%M:%S') as last_change from u, m where t >= mark and id in (select id from a) group by 1""",
    "hidden_candidates": f"""with {_A}, {_C}, {_P}, h as (select id, {_KEY.format('display_name')} as key from a where status = 'hidden') select distinct c.id, p.artist_id, 'page' as via from c join p using (platform_id) where p.platform = 'bandcamp' and p.artist_id in (select id from h)
      union select c.id, h.id, 'name' from c join h on {_KEY.format('c.band_name')} = h.key where h.key <> '' and h.id not in (select artist_id from p where artist_id is not null)""",
    "unbound_artists": f"""with {_A}, {_P} select id, (select count(*) from p where artist_id = a.id and scan_status = 'empty') as tries from a
      where id not in (select artist_id from p where artist_id is not null and platform in ('deezer', 'bandcamp', 'soundcloud')) and (select count(*) from p where artist_id = a.id and scan_status = 'empty') < 3""",
    "queue_counts": f"with {_A}, {_P}, w as (select artist_id, bool_or(platform <> 'youtube') as fast from p where artist_id is not null and scan_status = 'pending' group by 1) select fast, mbid is null as provisional, count(*) as n from w join a on a.id = w.artist_id group by all",
    "tier_counts": f"with {_P} select platform, binding_tier, scan_status, count(*) as n, count(artist_id) as bound from p group by all",
    "refresh_diff_counts": f"""with {_A}, h as (select *, row_number() over (partition by serial, id order by delivered_at desc nulls last, display_name desc nulls last, mbid desc) as rn from artist_snapshot where serial is not null and id is not null and mbid <> ''),
      s as (select serial, mbid, min(display_name) as name from h where rn = 1 group by all), l as (select mbid, min(display_name) as live_name, true as known from a where mbid <> '' group by 1)
      select serial, count(*) filter (where known is null) as adds, count(*) filter (where known and name is distinct from live_name) as renames, count(*) filter (where known and name is not distinct from live_name) as equal from s left join l using (mbid) group by 1""",
    "run_ledger": """with r as (select distinct on (id) * from mb_refresh_run where id is not null) select serial, count(*) as runs, count(applied_at) as applied, coalesce(sum(adds), 0)::bigint as adds, coalesce(sum(new_identities), 0)::bigint as new_identities, coalesce(sum(renames), 0)::bigint as renames,
      max(json_extract(gates, '$.artists.next')::bigint) as artists, coalesce(bool_and(json_extract(gates, '$.ok')::boolean), false) as passed from r group by 1""",
}
