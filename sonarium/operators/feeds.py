"""The readers of dumps and payloads over whole tables, written in the shapes they read, and the identities that claims give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path, table
from ..sources import dumps, payloads
from .entities import artists, pages, vanity_extract


def dump_read(spark, sf_dir: str) -> DataFrame:
    """The artists written as a dump into the shared folder and read again."""
    rows = artists(spark, sf_dir).select("id", "display_name", "mbid", (F.col("status") == "active").alias("live"), F.unix_micros("updated_at").alias("micros"))
    path = fresh_path(spark, "dump")
    dumps.write_dump(rows, path)
    types = (T.StringType(), T.StringType(), T.StringType(), T.BooleanType(), T.LongType())
    return dumps.read_dump(spark, path, T.StructType([T.StructField(c, t) for c, t in zip(rows.columns, types)]))


def payload_hits(spark, sf_dir: str) -> DataFrame:
    """The pages as answers to searches, each in its platform's shape, and the hits read from them."""
    told = lambda key: F.get_json_object("binding_evidence", f"$.{key}")
    name, page, fans = told("candidate_name"), F.col("platform_id"), told("popularity").try_cast("bigint")
    body = (
        F.when(F.col("platform") == "deezer", F.to_json(F.struct(F.array(F.struct(name.alias("name"), page.alias("id"), fans.alias("nb_fan"))).alias("data"))))
        .when(F.col("platform") == "bandcamp", F.to_json(F.struct(F.struct(F.array(F.struct(F.lit("b").alias("type"), name.alias("name"), F.concat(F.lit("https://"), page, F.lit(".bandcamp.com")).alias("item_url_root"))).alias("results")).alias("auto"))))
        .when(F.col("platform") == "soundcloud", F.to_json(F.struct(F.array(F.struct(name.alias("username"), page.alias("permalink"), fans.alias("track_count"))).alias("collection"))))
    )
    return payloads.search_hits(pages(spark, sf_dir).select("id", "platform", body.alias("body")), ["id"]).drop("place")


def _clips(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "clip_embedding").where("id is not null").select("id", "model", "track_id", "segment_start_s", "segment_end_s").dropDuplicates(["id"])


def payload_streams(spark, sf_dir: str) -> DataFrame:
    """Clips as lists of tracks in milliseconds, and those read from them that may be streamed."""
    track = F.struct("id", F.col("track_id").alias("title"), ((F.col("segment_end_s") - F.col("segment_start_s")) * 1000 + 499).alias("duration"), (F.col("id") % 3 != 0).alias("streamable"), F.concat(F.lit("https://"), "track_id").alias("stream_url"))
    bodies = _clips(spark, sf_dir).select("model", F.to_json(F.struct(F.array(track).alias("collection"))).alias("body"))
    return dumps.streamable_tracks(bodies, "body", ["model"]).drop("track_index")


def payload_entries(spark, sf_dir: str) -> DataFrame:
    """Clips as lists of entries whose length is twice their end, and those read from them that are of two to eight minutes."""
    entry = F.struct(F.col("id").cast("string").alias("id"), F.col("track_id").alias("title"), (F.col("segment_end_s") * 2.0).alias("duration"))
    bodies = _clips(spark, sf_dir).select("model", F.to_json(F.struct(F.array(entry).alias("entries"))).alias("body"))
    return dumps.entries_of_length(bodies, "body", ["model"]).drop("place")


def escaped(text: Column) -> Column:
    """A text as it stands in an attribute or between tags of markup."""
    for sign, entity in (("&", "&amp;"), ('"', "&#34;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def _tagged(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "bc_candidate").where("id is not null")
    return rows.groupBy("id").agg(F.max("band_name").alias("band_name"), F.max("location").alias("location"), F.max("tags").alias("tags"))


def payload_albums(spark, sf_dir: str) -> DataFrame:
    """Candidates' tags as the tracks of release pages, and the tracks read from the pages."""
    track = lambda t, i: F.struct((F.col("id") * 100 + i).alias("track_id"), t.alias("title"), (F.lit(59.5) + i).alias("duration"), F.when(i % 2 == 0, F.col("band_name")).otherwise("guest").alias("artist"), F.create_map(F.lit("mp3-128"), F.concat(F.lit("s"), i.cast("string"))).alias("file"))
    body = F.to_json(F.struct(F.col("band_name").alias("artist"), F.transform("tags", track).alias("trackinfo")))
    html = F.concat(F.lit('<div data-tralbum="'), escaped(body), F.lit('">'))
    read = dumps.album_tracks(_tagged(spark, sf_dir).select(F.col("id").alias("release"), html.alias("html")), "html", ["release"])
    return read.select("release", "id", "title", "seconds", "stream", "track_artist", "track_index")


def payload_tags(spark, sf_dir: str) -> DataFrame:
    """Candidates' tags and places as pages, and the tags read from these in their order."""
    links = F.array_join(F.transform(F.filter("tags", lambda t: t.isNotNull()), lambda t: F.concat(F.lit('<a class="tag" href="#">'), escaped(t), F.lit("</a>"))), "\n")
    html = F.concat(F.lit('<span class="location secondary">'), F.coalesce(escaped(F.col("location")), F.lit("")), F.lit("</span>"), F.coalesce(links, F.lit("")))
    return _tagged(spark, sf_dir).select("id", F.posexplode(dumps.page_tags(html)).alias("place", "tag"))


def cache_keys(spark, sf_dir: str) -> DataFrame:
    """Keys of the documents' addresses as cached replies: the text is what was posted, the day of fetching the bucket."""
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").select("doc_id", "url", "text", "fetched_at").dropDuplicates(["doc_id"])
    return docs.select("doc_id", dumps.cache_key(F.col("url"), F.col("text"), F.date_format("fetched_at", "yyyy-MM-dd")).alias("key"))


def derive_identities(claims: DataFrame, filed: DataFrame) -> DataFrame:
    """(kind, artist_id, platform, platform_id) of claims (artist_id, platform, platform_id, at): an ``identity`` for each page,
    of its earliest claim, of equals the least artist; a ``review`` for each artist and platform with a losing claim, of
    its least page, unless ``filed``, (artist_id, platform), has it. Claims without an artist or a page are left out."""
    sound = claims.where("artist_id is not null and platform is not null and platform_id <> ''")
    first = sound.groupBy("platform", "platform_id").agg(F.min(F.struct(F.col("at").isNull().alias("late"), "at", "artist_id"))["artist_id"].alias("winner"))
    won = first.select(F.lit("identity").alias("kind"), F.col("winner").alias("artist_id"), "platform", "platform_id")
    lost = sound.join(first, ["platform", "platform_id"]).where("artist_id <> winner").groupBy("artist_id", "platform").agg(F.min("platform_id").alias("platform_id"))
    open_ = lost.join(filed.select("artist_id", "platform").distinct(), ["artist_id", "platform"], "left_anti")
    return won.unionByName(open_.select(F.lit("review").alias("kind"), "artist_id", "platform", "platform_id"))


def derived_identities(spark, sf_dir: str) -> DataFrame:
    """Identities and reviews from the owners' names in page addresses; artists with a page of tier C have had theirs."""
    p = pages(spark, sf_dir).where("artist_id is not null")
    owners = vanity_extract(spark, sf_dir).select("id", F.regexp_replace("owner", "[^a-z0-9]", "").alias("page"))
    claims = p.select("id", "artist_id", "platform", F.col("first_seen_at").alias("at")).join(owners, "id").select("artist_id", "platform", F.col("page").alias("platform_id"), "at")
    return derive_identities(claims, p.where("binding_tier = 'C'").select("artist_id", "platform"))


_P = "p as (select distinct on (id) * from platform_identity where id is not null)"
_T = "t as (select id, max(band_name) as band_name, max(location) as location, max(tags) as tags from bc_candidate where id is not null group by 1), e as (select id, band_name, lower(trim(split_part(location, ',', 1), ' ')) as city, unnest(tags) as tag, unnest(range(0, len(tags))) as i from t)"
_CL = "c as (select distinct on (id) * from clip_embedding where id is not null)"
QUERIES = {f.__name__: f for f in (dump_read, payload_hits, payload_streams, payload_entries, payload_albums, payload_tags, cache_keys, derived_identities)}
SQL = {
    "dump_read": "select distinct on (id) id, display_name, mbid, status = 'active' as live, epoch_us(updated_at) as micros from artist where id is not null",
    "payload_hits": f"""with {_P}, h as (select id, platform, platform_id, json_extract_string(binding_evidence, '$.candidate_name') as nm, try_cast(json_extract_string(binding_evidence, '$.popularity') as bigint) as pop from p)
      select id, platform, case when platform = 'deezer' then nm else coalesce(nm, '') end as name, platform_id, case when platform = 'bandcamp' then 0 else coalesce(pop, 0) end as popularity from h where platform in ('deezer', 'bandcamp', 'soundcloud') and platform_id <> ''""",
    "payload_streams": f"with {_CL} select model, id::varchar as id, track_id as title, segment_end_s - segment_start_s as seconds, 'https://' || track_id as stream from c where id % 3 <> 0 and track_id is not null",
    "payload_entries": f"with {_CL} select model, id::varchar as id, track_id as title, segment_end_s * 2 as seconds from c where segment_end_s * 2 between 120 and 480",
    "payload_albums": f"""with {_T} select id as release, (id * 100 + i)::varchar as id, coalesce(tag, '') as title, (59 + i)::int as seconds, 's' || i as stream,
      case when i % 2 = 1 and band_name <> 'guest' then 'guest' end as track_artist, i::int as track_index from e""",
    "payload_tags": f"""with {_T}, l as (select id, lower(trim(tag, ' ')) as tag, min(i) as i from e where tag is not null and trim(tag, ' ') <> '' and lower(trim(tag, ' ')) <> coalesce(city, '') group by all)
      select id, (row_number() over (partition by id order by i) - 1)::int as place, tag from l""",
    "cache_keys": "select distinct on (doc_id) doc_id, url || coalesce('#post:' || substr(sha256(text), 1, 24), '') || coalesce(':' || strftime(fetched_at, '%Y-%m-%d'), '') as key from documents where doc_id is not null",
    "derived_identities": rf"""with {_P}, o as (select id, artist_id, platform, first_seen_at as seen, regexp_extract(lower(vanity_url), '^https?://([^/]+)/', 1) as host, regexp_extract(lower(vanity_url), '^https?://[^/]+/@?([^/?#]+)', 1) as owner from p where artist_id is not null),
      c as (select *, regexp_replace(owner, '[^a-z0-9]', '', 'g') as page from o where host <> '' and owner <> '' and platform is not null and regexp_replace(owner, '[^a-z0-9]', '', 'g') <> ''),
      w as (select *, first_value(artist_id) over (partition by platform, page order by seen nulls last, artist_id) as winner from c), f as (select artist_id, platform from p where binding_tier = 'C')
      select distinct 'identity' as kind, winner as artist_id, platform, page as platform_id from w union all
      select 'review', artist_id, platform, min(page) from w where artist_id <> winner and (artist_id, platform) not in (select (artist_id, platform) from f where artist_id is not null and platform is not null) group by artist_id, platform""",
}
