"""What platforms and cached pages hold, as frames: hits of searches, walks through releases, tags, labelled files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import ascii_fold
from .dumps import album_tracks, page_json, page_tags

# The parts of each platform's answer to a search, and how paths of releases and hosts of pages look.
HITS = {
    "deezer": "data array<struct<name:string,id:string,nb_fan:bigint>>",
    "bandcamp": "auto struct<results:array<struct<type:string,name:string,item_url_root:string>>>",
    "soundcloud": "collection array<struct<username:string,permalink:string,track_count:bigint>>",
}
RELEASE = r'href="(/(?:album|track)/[^"#?]+)"'
PAGE_HOST = r"(?i)^https?://([^./]+)\.bandcamp\.com"
TREE = "appData struct<initialState:struct<genres:array<struct<slug:string>>,subgenres:array<struct<slug:string>>>>"


def search_hits(bodies: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, platform, place, name, platform_id, popularity) from answers to searches, (keys, platform, body).

    Each platform has a shape of its own. Hits without an id, of bands' searches those that aren't bands, and bodies
    that are null or no JSON give no rows; a missing popularity is 0.
    """
    none = F.lit("")
    root = F.col("h.item_url_root")
    host = F.substring_index(F.regexp_replace(root, "^https://", ""), ".bandcamp.com", 1)
    parts = {
        "deezer": (lambda j: j["data"], F.col("h.name"), F.col("h.id"), F.col("h.nb_fan")),
        "bandcamp": (lambda j: j["auto"]["results"], F.coalesce("h.name", none), F.when((F.col("h.type") == "b") & F.contains(root, F.lit(".bandcamp.com")), host), F.lit(0)),
        "soundcloud": (lambda j: j["collection"], F.coalesce("h.username", none), F.col("h.permalink"), F.col("h.track_count")),
    }
    def of(platform: str) -> DataFrame:
        hits, name, page, popularity = parts[platform]
        rows = bodies.where(F.col("platform") == platform).select(*keys, "platform", F.posexplode(hits(F.from_json("body", HITS[platform]))).alias("place", "h"))
        return rows.select(*keys, "platform", "place", name.alias("name"), page.alias("platform_id"), F.coalesce(popularity.cast("bigint"), F.lit(0)).alias("popularity"))

    return reduce(DataFrame.unionByName, map(of, HITS)).where("platform_id <> ''")


def name_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(ascii_fold(name)), "[^a-z0-9]+", "")


def resolve_names(wanted: DataFrame, hits: DataFrame) -> DataFrame:
    """(name, platform_id): for each wanted name the page of the same normal name with the greatest popularity, of equals
    the least id. Names without such a page aren't guessed but left out, as are those with nothing left of them."""
    keyed = hits.select(name_key(F.col("name")).alias("key"), F.struct((-F.coalesce("popularity", F.lit(0))).alias("m"), "platform_id").alias("hit")).where("key <> '' and hit.platform_id is not null")
    best = keyed.groupBy("key").agg(F.min("hit")["platform_id"].alias("platform_id"))
    return wanted.select("name").distinct().withColumn("key", name_key(F.col("name"))).join(best, "key").select("name", "platform_id")


def first_filled(first: DataFrame, second: DataFrame, owner: str, order: list, most: int) -> DataFrame:
    """``first``'s rows of each owner that has any there, else ``second``'s; at most ``most`` in order. Both have the same columns."""
    rest = second.join(first.select(owner).distinct(), owner, "left_anti")
    both = first.unionByName(rest)
    return both.withColumn("place", F.row_number().over(Window.partitionBy(owner).orderBy(*order))).where(F.col("place") <= most)


def release_paths(html: Column) -> Column:
    """The paths of the releases that a page links to, in its order, each once."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(RELEASE), F.lit(1)))


def walked_releases(lists: DataFrame, owner: str, html: str, most: int = 5) -> DataFrame:
    """(owner, release_index, path): the first releases that an owner's list links to, or its root, '', if it links to none."""
    paths = F.slice(F.coalesce(release_paths(F.col(html)), F.array().cast("array<string>")), 1, most)
    return lists.select(owner, F.posexplode(F.when(F.size(paths) > 0, paths).otherwise(F.array(F.lit("")))).alias("release_index", "path"))


def release_walk(lists: DataFrame, cached: DataFrame, owner: str, most: int = 5) -> DataFrame:
    """Tracks of the releases walked, in the order of walk: ``lists`` is (owner, html), ``cached`` (owner, path, html).
    A release whose page isn't there or holds no tracks is passed over."""
    pages = walked_releases(lists, owner, "html", most).join(cached, [owner, "path"])
    return album_tracks(pages, "html", [owner, "release_index", "path"])


def ordered_tags(rows: DataFrame, owner: str, order: list[str], tags: str) -> DataFrame:
    """(owner, tags): an owner's tags in the order they are first met, each once. Owners without any are left out.

    Positions are cut down to the first of each tag before anything is gathered, so a list is no longer than the
    owner's distinct tags.
    """
    met = rows.select(owner, *order, F.posexplode(tags).alias("_at", "tag")).groupBy(owner, "tag").agg(F.min(F.struct(*order, "_at")).alias("at"))
    return met.groupBy(owner).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "tag"))), lambda x: x["tag"]).alias("tags"))


def harvest_tags(cached: DataFrame, owners: DataFrame) -> DataFrame:
    """(artist_id, tags) from cached pages (url, status, content_type, body), offline: pages of status 200 that are HTML and
    on the host of one of ``owners`` (platform_id, artist_id). Null bodies, as of evicted pages, give nothing."""
    kept = cached.where("status = 200 and content_type like 'text/html%' and body is not null")
    hosted = kept.select(F.lower(F.regexp_extract("url", PAGE_HOST, 1)).alias("host"), "url", page_tags(F.col("body")).alias("found"))
    bound = owners.where("artist_id is not null").groupBy(F.lower("platform_id").alias("host")).agg(F.min("artist_id").alias("artist_id"))
    return ordered_tags(hosted.join(bound, "host"), "artist_id", ["url"], "found")


def tag_tree(html: Column) -> Column:
    """The slugs of a page's tree of tags: genres, then those under them, each once; an empty list where there is no tree."""
    state = page_json(html, "data-blob", TREE)["appData"]["initialState"]
    slugs = lambda part: F.transform(F.coalesce(state[part], F.array().cast("array<struct<slug:string>>")), lambda g: g["slug"])
    return F.array_distinct(F.filter(F.concat(slugs("genres"), slugs("subgenres")), lambda s: s != ""))


def labelled_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(label, file, path, content) of the files in the folders of a folder: the folder's name is the label. Files that
    lie beside the folders, and names that ``pattern`` doesn't fit, aren't read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(f"{root}/*/*")
    parts = F.split("path", "/")
    return rows.select(F.element_at(parts, -2).alias("label"), F.element_at(parts, -1).alias("file"), "path", "content")


def required(rows: DataFrame, known: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``rows`` with the ``value`` that ``known`` has for their keys; a row without one is an error when it is reached."""
    found = known.groupBy(*keys).agg(F.min(value).alias(value))
    told = F.concat_ws(" ", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
    return rows.join(found, keys, "left").withColumn(value, F.when(F.col(value).isNull(), F.raise_error(F.concat(F.lit(f"no {value} for "), told))).otherwise(F.col(value)))


def to_fetch(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """The keys of ``wanted`` for which the latest reply in ``cached``, (key, status, body, fetched_at), is missing, has lost
    its body or has a status other than 404 and those from 200 to 299."""
    last = cached.groupBy("key").agg(F.max(F.struct("fetched_at", "status", F.col("body").isNotNull().alias("there"))).alias("r"))
    good = last.where("r.there and (r.status between 200 and 299 or r.status = 404)")
    return wanted.select("key").where("key is not null").distinct().join(good, "key", "left_anti")
