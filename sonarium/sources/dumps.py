"""Bulk dumps as tab-separated text, and payloads of JSON and HTML, as typed frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LayoutError(ValueError):
    """A file whose lines don't have the number of fields expected."""


def check_layout(spark: SparkSession, path: str, fields: int) -> None:
    """Compare the first line's number of fields; an empty file is in order."""
    first = spark.read.text(path).limit(1).select(F.size(F.split("value", "\t")).alias("n")).first()
    if first is not None and first["n"] != fields:
        raise LayoutError(f"{path}: {first['n']} fields, {fields} expected")


def _unescaped(c: Column) -> Column:
    """Backslash escapes of the dump format; a doubled backslash is one."""
    mark = "\u0001"
    c = F.replace(c, F.lit("\\\\"), F.lit(mark))
    for code, sign in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r")):
        c = F.replace(c, F.lit(code), F.lit(sign))
    return F.replace(c, F.lit(mark), F.lit("\\"))


def read_dump(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    r"""A tab-separated dump with ``\N`` for null, t and f for booleans and backslash escapes."""
    check_layout(spark, path, len(schema))
    cells = F.split("value", "\t", -1)
    out = []
    for i, field in enumerate(schema):
        raw = cells[i]
        text = F.when(raw != "\\N", _unescaped(raw))
        out.append((F.when(text == "t", True).when(text == "f", False) if field.dataType == T.BooleanType() else text.try_cast(field.dataType)).alias(field.name))
    return spark.read.text(path).select(*out)


def write_dump(rows: DataFrame, path: str) -> None:
    r"""Write a frame of plain columns as ``read_dump`` reads it: ``\N`` for null, t and f for booleans, backslash escapes."""
    out = []
    for field in rows.schema:
        cell = F.col(field.name)
        text = F.when(cell, "t").otherwise("f") if field.dataType == T.BooleanType() else cell.cast("string")
        for sign, code in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(sign), F.lit(code))
        out.append(F.when(cell.isNull(), "\\N").otherwise(text))
    rows.select(F.concat_ws("\t", *out).alias("value")).write.text(path)


def html_links(html: Column) -> Column:
    """The addresses of a page's links in order, each once, without fragment and query."""
    return F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(r'href="([^"]+)"'), F.lit(1)), lambda u: F.regexp_replace(u, r"[#?].*$", "")))


def unescape_html(text: Column) -> Column:
    """The entities of markup, numeric and the common named ones, the ampersand last."""
    parts = F.split(text, "&#", -1)
    digits = lambda p: F.regexp_extract(p, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
    hexed = lambda d: F.when(F.lower(d).startswith("x"), F.substr(d, F.lit(2))).otherwise(F.hex(d.try_cast("long")))
    point = lambda p: F.conv(hexed(digits(p)), 16, 10).try_cast("long")
    sound = lambda p: (point(p) > 0) & (point(p) < 0x110000) & ~point(p).between(0xD800, 0xDFFF)
    sign = lambda p: F.concat(F.decode(F.unhex(F.lpad(F.hex(point(p)), 8, "0")), "UTF-32"), F.substr(p, F.length(digits(p)) + 2))
    rest = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.when((digits(p) != "") & sound(p), sign(p)).otherwise(F.concat(F.lit("&#"), p)))
    text = F.when(F.contains(text, F.lit("&#")), F.concat(parts[0], F.array_join(rest, ""))).otherwise(text)
    for entity, sign_ in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign_))
    return text


def platform_tracks(bodies: DataFrame, body: str, owner: str) -> DataFrame:
    """(owner, id, title, preview, duration) from a JSON list of tracks: those of the owner that have a preview."""
    schema = "data array<struct<id:bigint,title:string,preview:string,duration:int,artist:struct<id:bigint>>>"
    rows = bodies.select(owner, F.explode(F.from_json(body, schema)["data"]).alias("t"))
    kept = rows.where((F.col("t.artist.id").cast("string") == F.col(owner)) & (F.coalesce("t.preview", F.lit("")) != ""))
    return kept.select(owner, F.col("t.id").alias("id"), "t.title", "t.preview", "t.duration")


def page_json(html: Column, attribute: str, schema: str) -> Column:
    """The JSON that an attribute of a page holds, as a struct of ``schema``; null where there is none."""
    raw = F.nullif(F.regexp_extract(html, f'{attribute}="([^"]*)"', 1), F.lit(""))
    return F.from_json(unescape_html(raw), schema)


def album_tracks(releases: DataFrame, html: str, keys: list[str]) -> DataFrame:
    """(keys, id, title, seconds, stream, track_artist, track_index) of the tracks of release pages that can be
    played: those with a stream, a length and an id. ``track_artist`` is null where it is the page's own."""
    schema = "artist string, trackinfo array<struct<track_id:bigint,id:bigint,title:string,duration:double,artist:string,file:map<string,string>>>"
    rows = releases.select(*keys, page_json(F.col(html), "data-tralbum", schema).alias("page")).select(*keys, "page.artist", F.posexplode("page.trackinfo").alias("track_index", "t"))
    stream = F.col("t.file")["mp3-128"]
    kept = rows.select(
        *keys, F.coalesce("t.track_id", "t.id").cast("string").alias("id"), F.coalesce("t.title", F.lit("")).alias("title"), F.col("t.duration").cast("int").alias("seconds"), stream.alias("stream"),
        F.when(F.col("t.artist") != F.col("artist"), F.col("t.artist")).alias("track_artist"), "track_index",
    )
    return kept.where("stream <> '' and seconds > 0 and id is not null")


def page_tags(html: Column) -> Column:
    """The tags people gave on a page, in order, in lower case and each once, without the name of its city."""
    city = F.lower(F.trim(F.split(unescape_html(F.regexp_extract(html, r'class="location[^"]*"[^>]*>([^<]*)<', 1)), ",")[0]))
    raw = F.regexp_extract_all(html, F.lit(r'<a[^>]*class="tag"[^>]*>([^<]*)<'), F.lit(1))
    return F.array_distinct(F.filter(F.transform(raw, lambda t: F.lower(F.trim(unescape_html(t)))), lambda t: (t != "") & (t != city)))


def streamable_tracks(bodies: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """(keys, id, title, seconds, stream) of a JSON list of tracks: those with leave and an address to be streamed; lengths there are in milliseconds."""
    schema = "collection array<struct<id:bigint,title:string,duration:bigint,streamable:boolean,stream_url:string>>"
    rows = bodies.select(*keys, F.posexplode(F.from_json(body, schema)["collection"]).alias("track_index", "t"))
    kept = rows.where("t.streamable and t.stream_url <> ''")
    return kept.select(*keys, F.col("t.id").cast("string").alias("id"), "t.title", F.floor(F.col("t.duration") / 1000).cast("int").alias("seconds"), F.col("t.stream_url").alias("stream"), "track_index")


def entries_of_length(bodies: DataFrame, body: str, keys: list[str], least: int = 120, most: int = 480, newest: int = 15) -> DataFrame:
    """(keys, id, title, seconds) of the entries of a JSON list, newest first, whose length lies between the bounds."""
    schema = "entries array<struct<id:string,title:string,duration:double>>"
    rows = bodies.select(*keys, F.posexplode(F.slice(F.from_json(body, schema)["entries"], 1, newest)).alias("place", "e"))
    return rows.where(F.col("e.duration").between(least, most)).select(*keys, "e.id", "e.title", F.col("e.duration").cast("int").alias("seconds"), "place")


def cache_key(url: Column, body: Column, bucket: Column) -> Column:
    """The key of a cached reply: the address, with a digest of what was posted and a bucket of time where there are such."""
    posted = F.when(body.isNotNull(), F.concat(F.lit("#post:"), F.substring(F.sha2(body, 256), 1, 24)))
    return F.concat(url, F.coalesce(posted, F.lit("")), F.coalesce(F.concat(F.lit(":"), bucket), F.lit("")))


def sound_kind(head: Column) -> Column:
    """The format of a sound file by its first bytes: mp3, wav, ogg or flac; null for anything else."""
    start = F.hex(F.substring(head, 1, 4))
    mp3 = start.startswith("494433") | start.rlike("^FF[EF]")
    return F.when(mp3, "mp3").when(start == "52494646", "wav").when(start == "4F676753", "ogg").when(start == "664C6143", "flac")
