"""Entities and their names: slugs, keys, joins on either of two keys, duplicates and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ascii_fold
from ..functions.titles import is_numbered, plain_title
from ..session import settle, table
from .ranks import placed


#: A sign that isn't white space of any kind.
NOT_BLANK = r"[^\s\x0B\p{Z}]"
#: Texts from which on an artist's texts are compared.
LEAST_TEXTS = 3


def slug_base(name: Column) -> Column:
    """A name as a slug: ASCII letters and digits, runs of others as one hyphen; "artist" if nothing is left."""
    flat = F.trim(F.regexp_replace(F.lower(ascii_fold(name)), r"[^a-z0-9]+", "-"), F.lit("-"))
    return F.coalesce(F.nullif(flat, F.lit("")), F.lit("artist"))


def sql_key(name: Column) -> Column:
    """Lower case, everything but a-z and 0-9 deleted, accents not folded."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def normal_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(ascii_fold(name)), "[^a-z0-9]+", "")


def artists(spark, sf_dir: str) -> DataFrame:
    """The artists, each once; a query's other columns aren't read."""
    return table(spark, sf_dir, "artist").where("id is not null").dropDuplicates(["id"])


def candidates(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "bc_candidate").where("id is not null")
    return rows.groupBy("id").agg(*(F.max(c).alias(c) for c in ("platform_id", "band_name", "location", "links", "artist_id", "first_seen_at", "release_seen_at")))


def pages(spark, sf_dir: str) -> DataFrame:
    """The pages, each once; a query's other columns aren't read."""
    return table(spark, sf_dir, "platform_identity").where("id is not null").dropDuplicates(["id"])


#: A slug's family and its number there.
NUMBERED_SLUG = r"^(.*)-([1-9][0-9]{0,8})$"


def assign_slugs(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """(id, slug) of rows (id, base, created_at), all different and other than the stored ones.

    ``stored``, (id, slug), stays as it is. Of the rest, the first of a base by creation
    has the base itself, unless that is stored; the others in turn have the least numbers
    from 2 on with which no stored slug and no other base is formed. Bases and ids are
    not null. Families may be of any size.
    """
    spark = rows.sparkSession
    held = stored.select("id", "slug") if stored is not None else spark.createDataFrame([], "id string, slug string")
    new = rows.select("id", "base", "created_at").join(held.select("id"), "id", "left_anti")
    spoken = held.select("slug").unionByName(new.select(F.col("base").alias("slug"))).distinct()
    kept = held.select(F.col("slug").alias("base"), F.lit(1).alias("stored")).distinct()
    place = placed(new, ["base"], ["created_at", "id"], "n").join(kept, "base", "left").withColumn("m", F.col("n") - 1 + F.coalesce("stored", F.lit(0)))
    bare = place.where("m = 0").select("id", F.col("base").alias("slug"))
    rest = settle(place.where("m > 0").select("id", "base", "m"))
    # numbers that are taken in the families that need any, and how many free ones lie below each
    family, number = F.regexp_extract("slug", NUMBERED_SLUG, 1), F.regexp_extract("slug", NUMBERED_SLUG, 2).try_cast("long")
    taken = spoken.select(family.alias("base"), number.alias("k")).where("k >= 2").join(rest.select("base").distinct(), "base", "left_semi")
    below = placed(taken, ["base"], ["k"], "j").select("base", (F.col("k") - 1 - F.col("j")).alias("m"), F.lit(None).cast(rest.schema["id"].dataType).alias("id"), F.lit(0).alias("turn"), "k")
    both = below.unionByName(rest.select("base", "m", "id", F.lit(1).alias("turn"), F.lit(0).cast("long").alias("k")))
    both = both.withColumn("m", F.when(F.col("turn") == 0, F.col("m") + 1).otherwise(F.col("m")))
    numbered = placed(both, ["base"], ["m", "turn", "k"], "place").where("turn = 1")  # its own turn and the taken numbers before
    return held.unionByName(bare).unionByName(numbered.select("id", F.concat("base", F.lit("-"), (F.col("place") + 1).cast("string")).alias("slug")))


def slug_assign(spark, sf_dir: str) -> DataFrame:
    """A slug for each artist: the first of a name by creation has the bare one, the others the first free numbers."""
    return assign_slugs(artists(spark, sf_dir).select("id", "created_at", slug_base(F.coalesce("display_name", F.lit(""))).alias("base")))


def unique_name_match(spark, sf_dir: str) -> DataFrame:
    """Candidates whose name key belongs to exactly one artist."""
    keyed = artists(spark, sf_dir).withColumn("key", sql_key(F.col("display_name"))).where("key <> ''")
    single = keyed.groupBy("key").agg(F.min("id").alias("artist_id"), F.count("*").alias("n")).where("n = 1").select("key", "artist_id")
    return candidates(spark, sf_dir).select("id", sql_key(F.col("band_name")).alias("key")).join(single, "key").select("id", "key", "artist_id")


def name_keys_dedup(spark, sf_dir: str) -> DataFrame:
    """Name keys of more than one record, over artists and candidates."""
    names = artists(spark, sf_dir).select(normal_name(F.col("display_name")).alias("key"), F.lit("artist").alias("kind")).unionByName(
        candidates(spark, sf_dir).select(normal_name(F.col("band_name")).alias("key"), F.lit("candidate").alias("kind"))
    )
    counts = names.where("key <> ''").groupBy("key").agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "artist").alias("artists"))
    return counts.where("n > 1")


def typo1_pairs(spark, sf_dir: str) -> DataFrame:
    """Tags one edit apart. Both lead to a common key: the tag itself, or what is left of it without one character."""
    tags = table(spark, sf_dir, "artist_tag_scores").select(F.lower(F.trim("tag")).alias("tag")).where("tag <> ''").distinct()
    cut = F.transform(F.sequence(F.lit(0), F.length("tag")), lambda i: F.xxhash64(F.concat(F.substring("tag", F.lit(1), i), F.substr(F.col("tag"), i + 2))))
    keys = tags.select("tag", F.explode(F.array_distinct(cut)).alias("key"))
    a, b = keys.select(F.col("tag").alias("tag_a"), "key"), keys.select(F.col("tag").alias("tag_b"), "key")
    near = a.join(b, "key").where("tag_a < tag_b and abs(length(tag_a) - length(tag_b)) <= 1").select("tag_a", "tag_b").distinct()
    return near.where("levenshtein(tag_a, tag_b, 1) = 1")


def vanity_extract(spark, sf_dir: str) -> DataFrame:
    """Host and owner's name of each page address that has both."""
    url = F.lower("vanity_url")
    return (
        pages(spark, sf_dir).where("vanity_url is not null")
        .select("id", F.nullif(F.regexp_extract(url, r"^https?://([^/]+)/", 1), F.lit("")).alias("host"), F.nullif(F.regexp_extract(url, r"^https?://[^/]+/@?([^/?#]+)", 1), F.lit("")).alias("owner"))
        .where("host is not null and owner is not null")
    )


def shared_url_losers(spark, sf_dir: str) -> DataFrame:
    """Pages that claim an owner's name on a platform that an earlier page has."""
    claimed = vanity_extract(spark, sf_dir).join(pages(spark, sf_dir).select("id", "platform", "first_seen_at"), "id").withColumn("owner", F.regexp_replace("owner", "[^a-z0-9]", ""))
    first = claimed.groupBy("platform", "owner").agg(F.min(F.struct("first_seen_at", "id"))["id"].alias("winner"))
    return claimed.join(first, ["platform", "owner"]).where("id <> winner").select("platform", "owner", F.col("id").alias("loser"), "winner")


def evidence_methods(spark, sf_dir: str) -> DataFrame:
    """Pages per platform and method of binding, with the mean popularity told."""
    e = F.from_json("binding_evidence", "method string, popularity bigint, candidates_total int")
    rows = pages(spark, sf_dir).withColumn("e", e)
    return rows.groupBy("platform", F.coalesce("e.method", F.lit("none")).alias("method")).agg(
        F.count("*").alias("pages"), F.round(F.avg("e.popularity"), 4).alias("popularity"), F.coalesce(F.sum("e.candidates_total"), F.lit(0)).alias("candidates")
    )


def evidence_patch(spark, sf_dir: str) -> DataFrame:
    """JSON objects patched: one key set, two removed; keys and values of each object as rows."""
    as_map = F.from_json("binding_evidence", "map<string,string>")
    patched = F.map_filter(as_map, lambda k, v: ~k.isin("query", "checked"))
    whole = F.map_concat(F.coalesce(patched, F.create_map().cast("map<string,string>")), F.create_map(F.lit("checked"), F.lit("yes")))
    return pages(spark, sf_dir).select("id", F.explode(whole))


def lost_pages(spark, sf_dir: str) -> DataFrame:
    """Pages whose artist is gone or lost its vectors: a test on either key, as two anti-joins united."""
    bound = pages(spark, sf_dir).where("artist_id is not null").select("id", "artist_id")
    known = artists(spark, sf_dir).select(F.col("id").alias("artist_id"))
    embedded = table(spark, sf_dir, "artist_embedding").select("artist_id").distinct()
    return bound.join(known, "artist_id", "left_anti").unionByName(bound.join(embedded, "artist_id", "left_anti")).select("id", "artist_id").distinct()


def either_key_links(spark, sf_dir: str) -> DataFrame:
    """Candidates and artists linked by the artist's page id or, where none has it, by equal name keys."""
    c = candidates(spark, sf_dir).select("id", "platform_id", sql_key(F.col("band_name")).alias("key"))
    p = pages(spark, sf_dir).where("platform = 'bandcamp' and artist_id is not null").select("platform_id", "artist_id")
    by_page = c.join(p, "platform_id").select("id", "artist_id", F.lit("page").alias("via"))
    rest = c.join(by_page.select("id").distinct(), "id", "left_anti")
    a = artists(spark, sf_dir).select(F.col("id").alias("artist_id"), sql_key(F.col("display_name")).alias("key")).where("key <> ''")
    return by_page.unionByName(rest.join(a, "key").select("id", "artist_id", F.lit("name").alias("via"))).distinct()


def source_yield_choice(spark, sf_dir: str) -> DataFrame:
    """For each artist the first platform in order that reaches its floor of pages, else the one nearest to it."""
    floors = spark.createDataFrame([("deezer", 1, 2), ("bandcamp", 2, 1), ("soundcloud", 3, 2), ("youtube", 4, 1)], "platform string, prio int, floor int")
    counts = pages(spark, sf_dir).where("artist_id is not null").groupBy("artist_id", "platform").agg(F.count("*").alias("n"))
    rated = counts.join(F.broadcast(floors), "platform").withColumn("ratio", F.col("n") / F.col("floor"))
    order = Window.partitionBy("artist_id").orderBy(F.when(F.col("ratio") >= 1, 0).otherwise(1), F.when(F.col("ratio") >= 1, F.col("prio")).otherwise(0), F.desc("ratio"), "prio")
    return rated.withColumn("rn", F.row_number().over(order)).where("rn = 1").select("artist_id", "platform", F.round("ratio", 4).alias("ratio"))


def diversity_selection(spark, sf_dir: str) -> DataFrame:
    """Three pages of an artist, one of each platform first, then the rest, oldest first."""
    rows = pages(spark, sf_dir).where("artist_id is not null")
    first = F.row_number().over(Window.partitionBy("artist_id", "platform").orderBy("first_seen_at", "id"))
    rows = rows.withColumn("again", (first > 1).cast("int"))
    place = F.row_number().over(Window.partitionBy("artist_id").orderBy("again", "first_seen_at", "id"))
    return rows.withColumn("place", place).where("place <= 3").select("artist_id", "id", "platform", "place")


def majority_language(spark, sf_dir: str) -> DataFrame:
    """The language of an artist's texts, from at least two of them and 60 of 100."""
    docs = table(spark, sf_dir, "documents").where("artist_id is not null and lang is not null").select("doc_id", "artist_id", F.lower("lang").alias("lang")).distinct()
    counts = docs.groupBy("artist_id", "lang").agg(F.count("*").alias("n"))
    of = Window.partitionBy("artist_id")
    ranked = counts.withColumn("total", F.sum("n").over(of)).withColumn("rn", F.row_number().over(of.orderBy(F.desc("n"), "lang")))
    return ranked.where("rn = 1 and total >= 2 and n >= 0.6 * total").select("artist_id", "lang", "n", F.round(F.col("n") / F.col("total"), 4).alias("share"))


def exact_duplicate_texts(spark, sf_dir: str) -> DataFrame:
    """Texts that occur in several documents: class, members and sources."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike(NOT_BLANK)).select("doc_id", "source", F.sha2("text", 256).alias("digest")).distinct()
    return docs.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"), F.count_distinct("source").alias("sources")).where("n > 1")


def catalogue_audit(spark, sf_dir: str) -> DataFrame:
    """Named counts: what isn't as it should be."""
    a, p, e = artists(spark, sf_dir), pages(spark, sf_dir), table(spark, sf_dir, "artist_embedding")
    count = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    slugs = a.groupBy(sql_key(F.coalesce("display_name", F.lit(""))).alias("k")).count().where("count > 1")
    out = count("blank_names", a.where("trim(coalesce(display_name, '')) = ''"))
    for name, df in (
        ("shared_keys", slugs), ("orphan_pages", p.where("artist_id is not null").join(a.select(F.col("id").alias("artist_id")), "artist_id", "left_anti")),
        ("owned_unknown", p.where("(page_type in ('artist', 'topic')) <> (artist_id is not null)")), ("null_vectors", e.where("embedding is null")), ("wrong_length", e.where("size(embedding) <> dim")),
    ):
        out = out.unionByName(count(name, df))
    return out


def seeded_sample(spark, sf_dir: str) -> DataFrame:
    """A hundred documents by the hash of seed and id: the same ones in every run."""
    docs = table(spark, sf_dir, "documents").select("doc_id").distinct()
    return docs.withColumn("h", F.md5(F.concat(F.lit("7:"), F.col("doc_id").cast("string")))).orderBy("h", "doc_id").limit(100).select("doc_id", "h")


def text_forensics(spark, sf_dir: str) -> DataFrame:
    """Artists with three texts or more: how alike in length they are, and how many are copies or end in a number."""
    docs = table(spark, sf_dir, "documents").where("artist_id is not null and text is not null").dropDuplicates(["doc_id"])
    digest = docs.select("artist_id", F.sha2("text", 256).alias("digest"), F.length("text").alias("len"), F.when(is_numbered(F.col("text")), 1.0).otherwise(0.0).alias("numbered"))
    per = digest.groupBy("artist_id", "digest").agg(F.count("*").alias("n"), F.max("len").alias("len"), F.max("numbered").alias("numbered"))
    total = lambda c: F.sum(F.col("n") * c)
    mean = total(F.col("len")) / F.sum("n")
    sd = F.sqrt(F.greatest(F.lit(0.0), total(F.col("len") * F.col("len")) / F.sum("n") - mean * mean))
    rows = per.groupBy("artist_id").agg(
        F.sum("n").alias("texts"), F.round(sd / F.greatest(mean, F.lit(1.0)), 4).alias("cv"), F.round(total(F.col("numbered")) / F.sum("n"), 4).alias("numbered"), F.round(1 - F.count("*") / F.sum("n"), 4).alias("copies")
    )
    return rows.where(F.col("texts") >= LEAST_TEXTS)


def plain_name_series(spark, sf_dir: str) -> DataFrame:
    """Names of artists and candidates read as titles: their plain form, and whether a number ends them."""
    names = artists(spark, sf_dir).select(F.col("display_name").alias("name")).unionByName(candidates(spark, sf_dir).select(F.col("band_name").alias("name")))
    rows = names.select(plain_title(F.col("name")).alias("plain"), is_numbered(F.col("name")).alias("numbered")).where("plain <> ''")
    return rows.groupBy("plain").agg(F.count("*").alias("n"), F.bool_or("numbered").alias("numbered")).where("n > 1 or numbered")


_A = "a as (select distinct * from artist where id is not null)"
_C = "c as (select id, max(platform_id) as platform_id, max(band_name) as band_name from bc_candidate where id is not null group by 1)"
_P = "p as (select distinct * from platform_identity where id is not null)"
_KEY = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"
_OWNERS = "o as (select id, platform, first_seen_at, nullif(regexp_extract(lower(vanity_url), '^https?://([^/]+)/', 1), '') as host, nullif(regexp_extract(lower(vanity_url), '^https?://[^/]+/@?([^/?#]+)', 1), '') as owner from p where vanity_url is not null)"
QUERIES = {
    f.__name__: f
    for f in (slug_assign, unique_name_match, name_keys_dedup, typo1_pairs, vanity_extract, shared_url_losers, evidence_methods, evidence_patch, lost_pages, either_key_links, source_yield_choice, diversity_selection, majority_language, exact_duplicate_texts, catalogue_audit, seeded_sample, text_forensics, plain_name_series)
}
_ASCII = "lower(regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]', '', 'g'))"
SQL = {
    "slug_assign": f"""with {_A}, b as (select id, created_at, coalesce(nullif(trim(regexp_replace({_ASCII.format("coalesce(display_name, '')")}, '[^a-z0-9]+', '-', 'g'), '-'), ''), 'artist') as base from a),
      n as (select *, row_number() over (partition by base order by created_at nulls first, id) - 1 as m from b),
      f as (select base, k, row_number() over (partition by base order by k) as m from (select base, unnest(range(2, 2 * count(*) + 2 + (select count(*) from b x where x.base like g.base || '-%'))) as k from b g group by base having count(*) > 1)
        where base || '-' || k not in (select base from b))
      select id, case when m = 0 then base else base || '-' || k end as slug from n left join f using (base, m)""",
    "name_keys_dedup": f"""with {_A}, {_C}, k as (select regexp_replace({_ASCII.format('display_name')}, '[^a-z0-9]+', '', 'g') as key, 1 as own from a union all select regexp_replace({_ASCII.format('band_name')}, '[^a-z0-9]+', '', 'g'), 0 from c)
      select key, count(*) as n, sum(own)::bigint as artists from k where key <> '' group by 1 having count(*) > 1""",
    "unique_name_match": f"with {_A}, {_C}, k as (select {_KEY.format('display_name')} as key, min(id) as artist_id from a group by 1 having count(*) = 1) select c.id, k.key, k.artist_id from c join k on k.key = {_KEY.format('c.band_name')} where k.key <> ''",
    "typo1_pairs": "with t as (select distinct lower(trim(tag, ' ')) as tag from artist_tag_scores where trim(tag, ' ') <> '') select x.tag as tag_a, y.tag as tag_b from t x join t y on x.tag < y.tag and abs(len(x.tag) - len(y.tag)) <= 1 where levenshtein(x.tag, y.tag) = 1",
    "vanity_extract": f"with {_P}, {_OWNERS} select id, host, owner from o where host is not null and owner is not null",
    "shared_url_losers": f"""with {_P}, {_OWNERS}, k as (select id, platform, first_seen_at, {_KEY.format('owner')} as owner from o where host is not null and owner is not null),
      r as (select *, row_number() over w as rn, first(id) over w as winner from k window w as (partition by platform, owner order by first_seen_at nulls first, id)) select platform, owner, id as loser, winner from r where rn > 1""",
    "evidence_methods": f"with {_P} select platform, coalesce(json_extract_string(binding_evidence, '$.method'), 'none') as method, count(*) as pages, round(avg(json_extract(binding_evidence, '$.popularity')::bigint), 4) as popularity, coalesce(sum(json_extract(binding_evidence, '$.candidates_total')::int), 0)::bigint as candidates from p group by 1, 2",
    "evidence_patch": f"""with {_P} select id, key, json_extract_string(binding_evidence, '$."' || key || '"') as value from (select id, binding_evidence, unnest(json_keys(binding_evidence)) as key from p) where key not in ('query', 'checked') union all select id, 'checked', 'yes' from p""",
    "lost_pages": f"with {_A}, {_P} select id, artist_id from p where artist_id is not null and (artist_id not in (select id from a) or artist_id not in (select artist_id from artist_embedding where artist_id is not null))",
    "either_key_links": f"""with {_A}, {_C}, {_P}, v as (select c.id, p.artist_id, 'page' as via from c join p using (platform_id) where p.platform = 'bandcamp' and p.artist_id is not null)
      select distinct * from v union select c.id, a.id, 'name' from c join a on {_KEY.format('c.band_name')} = {_KEY.format('a.display_name')} where {_KEY.format('a.display_name')} <> '' and c.id not in (select id from v)""",
    "source_yield_choice": f"""with {_P}, f(platform, prio, floor) as (values ('deezer', 1, 2), ('bandcamp', 2, 1), ('soundcloud', 3, 2), ('youtube', 4, 1)),
      r as (select artist_id, platform, prio, count(*) / max(floor)::double as ratio from p join f using (platform) where artist_id is not null group by all),
      k as (select *, row_number() over (partition by artist_id order by (ratio < 1)::int, case when ratio >= 1 then prio else 0 end, ratio desc, prio) as rn from r) select artist_id, platform, round(ratio, 4) as ratio from k where rn = 1""",
    "diversity_selection": f"""with {_P}, r as (select *, (row_number() over (partition by artist_id, platform order by first_seen_at nulls first, id) > 1)::int as again from p where artist_id is not null),
      k as (select *, row_number() over (partition by artist_id order by again, first_seen_at nulls first, id) as place from r) select artist_id, id, platform, place::int as place from k where place <= 3""",
    "majority_language": """with d as (select distinct doc_id, artist_id, lower(lang) as lang from documents where artist_id is not null and lang is not null), c as (select artist_id, lang, count(*) as n from d group by all),
      r as (select *, sum(n) over (partition by artist_id) as total, row_number() over (partition by artist_id order by n desc, lang) as rn from c) select artist_id, lang, n, round(n / total, 4) as share from r where rn = 1 and total >= 2 and n >= 0.6 * total""",
    "exact_duplicate_texts": r"select digest, min(doc_id) as first_doc, count(*) as n, count(distinct source) as sources from (select distinct doc_id, source, sha256(text) as digest from documents where regexp_matches(text, '[^\s\x0B\p{Z}]')) group by 1 having count(*) > 1",
    "catalogue_audit": f"""with {_A}, {_P}, e as (select * from artist_embedding) select 'blank_names' as what, count(*) as n from a where trim(coalesce(display_name, ''), ' ') = ''
      union all select 'shared_keys', count(*) from (select 1 from a group by {_KEY.format("coalesce(display_name, '')")} having count(*) > 1)
      union all select 'orphan_pages', count(*) from p where artist_id is not null and artist_id not in (select id from a)
      union all select 'owned_unknown', count(*) from p where (page_type in ('artist', 'topic')) <> (artist_id is not null)
      union all select 'null_vectors', count(*) from e where embedding is null union all select 'wrong_length', count(*) from e where len(embedding) <> dim""",
    "seeded_sample": "select doc_id, md5('7:' || doc_id::varchar) as h from (select distinct doc_id from documents) order by h, doc_id limit 100",
    "text_forensics": r"""with d as (select distinct on (doc_id) artist_id, text, len(text) as n, (regexp_matches(text, '(?i)(\b(vol|volume|part|pt|episode|ep|no|#)\.?\s*\d+|\s\d{1,3})\s*$'))::int as num from documents where artist_id is not null and text is not null),
      r as (select artist_id, count(*) as texts, round(stddev_pop(n) / greatest(avg(n), 1), 4) as cv, round(avg(num), 4) as numbered, round(1 - count(distinct sha256(text)) / count(*), 4) as copies from d group by 1)
      select * from r where texts >= 3""",
    "plain_name_series": rf"""with {_A}, {_C}, n as (select display_name as name from a union all select band_name from c),
      f as (select name, strip_accents(regexp_replace(name, '[^\x00-\x7F\p{{L}}\p{{N}}\p{{M}}]', ' ', 'g')) as s from n), g as (select name, regexp_replace(regexp_replace(regexp_replace(s, '[^\x00-\x7F]', '', 'g'), '(?i)\((feat|ft|with|prod)[^)]*\)', '', 'g'), '(?i)\b(feat|ft)\.?\s.+$', '') as t from f),
      h as (select trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) as plain, regexp_matches(name, '(?i)(\b(vol|volume|part|pt|episode|ep|no|#)\.?\s*\d+|\s\d{{1,3}})\s*$') as numbered from g)
      select plain, count(*) as n, bool_or(numbered) as numbered from h where plain <> '' group by 1 having count(*) > 1 or bool_or(numbered)""",
}
