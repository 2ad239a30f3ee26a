"""Records of two sources matched without a key, by weighted soft rules.

Every pair of records with similar names, or with one site, is a variable between 0
and 1: how surely they are of the same act. Rules about names, places, tags and sites,
about exclusivity and about transitivity are hinge losses with weights; their sum is
convex and is minimised by alternating directions: each rule moves its own copies of
the variables, and the copies of a variable are averaged, both as joins and
aggregations over tables of rules and variables.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle, shuffle_width, table
from .names import BOUND, name_cost, plain_forms, similar_forms
from .spelling import distance, fold, sound

#: Weights of the rules.
W_SITE, W_PLACE, W_TAGS, W_PRIOR = 6.0, 3.0, 3.0, 1.0
W_OTHER_SITE, W_OTHER_PLACE, W_OTHER_TAGS = 3.0, 2.5, 0.75
W_ONE_PAGE, W_SAME_ACT = 1.0, 1.0
#: The step of alternating directions, and how far a copy may be from its variable, and a variable from where it was, at the end.
RHO, TOLERANCE = 2.0, 1e-3
#: Rules times variables up to which one task settles a group of rules.
GROUP_ROWS = 200_000
#: Acts up to which a site outweighs the prior; as more share it, it weighs less and less. Records of one act count as one, however many.
OWN_SITE = 20
#: Sureness from which two records count as the same act.
SURE = 0.5

_PARTS = re.compile(r"[,/()|;]+")


def place_parts(place: str | None) -> list[str]:
    """The parts of a place as typed, in plain form."""
    parts = (re.sub(r"^\s*n\b\.?\s+", "new ", re.sub(r"\bst\b\.?", "saint", fold(p))).strip(" .!") for p in _PARTS.split(place or ""))
    return [p for p in parts if p]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _place_parts(places: pd.Series) -> pd.Series:
    return places.map(place_parts)


def _same_part(a: str, b: str) -> bool:
    most = 2 if min(len(a), len(b)) >= 8 else 1 if min(len(a), len(b)) >= 5 else 0
    return a == b or distance(sound(a), sound(b), most) <= most


@F.pandas_udf(T.IntegerType())
def _same_town(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([int(any(_same_part(p, q) for p in x for q in y)) for x, y in zip(a, b)], index=a.index, dtype="int32")


def plain_tag(tag: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(F.lower(tag), r"[#\s_-]+", " ")), F.lit(""))


def plain_site(url: Column) -> Column:
    host = F.regexp_extract(F.lower(url), r"^(?:[a-z]+://)?(?:www\.)?([^/?#]+)", 1)
    return F.nullif(host, F.lit(""))


def plain_address(url: Column) -> Column:
    """The site with what follows it, which tells the acts of one host apart."""
    whole = F.regexp_extract(F.lower(url), r"^(?:[a-z]+://)?(?:www\.)?([^/?#]+[^#]*)", 1)
    return F.nullif(F.regexp_replace(whole, r"[/\s]+$", ""), F.lit(""))


def candidate_side(candidates: DataFrame) -> DataFrame:
    """(id, name, place, tags, site, address) of each candidate; re-delivered rows count once."""
    once = candidates.where("id is not null").groupBy("id").agg(*(F.max(c).alias(c) for c in ("band_name", "location", "tags", "links")))
    return once.select(
        "id", F.col("band_name").alias("name"), F.col("location").alias("place"),
        F.array_distinct(F.filter(F.transform(F.coalesce("tags", F.array().cast("array<string>")), plain_tag), lambda x: x.isNotNull() & ~x.startswith("label:"))).alias("tags"),
        plain_site(F.get_json_object("links", "$.site")).alias("site"), plain_address(F.get_json_object("links", "$.site")).alias("address"),
    )


def page_side(pages: DataFrame) -> DataFrame:
    """(id, platform, name, place, tags, site, address) of each page bound to nobody whose kind is unknown."""
    loose = pages.where("id is not null and artist_id is null and page_type = 'unknown'").dropDuplicates(["id"])
    said = F.from_json("binding_evidence", "candidate_name string, city string, site string, tags array<string>")
    # a page whose evidence has no name goes by the last part of its own address, else by its id on the platform
    address = F.regexp_replace(F.regexp_extract("vanity_url", r"/@?([^/?#]+)/?$", 1), "[-_]", " ")
    own = F.when(F.col("platform").isin("soundcloud", "bandcamp"), F.regexp_replace("platform_id", "[-_]", " "))
    return loose.withColumn("e", said).select(
        "id", "platform", F.coalesce(F.nullif(F.trim("e.candidate_name"), F.lit("")), F.nullif(address, F.lit("")), own).alias("name"),
        F.col("e.city").alias("place"),
        F.array_distinct(F.filter(F.transform(F.coalesce("e.tags", F.array().cast("array<string>")), plain_tag), lambda x: x.isNotNull())).alias("tags"),
        plain_site(F.col("e.site")).alias("site"), plain_address(F.col("e.site")).alias("address"),
    )


def countries_of(places: DataFrame) -> DataFrame:
    """(part): parts of places that stand last beside two or more first parts, and beside more of these than they have last parts behind them."""
    ends = places.select(_place_parts("place").alias("p")).where("size(p) > 1").select(F.col("p")[0].alias("first"), F.element_at("p", -1).alias("last")).where("first <> last").distinct()
    lasts = ends.groupBy(F.col("last").alias("part")).agg(F.count("*").alias("lasts"))
    firsts = ends.groupBy(F.col("first").alias("part")).agg(F.count("*").alias("firsts"))
    return lasts.join(firsts, "part", "left").where("lasts >= 2 and lasts > coalesce(firsts, 0)").select("part")


def _placed(side: DataFrame, countries: DataFrame) -> DataFrame:
    """The side with its towns: parts of its place that aren't countries."""
    parts = side.select("id", F.explode(_place_parts("place")).alias("part")).join(countries, "part", "left_anti")
    towns = parts.groupBy("id").agg(F.collect_set("part").alias("towns"))
    return side.join(towns, "id", "left").withColumn("towns", F.coalesce("towns", F.array().cast("array<string>")))


def _site_keys(side: DataFrame) -> DataFrame:
    """(id, name, site, key): the site of each record, and its whole address where that says more."""
    return side.where("site is not null").select("id", "name", "site", F.explode(F.array_distinct(F.array("site", F.coalesce("address", "site")))).alias("key"))


def site_shares(left: DataFrame, names: DataFrame, both_ways: DataFrame) -> DataFrame:
    """(id, site, key, share): of the candidates with this site or address, the share whose names are spellings of this one's.

    So a site is somebody's own, with 1, however many records that act has, and each of
    n acts has an nth of a host, at any size of the table. Records without a name count
    as spellings of each other.
    """
    keys = _site_keys(left).join(names.select("name", "form"), "name", "left").withColumn("form", F.coalesce("form", F.lit("")))
    forms = keys.groupBy("key", "form").agg(F.count("*").alias("n"))
    total = keys.groupBy("key").agg(F.count_distinct("id").alias("total"), F.count_distinct("form").alias("forms"))
    mixed = forms.join(total.where("forms > 1").select("key"), "key", "left_semi")
    beside = mixed.select("key", F.col("form").alias("form_a")).join(both_ways.select("form_a", "form_b"), "form_a").join(mixed.withColumnRenamed("form", "form_b"), ["key", "form_b"])
    beside = beside.groupBy("key", F.col("form_a").alias("form")).agg(F.sum("n").alias("more"))
    share = F.least(F.lit(1.0), (F.col("n") + F.coalesce("more", F.lit(0))) / F.col("total"))
    shares = forms.join(beside, ["key", "form"], "left").join(total, "key").select("key", "form", share.alias("share"))
    return keys.join(shares, ["key", "form"]).groupBy("id", "site", "key").agg(F.max("share").alias("share"))


def _strength(share: Column) -> Column:
    """How much of a site's weight counts for an act with this share of it."""
    return F.least(F.lit(1.0), share * ((OWN_SITE + 0.5) * W_PRIOR / W_SITE))


def outweighs(site: Column) -> Column:
    """Whether what the site says is worth more than the prior."""
    return site * W_SITE > W_PRIOR


def _compare_widely(batches):
    """Rows (a, b, name) of the pairs (a, b, wa, wb) whose names differ by no more than one edit beyond the bound."""
    for batch in batches:
        cost = np.array([name_cost(x, y, 1) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], np.float64)
        out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1 - cost / 8)], names=["a", "b", "name"])
        yield out.filter(pa.array(cost <= BOUND + 1))


def paired(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of the two sides with similar names or one site, and what speaks for and against each.

    Columns: a, b, platform, name (1 for equal forms), town (1, 0 unknown, -1 different),
    site (likewise, less of either the more acts share it), tags (weighted share of the smaller set that is common, -1 if both
    have tags and none is common, null if a side has none).
    """
    places = left.select("place").unionByName(right.select("place")).where("trim(place) <> ''")
    countries = settle(countries_of(places))
    left, right = settle(_placed(left, countries)), settle(_placed(right, countries))

    names = plain_forms(left.select("name").unionByName(right.select("name")))
    names = settle(names)
    similar = settle(similar_forms(names))
    both_ways = similar.unionByName(similar.select(F.col("form_b").alias("form_a"), F.col("form_a").alias("form_b"), "cost"))
    same = names.select("form").distinct().select(F.col("form").alias("form_a"), F.col("form").alias("form_b"), F.lit(0).alias("cost"))
    spelt = names.select("name", "form")
    la = left.join(spelt, "name").select(F.col("id").alias("a"), F.col("form").alias("form_a"))
    rb = right.join(spelt, "name").select(F.col("id").alias("b"), F.col("form").alias("form_b"))
    by_name = both_ways.unionByName(same).join(la, "form_a").join(rb, "form_b").select("a", "b", (1 - F.col("cost") / 8).alias("name"))
    # a site shared by so many that it doesn't outweigh the prior can't make a pair of unlike names by itself; the whole address still can
    shares = settle(site_shares(left, names, both_ways))
    vouching = shares.where(outweighs(_strength(F.col("share")))).select(F.col("id").alias("a"), "key")
    by_site = vouching.join(_site_keys(right).select(F.col("id").alias("b"), "key"), "key").select("a", "b", F.lit(0.65).alias("name"))
    # names further apart, of records with a word, a town and a tag in common
    def marks(side: DataFrame, i: str) -> DataFrame:
        told = side.where("size(towns) > 0 and size(tags) > 0").join(names.select("name", "words"), "name")
        each = told.select(F.col("id").alias(i), F.col("words").alias(f"w{i}"), F.explode("words").alias("w"), "towns", "tags")
        each = each.select(i, f"w{i}", "w", F.explode("towns").alias("t"), "tags").select(i, f"w{i}", "w", "t", F.explode("tags").alias("g"))
        return each.select(i, f"w{i}", F.xxhash64("w", "t", "g").alias("mark"))

    beside = marks(left, "a").join(marks(right, "b"), "mark").groupBy("a", "b", "wa", "wb").agg(F.lit(1).alias("met")).repartition(shuffle_width(left.sparkSession))
    ids = {i: side.schema["id"].dataType.simpleString() for i, side in (("a", left), ("b", right))}
    by_marks = beside.select("a", "b", "wa", "wb").mapInArrow(_compare_widely, f"a {ids['a']}, b {ids['b']}, name double")
    pairs = by_name.unionByName(by_site).unionByName(by_marks).groupBy("a", "b").agg(F.max("name").alias("name"))

    weights = left.select(F.explode("tags").alias("tag")).unionByName(right.select(F.explode("tags").alias("tag"))).groupBy("tag").count()
    sides = left.count() + right.count()
    own = shares.groupBy("id").agg(F.max(F.when(F.col("key") == F.col("site"), F.col("share"))).alias("own"), F.max("share").alias("own_address"))
    hosts = shares.where("key = site").groupBy("site").agg(F.avg("share").alias("own_b"))
    full = (
        pairs.join(left.join(own, "id", "left").select(F.col("id").alias("a"), F.col("towns").alias("ta"), F.col("tags").alias("ga"), F.col("site").alias("sa"), F.col("address").alias("aa"), "own", "own_address"), "a")
        .join(right.join(hosts, "site", "left").select(F.col("id").alias("b"), "platform", F.col("towns").alias("tb"), F.col("tags").alias("gb"), F.col("site").alias("sb"), F.col("address").alias("ab"), F.coalesce("own_b", F.lit(1.0)).alias("own_b")), "b")
    )
    full = settle(full)
    weight = F.log(F.lit(1.0) + F.lit(float(sides)) / F.col("count"))
    told = full.where("size(ga) > 0 and size(gb) > 0").select("a", "b", "ga", "gb", F.explode(F.array_union("ga", "gb")).alias("tag")).join(weights, "tag")
    in_a, in_b = F.array_contains("ga", F.col("tag")), F.array_contains("gb", F.col("tag"))
    common, of_a, of_b = (F.sum(F.when(where, weight).otherwise(0.0)) for where in (in_a & in_b, in_a, in_b))
    shares = told.groupBy("a", "b").agg((common / F.least(of_a, of_b)).alias("share"))
    town = F.when((F.size("ta") > 0) & (F.size("tb") > 0), _same_town(F.coalesce("ta", F.array().cast("array<string>")), F.coalesce("tb", F.array().cast("array<string>"))) * 2 - 1).otherwise(0)
    same_site = _strength(F.when(F.col("aa") == F.col("ab"), F.col("own_address")).otherwise(F.col("own")))
    site = F.when(F.col("sa").isNull() | F.col("sb").isNull(), 0.0).when(F.col("sa") == F.col("sb"), same_site).otherwise(-_strength(F.least("own", "own_b")))
    return full.join(shares, ["a", "b"], "left").select(
        "a", "b", "platform", "name", town.alias("town"), site.alias("site"), F.when(F.col("share") == 0, -1.0).otherwise(F.col("share")).alias("tags")
    )


def ground_rules(pairs: DataFrame) -> DataFrame:
    """Rows (rule, var, coef, base, weight): a rule loses weight * max(0, base + sum of coef * variable).

    The variable of a pair is its hash-free name ``a|b``.
    """
    v = pairs.withColumn("var", F.concat_ws("|", F.col("a").cast("string"), F.col("b").cast("string")))

    def one(kind: str, where: Column, weight: float | Column, base: Column, coef: float) -> DataFrame:
        return v.where(where).select(F.concat(F.lit(f"{kind}:"), "var").alias("rule"), "var", F.lit(coef).alias("coef"), base.cast("double").alias("base"), F.lit(weight).alias("weight"))

    own_site, other_site = outweighs(F.col("site")), outweighs(-F.col("site"))

    tags = 0.75 + 0.25 * F.col("tags")  # a tag in common says much, more of them little more
    rules = [
        one("site", F.col("site") > 0, W_SITE * F.col("site"), F.col("name"), -1.0),
        one("place", F.col("town") == 1, W_PLACE, F.col("name"), -1.0),
        one("tags", F.col("tags") > 0, W_TAGS, F.col("name") + tags - 1, -1.0),
        one("prior", F.lit(True), W_PRIOR, F.lit(0.0), 1.0),
        one("othersite", F.col("site") < 0, -W_OTHER_SITE * F.col("site"), F.lit(0.0), 1.0),
        one("otherplace", F.col("town") == -1, W_OTHER_PLACE, F.lit(0.0), 1.0),
        one("othertags", F.col("tags") == -1, W_OTHER_TAGS, F.lit(0.0), 1.0),
    ]
    # One page a platform: the pairs of a candidate on one platform sum up to no more than 1.
    crowd = v.groupBy("a", "platform").agg(F.count("*").alias("n")).where("n > 1").select("a", "platform")
    only = v.join(crowd, ["a", "platform"]).select(
        F.concat_ws(":", F.lit("one"), F.col("a").cast("string"), "platform").alias("rule"), "var", F.lit(1.0).alias("coef"), F.lit(-1.0).alias("base"), F.lit(W_ONE_PAGE).alias("weight")
    )
    rules.append(only)
    # Transitivity: a page that agrees with the page best for a candidate in place or tags pulls the others with it.
    # And a candidate that agrees with the page the other candidates of a page. Exclusivity on the page's side: a
    # candidate that the page contradicts and the best one that it agrees with sum up to no more than 1.
    for side in ("a", "b"):
        best = v.where((F.col("town") == 1) | own_site).groupBy(side).agg(F.max_by("var", F.struct("site", "town", "name", "var")).alias("head"))
        beside = v.join(best, side).where("var <> head")
        alike = F.expr("town = 1 or tags > 0.5") if side == "a" else F.expr("town = 1 or (tags > 0.5 and town = 0)") & ((F.col("town") == 1) | ~other_site)
        chained = beside.where(alike).withColumn("rule", F.concat(F.lit(f"same {side}:"), "var"))
        against = beside.where((F.col("town") == -1) | other_site).withColumn("rule", F.concat(F.lit(f"either {side}:"), "var"))
        both = [(chained, -0.1, -1.0, W_SAME_ACT)] + ([(against, -1.0, 1.0, W_ONE_PAGE)] if side == "b" else [])
        for pair, base, coef_of_var, weight in both:
            for name, coef in (("head", 1.0), ("var", coef_of_var)):
                rules.append(pair.select("rule", F.col(name).alias("var"), F.lit(coef).alias("coef"), F.lit(base).alias("base"), F.lit(weight).alias("weight")))
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


def _groups(rules: DataFrame) -> DataFrame:
    """(var, grp): variables that rules couple, directly or by way of others, share a group: the least of them."""
    coupled = rules.groupBy("rule").agg(F.count_distinct("var").alias("n")).where("n > 1").select("rule")
    edges = settle(rules.join(coupled, "rule", "left_semi").select("rule", "var").distinct())
    labels = settle(rules.select("var").distinct().withColumn("grp", F.col("var")))
    while not edges.isEmpty():
        least = edges.join(labels, "var").groupBy("rule").agg(F.min("grp").alias("g"))
        near = edges.join(least, "rule").groupBy("var").agg(F.min("g").alias("g"))
        new = settle(labels.join(near, "var", "left").select("var", F.least("grp", F.coalesce("g", "grp")).alias("grp"), (F.col("g") < F.col("grp")).alias("fell")))
        if new.where("fell").isEmpty():
            break
        labels = new.select("var", "grp")
    return labels.select("var", "grp")


def _settled(batches):
    """Rows (var, value) of whole groups of rules: the rounds of ``solve`` on arrays, until all are settled."""
    rows = pd.concat(batches, ignore_index=True) if (batches := list(batches)) else pd.DataFrame()
    if rows.empty:
        return
    var, names = pd.factorize(rows["var"])
    rule, _ = pd.factorize(rows["rule"])
    coef, n = rows["coef"].to_numpy(), np.bincount(var)
    base, weight = (rows.groupby(rule)[c].first().to_numpy() for c in ("base", "weight"))
    norm = np.bincount(rule, coef * coef)
    x, u, z = np.full(len(rows), 0.5), np.zeros(len(rows)), np.full(len(names), 0.5)
    while True:
        new = np.clip(np.bincount(var, x + u) / n, 0, 1)
        u = u + x - new[var]
        v = new[var] - u
        s = base + np.bincount(rule, coef * v)
        x = v - np.where(s <= 0, 0, np.minimum(weight / RHO, s / norm))[rule] * coef
        far, z = max(np.abs(new - z).max(), np.abs(x - new[var]).max()), new
        if far <= TOLERANCE:
            break
    yield pd.DataFrame({"var": names, "value": np.clip(np.bincount(var, x + u) / n, 0, 1)})


def solve(rules: DataFrame, rounds: int | None = None, rho: float = RHO) -> DataFrame:
    """(var, value): the values in [0, 1] that the weighted rules lose least with.

    Rounds go on until no copy is further than TOLERANCE from its variable and no
    variable moves further, or for ``rounds`` of them. Groups of rules without a common
    variable are settled by themselves: those up to GROUP_ROWS in the task that holds
    them, larger ones by joins over all tasks.
    """
    if rounds is not None:
        return _solve_joined(rules, rounds, rho)
    rules = settle(rules)
    grouped = settle(rules.join(_groups(rules), "var"))
    large = settle(grouped.groupBy("grp").count().where(F.col("count") > GROUP_ROWS).select("grp"))
    kept = ("grp", "rule", "var", "coef", "base", "weight")
    small = grouped.join(large, "grp", "left_anti").select(*kept).repartition(4 * shuffle_width(rules.sparkSession), "grp")
    values = small.mapInPandas(_settled, "var string, value double")
    return values if large.isEmpty() else values.unionByName(_solve_joined(grouped.join(large, "grp", "left_semi"), None, rho))


def _solve_joined(rules: DataFrame, rounds: int | None, rho: float) -> DataFrame:
    copies = settle(rules.select("rule", "var", "coef", "base", "weight", F.lit(0.5).alias("x"), F.lit(0.0).alias("u"), F.lit(0.5).alias("z")))
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.avg(F.col("x") + F.col("u"))))
    at, far = 0, 1.0
    while far > TOLERANCE if rounds is None else at < rounds:
        at += 1
        moved = copies.join(copies.groupBy("var").agg(value.alias("new")), "var").withColumn("u", F.col("u") + F.col("x") - F.col("new")).withColumn("v", F.col("new") - F.col("u"))
        loss = moved.groupBy("rule").agg((F.first("base") + F.sum(F.col("coef") * F.col("v"))).alias("s"), F.sum(F.col("coef") * F.col("coef")).alias("norm"))
        step = F.when(F.col("s") <= 0, 0.0).otherwise(F.least(F.col("weight") / rho, F.col("s") / F.col("norm")))
        stepped = moved.join(loss, "rule").withColumn("x", F.col("v") - step * F.col("coef"))
        far_of = F.greatest(F.abs(F.col("new") - F.col("z")), F.abs(F.col("x") - F.col("new"))).alias("far")
        copies = settle(stepped.select("rule", "var", "coef", "base", "weight", "x", "u", F.col("new").alias("z"), far_of))
        if rounds is None:
            far = copies.agg(F.max("far")).first()[0] or 0.0
    return copies.groupBy("var").agg(value.alias("value"))


def linked(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """(candidate_id, identity_id, sureness) of every pair that comes into question.

    Null, blank and repeated rows: a record without a name is linked by its site alone,
    one without either by nothing. Missing places, tags and sites speak neither for nor
    against. A site says less the more acts, not records, share it; where more than
    OWN_SITE do, only pairs with similar names or the whole address in common come into
    question. Extra columns are ignored; an empty table gives no pairs.
    """
    pairs = settle(paired(candidate_side(candidates), page_side(pages)))
    values = solve(ground_rules(pairs))
    named = pairs.select("a", "b", F.concat_ws("|", F.col("a").cast("string"), F.col("b").cast("string")).alias("var"))
    return named.join(values, "var").select(F.col("a").alias("candidate_id"), F.col("b").alias("identity_id"), F.col("value").alias("sureness"))


def p5_found(spark, sf_dir: str) -> DataFrame:
    found = linked(table(spark, sf_dir, "bc_candidate"), table(spark, sf_dir, "platform_identity"))
    return found.where(F.col("sureness") >= SURE).select("candidate_id", "identity_id")


QUERIES = {"p5_found": p5_found}
SQL: dict[str, str] = {}
