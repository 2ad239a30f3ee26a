"""Weighted tags: moments, calibrated rankings, curation and frequency."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tag_words import ERA, INSTRUMENTS, LABEL, META, MOODS, NUMERIC, PLACES, STATES
from ..session import table

# How many tags a ranking keeps, and how near to the best.
TAG_K, REL_GATE = 10, 0.5
AUDIO_TAG_K, AUDIO_REL_GATE = 4, 0.85
CENTERING_C = 0.585
MAGNET_SHARE, MAGNET_HUMAN_MAX = 0.08, 100


def held_scores(spark, sf_dir: str) -> DataFrame:
    """(artist_id, tag, model, score double): the latest row of each, without null and NaN scores."""
    rows = table(spark, sf_dir, "artist_tag_scores").where("artist_id is not null and tag is not null and model is not null")
    held = rows.groupBy("artist_id", "tag", "model").agg(F.max(F.struct("computed_at", "score")).alias("h"))
    return held.select("artist_id", "tag", "model", F.col("h.score").cast("double").alias("score")).where("score is not null and not isnan(score)")


def moments(scores: DataFrame, least: int = 2) -> DataFrame:
    """(tag, model, mean, sd, n) of tags with at least ``least`` scores; sd is the sample's, at least 1e-6."""
    sd = F.greatest(F.stddev("score"), F.lit(1e-6))
    return scores.groupBy("tag", "model").agg(F.avg("score").alias("mean"), sd.alias("sd"), F.count("*").alias("n")).where(F.col("n") >= least)


def global_moments(scores: DataFrame) -> DataFrame:
    """(model, gmean, gsd, artists): one row a model."""
    return scores.groupBy("model").agg(
        F.avg("score").alias("gmean"), F.greatest(F.coalesce(F.stddev("score"), F.lit(1e-6)), F.lit(1e-6)).alias("gsd"), F.count_distinct("artist_id").alias("artists")
    )


def calibrated(scores: DataFrame) -> DataFrame:
    """The scores with z by the tag's moments, or the model's where a tag has none, and idf and rate of the tag."""
    joined = scores.join(moments(scores), ["tag", "model"], "left").join(F.broadcast(global_moments(scores)), "model")  # a row a model
    z = (F.col("score") - F.coalesce("mean", "gmean")) / F.coalesce("sd", "gsd")
    n = F.col("artists").cast("double")
    return joined.select(
        "artist_id", "tag", "model", "score", z.alias("z"), F.log(n / F.greatest(F.coalesce("n", F.lit(1)), F.lit(1))).alias("idf"), (F.coalesce("n", F.lit(0)) / n).alias("rate")
    )


def weight(z: Column) -> Column:
    """A tag's weight: half-even rounded z plus 1, at least 1."""
    return F.greatest(F.lit(1), F.bround(z).cast("int") + 1)


def gated(rows: DataFrame, value: str, k: int, gate: float, keep_first: bool) -> DataFrame:
    """The k best of each artist and model within ``gate`` of the best; equal values by tag."""
    of = Window.partitionBy("artist_id", "model")
    best = rows.withColumn("rn", F.row_number().over(of.orderBy(F.desc(value), "tag"))).where(F.col("rn") <= k)  # cut before the shuffle
    near = (F.col(value) > 0) & (F.col(value) >= gate * F.col("top"))
    return best.withColumn("top", F.max(value).over(of)).where((F.col("rn") == 1) | near if keep_first else near)


def tag_rank_zidf(spark, sf_dir: str) -> DataFrame:
    z = calibrated(held_scores(spark, sf_dir)).where("rate < 1.0").withColumn("za", F.round(F.col("z") * F.col("idf"), 9))
    return gated(z, "za", TAG_K, REL_GATE, False).select("artist_id", "model", "tag", weight(F.round("z", 6)).alias("weight"))


def centring(scores: DataFrame) -> DataFrame:
    """(tag, model, d): how far a tag's mean lies above the model's, in the model's deviations, between 0 and 1."""
    d = (F.col("mean") - F.col("gmean")) / F.col("gsd")
    return moments(scores).join(F.broadcast(global_moments(scores)), "model").select("tag", "model", F.least(F.lit(1.0), F.greatest(F.lit(0.0), d)).alias("d"))


def tag_rank_centred(spark, sf_dir: str) -> DataFrame:
    """Tags by score less the part that the tag's own level explains; the best one is always kept."""
    scores = held_scores(spark, sf_dir)
    rows = calibrated(scores).join(centring(scores), ["tag", "model"], "left").withColumn("c", F.round(F.col("score") - CENTERING_C * F.coalesce("d", F.lit(0.0)), 9))
    return gated(rows, "c", AUDIO_TAG_K, AUDIO_REL_GATE, True).select("artist_id", "model", "tag", F.round("c", 5).alias("centred"), weight(F.round("z", 6)).alias("weight"))


def tag_calibration_moments(spark, sf_dir: str) -> DataFrame:
    m = moments(held_scores(spark, sf_dir))
    return m.select("tag", "model", F.round("mean", 5).alias("mean"), F.round("sd", 5).alias("sd"), "n")


def tag_fallback_rank(spark, sf_dir: str) -> DataFrame:
    """Tags over both models together, by mean z times the root of the count."""
    z = calibrated(held_scores(spark, sf_dir)).groupBy("artist_id", "tag").agg(F.avg("z").alias("mz"), F.count("*").alias("n")).where("round(mz, 9) > 0")
    order = Window.partitionBy("artist_id").orderBy(F.desc(F.round(F.col("mz") * F.sqrt("n"), 9)), "tag")
    return z.withColumn("place", F.row_number().over(order)).where(F.col("place") <= AUDIO_TAG_K).select("artist_id", "tag", F.round("mz", 5).alias("mz"), "place")


def human_tag_artists(spark, sf_dir: str) -> DataFrame:
    """(tag, humans): in how many candidates people gave a tag."""
    c = table(spark, sf_dir, "bc_candidate").groupBy("id").agg(F.max("tags").alias("tags"))
    return c.select("id", F.explode("tags").alias("tag")).select("id", F.lower(F.trim("tag")).alias("tag")).where("tag <> ''").groupBy("tag").agg(F.count_distinct("id").alias("humans"))


def tag_shares(spark, sf_dir: str) -> DataFrame:
    """(model, tag, share): the share of a model's artists that have the tag."""
    scores = held_scores(spark, sf_dir)
    n = scores.groupBy("model").agg(F.count_distinct("artist_id").alias("artists"))
    return scores.groupBy("model", "tag").agg(F.count_distinct("artist_id").alias("n")).join(F.broadcast(n), "model").select("model", "tag", (F.col("n") / F.col("artists")).alias("share"))


def magnets(spark, sf_dir: str) -> DataFrame:
    joined = tag_shares(spark, sf_dir).where(F.col("share") > MAGNET_SHARE).join(human_tag_artists(spark, sf_dir), "tag", "left")
    return joined.withColumn("humans", F.coalesce("humans", F.lit(0))).where(F.col("humans") < MAGNET_HUMAN_MAX)


def magnet_blocklist(spark, sf_dir: str) -> DataFrame:
    return magnets(spark, sf_dir).select("model", "tag", F.round("share", 6).alias("share"), "humans")


def tag_histogram(spark, sf_dir: str) -> DataFrame:
    """How many tags of a model reach each share of its artists."""
    at = lambda t: F.sum(F.when(F.col("share") >= t, 1).otherwise(0)).alias(f"ge{int(t * 100)}")
    return tag_shares(spark, sf_dir).groupBy("model").agg(at(0.15), at(0.10), at(0.05), at(0.01), F.count("*").alias("tags"))


def tag_concentration(spark, sf_dir: str) -> DataFrame:
    """The part of all assignments that a model's 100 most frequent tags have."""
    counts = held_scores(spark, sf_dir).groupBy("model", "tag").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("n"), "tag"))
    top = counts.withColumn("place", place).where("place <= 100").groupBy("model").agg(F.sum("n").alias("top"))
    return counts.groupBy("model").agg(F.sum("n").alias("all_n")).join(top, "model").select("model", F.round(F.col("top") / F.col("all_n"), 6).alias("top_share"))


def magnet_load(spark, sf_dir: str) -> DataFrame:
    """Magnet tags per artist, over the artists that have any."""
    scores = held_scores(spark, sf_dir).join(magnets(spark, sf_dir).select("model", "tag"), ["model", "tag"], "left_semi")
    per = scores.groupBy("model", "artist_id").agg(F.count("*").alias("n"))
    return per.groupBy("model").agg(F.round(F.avg("n"), 6).alias("mean_magnets"), F.count("*").alias("artists"))


def _element_tags(spark, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "bc_candidate").where("id is not null").groupBy("id").agg(F.max("tags").alias("tags"))
    return c.select("id", F.explode("tags").alias("tag")).select("id", F.lower(F.trim("tag")).alias("tag")).where("tag <> ''")


def tag_frequency(spark, sf_dir: str) -> DataFrame:
    return _element_tags(spark, sf_dir).groupBy("tag").agg(F.count("*").alias("n"))


def fold_aliases(tags: DataFrame, aliases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, tag, weight) of rows (keys, tag, weight): each tag by the names its aliases give, else as it is; weights of
    one name are added. ``aliases``, (alias, name), may give a tag several names; each then has the whole weight."""
    named = tags.join(aliases.select(F.col("alias").alias("tag"), "name").distinct(), "tag", "left")
    return named.groupBy(*keys, F.coalesce("name", "tag").alias("tag")).agg(F.sum("weight").alias("weight"))


def spelling_aliases(tags: DataFrame) -> DataFrame:
    """(alias, name) of tags with the same letters and digits: the most frequent spelling, of equals the least, is the name."""
    key = F.regexp_replace("tag", r"[^\p{L}\p{N}]", "")
    counts = tags.groupBy("tag").agg(F.count("*").alias("n")).withColumn("key", key).where("key <> ''")
    best = counts.groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("m"), "tag"))["tag"].alias("name"))
    return counts.join(best, "key").where("tag <> name").select(F.col("tag").alias("alias"), "name")


def alias_fold(spark, sf_dir: str) -> DataFrame:
    """Tags of each candidate folded onto their most frequent spelling, weights added."""
    rows = _element_tags(spark, sf_dir)
    return fold_aliases(rows.withColumn("weight", F.lit(1)), spelling_aliases(rows), ["id"])


def human_tier_union(spark, sf_dir: str) -> DataFrame:
    """Scored tags of an artist (weight 3) and tags people gave to its candidates (weight 1), weights added, ten best."""
    scored = held_scores(spark, sf_dir).select("artist_id", F.lower(F.trim("tag")).alias("tag")).where("tag <> ''").distinct().withColumn("weight", F.lit(3))
    owner = table(spark, sf_dir, "bc_candidate").where("id is not null").groupBy("id").agg(F.max("artist_id").alias("artist_id")).where("artist_id is not null")
    human = _element_tags(spark, sf_dir).join(owner, "id").select("artist_id", "tag").distinct().withColumn("weight", F.lit(1))
    both = scored.unionByName(human).groupBy("artist_id", "tag").agg(F.sum("weight").alias("weight"))
    place = F.row_number().over(Window.partitionBy("artist_id").orderBy(F.desc("weight"), "tag"))
    return both.withColumn("place", place).where(F.col("place") <= TAG_K).select("artist_id", "tag", "weight", "place")


def ngrams(tag: Column) -> Column:
    """Runs of words of a tag, each with its first and last place; - _ / part words."""
    words = F.filter(F.split(F.regexp_replace(tag, r"[-_/]+", " "), r"\s+"), lambda w: w != "")
    n = F.size(words)
    starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    spans = F.transform(starts, lambda i: F.transform(F.sequence(i, n), lambda j: F.struct(i.alias("a"), j.alias("b"), F.array_join(F.slice(words, i, j - i + 1), " ").alias("gram"))))
    return F.flatten(spans)


def recovered(grams: Column) -> Column:
    """Of approved spans, those a walk from the left takes, the longest from each place."""
    ordered = F.array_sort(F.transform(grams, lambda g: F.struct(g["a"].alias("a"), (-g["b"]).alias("nb"), g["gram"].alias("gram"))))
    zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("out"))
    step = lambda acc, g: F.when(g["a"] > acc["end"], F.struct((-g["nb"]).alias("end"), F.concat(acc["out"], F.array(g["gram"])).alias("out"))).otherwise(acc)
    return F.aggregate(ordered, zero, step)["out"]


def approved_tags(spark, sf_dir: str) -> DataFrame:
    """Tags of at most two words that at least five candidates have."""
    counts = _element_tags(spark, sf_dir).groupBy("tag").agg(F.count_distinct("id").alias("n"))
    return counts.where("n >= 5 and size(split(tag, '[-_/ ]+')) <= 2").select("tag")


def genre_token_recovery(spark, sf_dir: str) -> DataFrame:
    """Approved genres inside the tags that aren't approved themselves."""
    tags, approved = _element_tags(spark, sf_dir).select("tag").distinct(), approved_tags(spark, sf_dir)
    loose = tags.join(approved, "tag", "left_anti").select("tag", F.explode(ngrams(F.col("tag"))).alias("g"))
    hits = loose.join(approved.withColumnRenamed("tag", "gram"), F.col("g.gram") == F.col("gram")).groupBy("tag").agg(F.collect_list("g").alias("grams"))
    return hits.select("tag", F.array_join(recovered(F.col("grams")), "|").alias("genres"))


def allowlist_gate(spark, sf_dir: str) -> DataFrame:
    """A candidate's tags as genres: approved ones whole, the others by the genres in them, the greater weight holding."""
    weighted = _element_tags(spark, sf_dir).groupBy("id", "tag").agg(F.count("*").alias("weight"))
    kept = weighted.join(approved_tags(spark, sf_dir), "tag", "left_semi").select("id", F.col("tag").alias("genre"), "weight")
    inside = genre_token_recovery(spark, sf_dir).select("tag", F.explode(F.split("genres", r"\|")).alias("genre"))
    return kept.unionByName(weighted.join(inside, "tag").select("id", "genre", "weight")).groupBy("id", "genre").agg(F.max("weight").alias("weight"))


def category(tag: Column) -> Column:
    """The first rule that a tag in lower case meets; null for what may be a genre."""
    words = F.split(F.trim(F.replace(tag, F.lit(","), F.lit(" "))), r"\s+")
    in_state = (F.size(words) > 1) & F.element_at(words, -1).isin(STATES)
    rules = [
        ("location", tag.isin(PLACES)), ("instrument", tag.isin(INSTRUMENTS)), ("meta", tag.isin(META)), ("mood", tag.isin(MOODS)),
        ("era", tag.rlike(ERA)), ("label", tag.rlike(LABEL)), ("meta", tag.rlike(NUMERIC)), ("location", in_state),
    ]
    return reduce(lambda c, r: c.when(r[1], r[0]), rules[1:], F.when(rules[0][1], rules[0][0]))


def tag_classify_heuristic(spark, sf_dir: str) -> DataFrame:
    return _element_tags(spark, sf_dir).groupBy("tag").agg(F.count("*").alias("n")).withColumn("category", category(F.col("tag"))).where("category is not null")


def calibrated_tags_topk(spark, sf_dir: str) -> DataFrame:
    """The hundred highest scores against their tag's moments, or the model's where fewer than 20 scores make them."""
    scores = held_scores(spark, sf_dir)
    joined = scores.join(moments(scores), ["tag", "model"], "left").join(F.broadcast(global_moments(scores)), "model")  # a row a model
    own = F.coalesce(F.col("n") >= 20, F.lit(False))
    z = (F.col("score") - F.when(own, F.col("mean")).otherwise(F.col("gmean"))) / F.when(own, F.col("sd")).otherwise(F.col("gsd"))
    return joined.select("artist_id", "tag", "model", F.round(z, 6).alias("z")).orderBy(F.desc("z"), "artist_id", "tag", "model").limit(100)


def _owned_tags(spark, sf_dir: str) -> DataFrame:
    """(artist_id, tag) of the tags that people gave to an artist's candidates, each once."""
    owner = table(spark, sf_dir, "bc_candidate").where("id is not null").groupBy("id").agg(F.max("artist_id").alias("artist_id")).where("artist_id is not null")
    return _element_tags(spark, sf_dir).join(owner, "id").select("artist_id", "tag").distinct()


def human_tag_tier(spark, sf_dir: str) -> DataFrame:
    """The first ten tags by alphabet that people gave to an artist's candidates."""
    place = F.row_number().over(Window.partitionBy("artist_id").orderBy("tag"))
    return _owned_tags(spark, sf_dir).withColumn("place", place).where(F.col("place") <= TAG_K)


def human_then_scored(spark, sf_dir: str) -> DataFrame:
    """Five tags an artist: people's first, then the scored ones by their best score, each spelling in lower case once."""
    human = human_tag_tier(spark, sf_dir).select("artist_id", "tag", F.lit(0).alias("tier"), F.col("place").cast("double").alias("at"))
    low = held_scores(spark, sf_dir).select("artist_id", F.lower(F.trim("tag")).alias("tag"), "score").where("tag <> ''")
    scored = low.groupBy("artist_id", "tag").agg((-F.max("score")).alias("at")).select("artist_id", "tag", F.lit(1).alias("tier"), "at")
    once = human.unionByName(scored).groupBy("artist_id", "tag").agg(F.min(F.struct("tier", "at")).alias("o"))
    place = F.row_number().over(Window.partitionBy("artist_id").orderBy("o.tier", "o.at", "tag"))
    return once.withColumn("place", place).where("place <= 5").select("artist_id", "place", "tag", F.col("o.tier").alias("tier"))


def undecided_tags(spark, sf_dir: str) -> DataFrame:
    """Tags that are neither approved nor sorted out by a rule, with the candidates that have them."""
    counts = _element_tags(spark, sf_dir).groupBy("tag").agg(F.count_distinct("id").alias("n"))
    return counts.where(category(F.col("tag")).isNull()).join(approved_tags(spark, sf_dir), "tag", "left_anti")


def label_overlap(spark, sf_dir: str) -> DataFrame:
    """What an artist's scored tags share with those people gave: both sides' numbers, common ones, the share of the smaller side."""
    low = held_scores(spark, sf_dir).select("artist_id", F.lower(F.trim("tag")).alias("tag")).where("tag <> ''").distinct().withColumn("side", F.lit(1))
    both = low.unionByName(_owned_tags(spark, sf_dir).withColumn("side", F.lit(2))).groupBy("artist_id", "tag").agg(F.sum("side").alias("sides"))
    n = both.groupBy("artist_id").agg(F.count_if(F.col("sides") != 2).alias("scored"), F.count_if(F.col("sides") != 1).alias("human"), F.count_if(F.col("sides") == 3).alias("common"))
    return n.where("scored > 0 and human > 0").withColumn("share", F.round(F.col("common") / F.least("scored", "human"), 4))


def judged_counts(spark, sf_dir: str) -> DataFrame:
    """(model, at, pos, neg): scores to four places of artists that people tagged, by whether people gave the tag."""
    human = _owned_tags(spark, sf_dir)
    scores = held_scores(spark, sf_dir).join(human.select("artist_id").distinct(), "artist_id", "left_semi").withColumn("tag", F.lower(F.trim("tag")))
    judged = scores.join(human.withColumn("yes", F.lit(True)), ["artist_id", "tag"], "left")
    return judged.groupBy("model", F.round("score", 4).alias("at")).agg(F.count("yes").alias("pos"), F.count_if(F.col("yes").isNull()).alias("neg"))


def auc_rank_sum(spark, sf_dir: str) -> DataFrame:
    """Per model the chance that a tag people gave scores above another, equal scores as half: over counts of each score."""
    below = Window.partitionBy("model").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # a row a score of four places
    rows = judged_counts(spark, sf_dir).withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    sums = rows.groupBy("model").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("won"))
    return sums.where("pos > 0 and neg > 0").select("model", "pos", "neg", F.round(F.col("won") / (F.col("pos") * F.col("neg")), 6).alias("auc"))


def threshold_grid(spark, sf_dir: str) -> DataFrame:
    """Precision and recall of each model's scores from each of 19 bars on, against the tags people gave."""
    rows = judged_counts(spark, sf_dir).withColumn("bar", F.explode(F.sequence(F.lit(1), F.lit(19))))
    over = F.col("at") >= F.col("bar") / 20
    sums = rows.groupBy("model", "bar").agg(F.sum(F.when(over, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(over, F.col("neg")).otherwise(0)).alias("fp"), F.sum("pos").alias("all_pos"))
    ratio = lambda a, b: F.round(F.try_divide(a, b), 6)
    return sums.select("model", (F.col("bar") / 20).alias("bar"), "tp", "fp", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("all_pos")).alias("recall"))


_HELD = """held as (
  select artist_id, tag, model, score::double as score from (
    select *, row_number() over (partition by artist_id, tag, model order by computed_at desc nulls last, score desc nulls last) as rn
    from artist_tag_scores where artist_id is not null and tag is not null and model is not null)
  where rn = 1 and score is not null and not isnan(score)),
mom as (select tag, model, avg(score) as mean, greatest(stddev_samp(score), 1e-6) as sd, count(*) as n from held group by all having count(*) >= 2),
gm as (select model, avg(score) as gmean, greatest(coalesce(stddev_samp(score), 1e-6), 1e-6) as gsd, count(distinct artist_id) as artists from held group by 1),
cal as (select h.*, (score - coalesce(mean, gmean)) / coalesce(sd, gsd) as z, ln(artists::double / greatest(coalesce(n, 1), 1)) as idf, coalesce(n, 0) / artists::double as rate
  from held h left join mom using (tag, model) join gm using (model))"""
_CAND = "cand as (select id, max(tags) as tags, max(artist_id) as artist_id from bc_candidate where id is not null group by 1), els as (select * from (select id, lower(trim(tag, ' ')) as tag from (select id, unnest(tags) as tag from cand)) where tag <> '')"
_SHARES = "shares as (select model, tag, count(distinct artist_id) / max(artists)::double as share from held join gm using (model) group by all), humans as (select tag, count(distinct id) as humans from els group by 1), magnets as (select model, tag, share, coalesce(humans, 0) as humans from shares left join humans using (tag) where share > 0.08 and coalesce(humans, 0) < 100)"
_OWNED = "owned as (select distinct artist_id, tag from els join cand using (id) where artist_id is not null)"
_JUDGED = "jc as (select model, round(score, 4) as at, count(*) filter (where o.tag is not null) as pos, count(*) filter (where o.tag is null) as neg from (select * from held where artist_id in (select artist_id from owned)) h left join owned o on o.artist_id = h.artist_id and o.tag = lower(trim(h.tag, ' ')) group by all)"
_APPROVED = "approved as (select tag from els where len(string_split_regex(tag, '[-_/ ]+')) <= 2 group by tag having count(distinct id) >= 5)"


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


_KIND = f"""case when tag in {_in(PLACES)} then 'location' when tag in {_in(INSTRUMENTS)} then 'instrument' when tag in {_in(META)} then 'meta' when tag in {_in(MOODS)} then 'mood'
  when regexp_matches(tag, '{ERA.replace("'", "''")}') then 'era' when regexp_matches(tag, '{LABEL}') then 'label' when regexp_matches(tag, '{NUMERIC.replace("'", "''")}') then 'meta'
  when regexp_matches(tag, '[^ ,].*[ ,]({"|".join(STATES)})[ ,]*$') then 'location' end"""
QUERIES = {
    f.__name__: f
    for f in (tag_rank_zidf, tag_rank_centred, tag_calibration_moments, tag_fallback_rank, magnet_blocklist, tag_histogram, tag_concentration, magnet_load, tag_frequency, alias_fold, human_tier_union, genre_token_recovery, allowlist_gate, tag_classify_heuristic, calibrated_tags_topk, human_tag_tier, human_then_scored, undecided_tags, label_overlap, auc_rank_sum, threshold_grid)
}
SQL = {
    "tag_rank_zidf": f"""with {_HELD}, r as (select *, round(z * idf, 9) as za from cal where rate < 1.0),
      k as (select *, row_number() over (partition by artist_id, model order by za desc, tag) as rn, max(za) over (partition by artist_id, model) as top from r)
      select artist_id, model, tag, greatest(1, round_even(round(z, 6), 0)::int + 1) as weight from k where rn <= 10 and za > 0 and za >= 0.5 * top""",
    "tag_rank_centred": f"""with {_HELD}, d as (select tag, model, least(1.0, greatest(0.0, (mean - gmean) / gsd)) as d from mom join gm using (model)),
      r as (select cal.*, round(score - 0.585 * coalesce(d, 0.0), 9) as c from cal left join d using (tag, model)),
      k as (select *, row_number() over (partition by artist_id, model order by c desc, tag) as rn, max(c) over (partition by artist_id, model) as top from r)
      select artist_id, model, tag, round(c, 5) as centred, greatest(1, round_even(round(z, 6), 0)::int + 1) as weight from k where rn <= 4 and (rn = 1 or (c > 0 and c >= 0.85 * top))""",
    "tag_calibration_moments": f"with {_HELD} select tag, model, round(mean, 5) as mean, round(sd, 5) as sd, n from mom",
    "tag_fallback_rank": f"""with {_HELD}, m as (select artist_id, tag, avg(z) as mz, count(*) as n from cal group by all having round(avg(z), 9) > 0),
      k as (select *, row_number() over (partition by artist_id order by round(mz * sqrt(n), 9) desc, tag) as place from m)
      select artist_id, tag, round(mz, 5) as mz, place::int as place from k where place <= 4""",
    "magnet_blocklist": f"with {_HELD}, {_CAND}, {_SHARES} select model, tag, round(share, 6) as share, humans from magnets",
    "tag_histogram": f"with {_HELD}, {_CAND}, {_SHARES} select model, count(*) filter (where share >= 0.15) as ge15, count(*) filter (where share >= 0.10) as ge10, count(*) filter (where share >= 0.05) as ge5, count(*) filter (where share >= 0.01) as ge1, count(*) as tags from shares group by 1",
    "tag_concentration": f"""with {_HELD}, c as (select model, tag, count(*) as n from held group by all), k as (select *, row_number() over (partition by model order by n desc, tag) as p from c)
      select model, round(sum(n) filter (where p <= 100) / sum(n), 6) as top_share from k group by 1""",
    "magnet_load": f"""with {_HELD}, {_CAND}, {_SHARES}, p as (select model, artist_id, count(*) as n from held join magnets using (model, tag) group by all)
      select model, round(avg(n), 6) as mean_magnets, count(*) as artists from p group by 1""",
    "tag_frequency": f"with {_CAND} select tag, count(*) as n from els group by 1",
    "alias_fold": f"""with {_CAND}, n as (select tag, count(*) as n, regexp_replace(tag, '[^\\p{{L}}\\p{{N}}]', '', 'g') as key from els group by 1),
      b as (select tag, first(tag) over (partition by key order by n desc, tag) as name from n where key <> '')
      select id, coalesce(name, els.tag) as tag, count(*) as weight from els left join b using (tag) group by all""",
    "human_tier_union": f"""with {_HELD}, {_CAND}, b as (select * from (select distinct artist_id, lower(trim(tag, ' ')) as tag, 3 as weight from held) where tag <> '' union all select distinct artist_id, tag, 1 from els join cand using (id) where artist_id is not null),
      s as (select artist_id, tag, sum(weight) as weight from b group by all), k as (select *, row_number() over (partition by artist_id order by weight desc, tag) as place from s)
      select artist_id, tag, weight::bigint as weight, place::int as place from k where place <= 10""",
    "genre_token_recovery": f"""with recursive {_CAND}, {_APPROVED}, loose as (select distinct tag, list_filter(string_split_regex(regexp_replace(tag, '[-_/]+', ' ', 'g'), '\\s+'), lambda w: w <> '') as w from els where tag not in (select tag from approved)),
      spans as (select tag, a, b, array_to_string(w[a:b], ' ') as gram from (select tag, w, unnest(range(1, len(w) + 1)) as a from loose) l, lateral (select unnest(range(a, len(l.w) + 1)) as b)),
      best as (select tag, a, max(b) as b from spans where gram in (select tag from approved) group by all),
      walk as (
        select tag, 0 as a, 0 as b, 0 as k from (select distinct tag from best)
        union all
        select w.tag, n.a, n.b, w.k + 1 from walk w join best n on n.tag = w.tag and n.a = (select min(a) from best x where x.tag = w.tag and x.a > w.b))
      select w.tag, string_agg(s.gram, '|' order by w.k) as genres from walk w join spans s on s.tag = w.tag and s.a = w.a and s.b = w.b group by 1""",
    "tag_classify_heuristic": f"with {_CAND}, c as (select tag, count(*) as n from els group by 1), k as (select *, {_KIND} as category from c) select tag, n, category from k where category is not null",
    "calibrated_tags_topk": f"""with {_HELD} select artist_id, tag, model, round((score - case when n >= 20 then mean else gmean end) / case when n >= 20 then sd else gsd end, 6) as z
      from held left join mom using (tag, model) join gm using (model) order by z desc, artist_id, tag, model limit 100""",
    "human_tag_tier": f"with {_CAND}, {_OWNED}, k as (select *, row_number() over (partition by artist_id order by tag) as place from owned) select artist_id, tag, place::int as place from k where place <= 10",
    "human_then_scored": f"""with {_HELD}, {_CAND}, {_OWNED}, t as (select *, row_number() over (partition by artist_id order by tag)::double as k from owned),
      u as (select artist_id, tag, 0 as tier, k from t where k <= 10 union all select artist_id, lower(trim(tag, ' ')), 1, -max(score) from held where trim(tag, ' ') <> '' group by 1, 2),
      o as (select *, row_number() over (partition by artist_id, tag order by tier, k) as rn from u), z as (select *, row_number() over (partition by artist_id order by tier, k, tag) as place from o where rn = 1)
      select artist_id, place::int as place, tag, tier from z where place <= 5""",
    "undecided_tags": f"with {_CAND}, {_APPROVED} select tag, count(distinct id) as n from els where tag not in (select tag from approved) and {_KIND} is null group by 1",
    "label_overlap": f"""with {_HELD}, {_CAND}, {_OWNED}, s as (select distinct artist_id, lower(trim(tag, ' ')) as tag from held where trim(tag, ' ') <> ''),
      n as (select artist_id, count(s.tag) as scored, count(o.tag) as human, count(s.tag || o.tag) as common from s full join owned o using (artist_id, tag) group by 1) select *, round(common / least(scored, human), 4) as share from n where scored > 0 and human > 0""",
    "auc_rank_sum": f"""with {_HELD}, {_CAND}, {_OWNED}, {_JUDGED}, w as (select a.model, sum(a.pos * b.neg * case when b.at < a.at then 1 when b.at = a.at then 0.5 else 0 end)::double as won from jc a join jc b using (model) group by 1),
      t as (select model, sum(pos)::bigint as pos, sum(neg)::bigint as neg from jc group by 1) select model, pos, neg, round(won / (pos * neg), 6) as auc from t join w using (model) where pos > 0 and neg > 0""",
    "threshold_grid": f"""with {_HELD}, {_CAND}, {_OWNED}, {_JUDGED}, s as (select model, b / 20 as bar, coalesce(sum(pos) filter (where jc.at >= b / 20), 0)::bigint as tp, coalesce(sum(neg) filter (where jc.at >= b / 20), 0)::bigint as fp, sum(pos) as p from jc, range(1, 20) r(b) group by all)
      select model, bar, tp, fp, round(tp / nullif(tp + fp, 0), 6) as precision, round(tp / nullif(p, 0), 6) as recall from s""",
}
_walk, _last = SQL["genre_token_recovery"].rsplit("group by 1", 1)
_before, _after = _walk.split("select w.tag, string_agg(s.gram, '|' order by w.k) as genres")
SQL["allowlist_gate"] = f"""{_before}, rec as (select distinct w.tag, s.gram as genre {_after}), wt as (select id, tag, count(*) as weight from els group by all),
  u as (select id, tag as genre, weight from wt where tag in (select tag from approved) union all select id, genre, weight from wt join rec using (tag))
  select id, genre, max(weight) as weight from u group by all"""
