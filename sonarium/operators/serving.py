"""What is served of an artist: chains of tag tiers, means of axes, titles told twice, bars for a choice, runs to come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.titles import title_sets
from ..session import settle, table
from ..sources.payloads import first_filled, resolve_names, to_fetch
from . import tags as _tags
from .entities import _ASCII, artists, candidates, pages
from .vectors import _NEAR, knn_table

#: The grid of bars, in hundredths from the lowest on, of floors of the margin, in hundredths, and of least numbers.
BARS, FLOORS, LEAST = range(20, 52, 2), range(0, 25, 5), range(1, 4)
#: The precision asked of a bar, low as labels of the vectors given are near to chance, and how many neighbours vote.
TARGET, VOTERS = 0.25, 10
#: Quoted titles in texts, and the kinds of text that tell of an artist's own works.
QUOTED, OWN_KINDS = r'"([^"\n]{2,60})"', ("release_note", "credits")
#: Texts of each kind an artist should have: heads with the version required.
HEADS = (("bio", 2), ("credits", 1), ("review", 2))


def rounded(x, places: int):
    """Half-even, of what is left after noise in the far digits is gone."""
    return F.bround(F.round(x * 10**places, 4)) / 10**places


def axis_means(spark, sf_dir: str) -> DataFrame:
    """The means of several axes of a supplier's lines; without any value on the first axis there is no row."""
    axes = ["l_quantity", "l_discount", "l_tax"]
    means = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(*(F.avg(c).alias(c) for c in axes))
    return means.where(F.col(axes[0]).isNotNull()).select("l_suppkey", *(rounded(F.col(c), 4).alias(c) for c in axes))


def corroborated_titles(spark, sf_dir: str) -> DataFrame:
    """Per artist the distinct titles that texts on its own works quote and that other texts quote, those in both, and their
    share of the smaller side; artists with titles on one side only are left out."""
    docs = table(spark, sf_dir, "documents").where("artist_id is not null and text is not null")
    quoted = docs.select("artist_id", F.coalesce(F.col("kind").isin(*OWN_KINDS), F.lit(False)).alias("own"), F.explode(F.regexp_extract_all("text", F.lit(QUOTED), F.lit(1))).alias("title"))
    side = lambda own, n: title_sets(quoted.where(F.col("own") == own), "artist_id", "title").withColumn("side", F.lit(n))
    both = side(True, 1).unionByName(side(False, 2)).groupBy("artist_id", "plain").agg(F.sum("side").alias("sides"))
    n = both.groupBy("artist_id").agg(F.count_if(F.col("sides") != 2).alias("own"), F.count_if(F.col("sides") != 1).alias("told"), F.count_if(F.col("sides") == 3).alias("common"))
    return n.where("own > 0 and told > 0").withColumn("share", F.round(F.col("common") / F.least("own", "told"), 4))


def scorecards(spark, sf_dir: str) -> DataFrame:
    """(vec_id, label, median, n, margin, correct) of each vector asked and each label among its nearest: similarities in
    millionths; the margin is how far its best lies above the best of any other label there."""
    labels = table(spark, sf_dir, "embeddings").where("vec_id is not null").groupBy("vec_id").agg(F.min("label").alias("label"))
    near = knn_table(spark, sf_dir, VOTERS).join(labels.withColumnsRenamed({"vec_id": "near_id"}), "near_id").where("label is not null")
    cards = near.groupBy("vec_id", "label").agg(F.round(F.median("sim") * 1e6).cast("long").alias("median"), F.count("*").alias("n"), F.round(F.max("sim") * 1e6).cast("long").alias("best"))
    of = Window.partitionBy("vec_id").orderBy(F.desc("best"), "label")
    top, second = F.first("best").over(of), F.coalesce(F.lead("best").over(of), F.lit(0))
    margin = F.when(F.row_number().over(of) == 1, F.col("best") - second).otherwise(F.col("best") - top)
    told = labels.select("vec_id", F.col("label").alias("correct"))
    return cards.withColumn("margin", margin).join(told, "vec_id").select("vec_id", "label", "median", "n", "margin", "correct")


def calibrate(cards: DataFrame, bars: Sequence[int], floors: Sequence[int], least: Sequence[int], target: float) -> DataFrame:
    """(bar, floor, least, binds, correct, precision, recall, best) of every cell of the grid, from rows as of ``scorecards``.

    A cell binds a vector if exactly one of its labels passes all three; ``best`` marks the cell of greatest recall, then of
    most bindings, then the first, among those of at least the ``target`` precision. A card is only copied to the cells
    it passes, and cells are counted before anything is gathered.
    """
    of = lambda values, test: F.filter(F.array(*map(F.lit, values)), test)
    passed = cards.select("vec_id", (F.col("label") == F.col("correct")).alias("right"), of(bars, lambda b: b * 10_000 <= F.col("median")).alias("b"), of(floors, lambda f: f * 10_000 <= F.col("margin")).alias("f"), of(least, lambda m: m <= F.col("n")).alias("m"))
    cells = passed.select("vec_id", "right", F.explode("b").alias("bar"), "f", "m").select("vec_id", "right", "bar", F.explode("f").alias("floor"), "m").select("vec_id", "right", "bar", "floor", F.explode("m").alias("least"))
    bound = cells.groupBy("vec_id", "bar", "floor", "least").agg(F.count("*").alias("n"), F.max("right").alias("right")).where("n = 1")
    counts = bound.groupBy("bar", "floor", "least").agg(F.count("*").alias("binds"), F.count_if("right").alias("correct"))
    spark = cards.sparkSession
    grid = spark.createDataFrame([(b, f, m) for b in bars for f in floors for m in least], "bar int, floor int, least int")
    asked = cards.where("correct is not null").agg(F.count_distinct("vec_id").alias("asked"))
    full = grid.join(counts, ["bar", "floor", "least"], "left").na.fill(0, ["binds", "correct"]).crossJoin(F.broadcast(asked))  # one row
    told = full.select("bar", "floor", "least", "binds", "correct", F.round(F.try_divide("correct", "binds"), 6).alias("precision"), F.round(F.coalesce(F.try_divide("correct", "asked"), F.lit(0.0)), 4).alias("recall"))
    rank = F.struct("recall", "binds", *((-F.col(c)).alias(c) for c in ("bar", "floor", "least")))
    good = told.where(F.col("precision") >= target).agg(F.max(rank).alias("w")).select(*((-F.col(f"w.{c}")).alias(f"w{c}") for c in ("bar", "floor", "least")))
    best = (F.col("bar") == F.col("wbar")) & (F.col("floor") == F.col("wfloor")) & (F.col("least") == F.col("wleast"))
    return told.crossJoin(F.broadcast(good)).select(*told.columns, F.coalesce(best, F.lit(False)).alias("best"))  # one row


def bar_grid(spark, sf_dir: str) -> DataFrame:
    return calibrate(settle(scorecards(spark, sf_dir)), BARS, FLOORS, LEAST, TARGET)


def logistic_probe(spark, sf_dir: str) -> DataFrame:
    """How well a logistic model tells the least label's vectors from the others: rows fitted on, rows held out (a quarter, by
    the hash of the id) and the chance that one of the label is rated above another, equal ratings as half."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = table(spark, sf_dir, "embeddings").where("vec_id is not null and embedding is not null and label is not null").dropDuplicates(["vec_id"])
    one = rows.agg(F.min("label").alias("one"))
    told = settle(rows.crossJoin(F.broadcast(one)).select("vec_id", (F.col("label") == F.col("one")).cast("double").alias("y"), array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("x"), (F.pmod(F.xxhash64("vec_id"), F.lit(4)) == 0).alias("held")))  # one row
    model = Pipeline(stages=[StandardScaler(inputCol="x", outputCol="z", withMean=True), LogisticRegression(featuresCol="z", labelCol="y", maxIter=300, regParam=1e-4)]).fit(told.where("not held"))
    rated = model.transform(told.where("held")).groupBy(F.round(vector_to_array("probability")[1], 4).alias("at")).agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    below = F.coalesce(F.sum("neg").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))  # a row a rating of four places
    won = rated.withColumn("won", F.col("pos") * (below + F.col("neg") / 2)).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    fitted = told.agg(F.count_if(~F.col("held")).alias("fitted"), F.count_if("held").alias("held"))
    return fitted.crossJoin(won).select("fitted", "held", F.round(F.try_divide("won", F.col("pos") * F.col("neg")), 4).alias("auc"))  # one row each


def tag_rank_covered(spark, sf_dir: str) -> DataFrame:
    """(artist_id, tag, weight, via): the tags ranked by either model, the greater weight, and the ranking over both models
    together for the artists that have none there."""
    ranked = _tags.tag_rank_zidf(spark, sf_dir).groupBy("artist_id", "tag").agg(F.max("weight").alias("weight"))
    rest = _tags.tag_fallback_rank(spark, sf_dir).join(ranked.select("artist_id").distinct(), "artist_id", "left_anti")
    return ranked.withColumn("via", F.lit("ranked")).unionByName(rest.select("artist_id", "tag", _tags.weight(F.col("mz")).alias("weight"), F.lit("fallback").alias("via")))


def tier_chain(spark, sf_dir: str) -> DataFrame:
    """(artist_id, tag, weight, tier): tags people gave to an artist's candidates, folded onto their names, then kept if approved
    or by the approved genres in them, weights of candidates added, the ten best; for artists without any, the ranked
    tags. Magnet tags are taken out of either at the end."""
    folded, approved = _tags.alias_fold(spark, sf_dir), _tags.approved_tags(spark, sf_dir)
    whole = folded.join(approved, "tag", "left_semi").select("id", "tag", "weight")
    inside = _tags.genre_token_recovery(spark, sf_dir).select("tag", F.explode(F.split("genres", r"\|")).alias("genre"))
    parts = folded.join(inside, "tag").select("id", F.col("genre").alias("tag"), "weight")
    gated = whole.unionByName(parts).groupBy("id", "tag").agg(F.max("weight").alias("weight"))
    owner = candidates(spark, sf_dir).where("artist_id is not null").select("id", "artist_id")
    sums = gated.join(owner, "id").groupBy("artist_id", "tag").agg(F.sum("weight").alias("weight"))
    place = F.row_number().over(Window.partitionBy("artist_id").orderBy(F.desc("weight"), "tag"))
    human = sums.withColumn("place", place).where(F.col("place") <= _tags.TAG_K).select("artist_id", "tag", "weight", F.lit("people").alias("tier"))
    scored = tag_rank_covered(spark, sf_dir).join(human.select("artist_id").distinct(), "artist_id", "left_anti").select("artist_id", "tag", F.col("weight").cast("long").alias("weight"), F.lit("scored").alias("tier"))
    blocked = _tags.magnets(spark, sf_dir).select("tag").distinct()
    return human.unionByName(scored).join(blocked, "tag", "left_anti").select("artist_id", "tag", "weight", "tier")


def pending_runs(units: DataFrame, heads: DataFrame, runs: DataFrame, unit: str) -> DataFrame:
    """(unit, head, version): heads, few rows of (head, version), that a unit has no run of in that version or a later one."""
    ran = runs.groupBy(unit, "head").agg(F.max("version").alias("ran"))
    wanted = units.where(F.col(unit).isNotNull()).select(unit).distinct().crossJoin(F.broadcast(heads))  # a row a head
    return wanted.join(ran, [unit, "head"], "left").where("coalesce(ran, 0) < version").select(unit, "head", "version")


def record_runs(ledger: DataFrame, results: DataFrame, unit: str) -> DataFrame:
    """The ledger, (unit, head, version, computed_at), with ``results``, which also have ``declined``: what declined isn't written,
    and of a unit and head the run of the latest version, then time, holds."""
    done = results.where("declined is null or not declined").select(*ledger.columns)
    return ledger.unionByName(done).groupBy(unit, "head").agg(F.max(F.struct("version", "computed_at")).alias("r")).select(unit, "head", "r.version", "r.computed_at")


def pending_heads(spark, sf_dir: str) -> DataFrame:
    """Artists with fewer texts of a kind than they should have: each distinct text of it counts as a version run."""
    docs = table(spark, sf_dir, "documents").where("artist_id is not null and kind is not null")
    runs = docs.groupBy("artist_id", F.col("kind").alias("head")).agg(F.count_distinct("doc_id").alias("version"))
    return pending_runs(artists(spark, sf_dir).select(F.col("id").alias("artist_id")), spark.createDataFrame(list(HEADS), "head string, version int"), runs, "artist_id")


def first_filled_pages(spark, sf_dir: str) -> DataFrame:
    """An artist's two earliest pages on one platform, or on any other where it has none there."""
    p = pages(spark, sf_dir).where("artist_id is not null").select("artist_id", "id", "platform", "first_seen_at")
    both = first_filled(p.where("platform = 'deezer'"), p.where("platform <> 'deezer'"), "artist_id", [F.asc_nulls_first("first_seen_at"), "id"], 2)
    return both.select("artist_id", "id", "platform", "place")


def resolved_candidates(spark, sf_dir: str) -> DataFrame:
    """Names of candidates with the artist of the same normal name that has the most pages, of equals the least id."""
    seen = pages(spark, sf_dir).where("artist_id is not null").groupBy(F.col("artist_id").alias("platform_id")).agg(F.count("*").alias("popularity"))
    hits = artists(spark, sf_dir).select(F.col("display_name").alias("name"), F.col("id").alias("platform_id")).join(seen, "platform_id", "left")
    return resolve_names(candidates(spark, sf_dir).select(F.col("band_name").alias("name")), hits).select("name", F.col("platform_id").alias("artist_id"))


def texts_to_fetch(spark, sf_dir: str) -> DataFrame:
    """Addresses whose last fetch brought no text."""
    docs = table(spark, sf_dir, "documents").select(F.col("url").alias("key"), F.when(F.coalesce("text", F.lit("")) != "", 200).otherwise(500).alias("status"), F.col("text").alias("body"), "fetched_at")
    return to_fetch(docs, docs).select(F.col("key").alias("url"))


_P = "p as (select distinct on (id) * from platform_identity where id is not null)"
_A = "a as (select distinct on (id) * from artist where id is not null)"
_NAME = "regexp_replace(" + _ASCII + ", '[^a-z0-9]+', '', 'g')"
_Z, _F = _tags.SQL["tag_rank_zidf"], _tags.SQL["tag_fallback_rank"]
_COVERED = f"""z as (select artist_id, tag, max(weight) as weight from ({_Z}) group by 1, 2), cov as (select artist_id, tag, weight, 'ranked' as via from z
  union all select artist_id, tag, greatest(1, round_even(mz, 0)::int + 1), 'fallback' from ({_F}) where artist_id not in (select artist_id from z))"""
QUERIES = {
    f.__name__: f
    for f in (axis_means, corroborated_titles, bar_grid, logistic_probe, tag_rank_covered, tier_chain, pending_heads, first_filled_pages, resolved_candidates, texts_to_fetch)
}
SQL = {
    "axis_means": "select l_suppkey, " + ", ".join(f"round_even(round(avg({c}) * 10000, 4), 0) / 10000 as {c}" for c in ("l_quantity", "l_discount", "l_tax")) + " from lineitem group by 1 having avg(l_quantity) is not null",
    "corroborated_titles": r"""with q as (select artist_id, coalesce(kind in ('release_note', 'credits'), false) as own, unnest(regexp_extract_all(text, '"([^"\n]{2,60})"', 1)) as title from documents where artist_id is not null and text is not null),
      f as (select *, strip_accents(regexp_replace(title, '[^\x00-\x7F\p{L}\p{N}\p{M}]', ' ', 'g')) as s from q), g as (select *, regexp_replace(regexp_replace(regexp_replace(s, '[^\x00-\x7F]', '', 'g'), '(?i)\((feat|ft|with|prod)[^)]*\)', '', 'g'), '(?i)\b(feat|ft)\.?\s.+$', '') as t from f),
      h as (select distinct artist_id, own, trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) as plain from g), k as (select * from h where len(plain) >= 4 and plain not in ('intro', 'outro', 'untitled', 'interlude', 'skit', 'bonus', 'bonus track', 'demo', 'live')),
      b as (select artist_id, plain, bool_or(own) as o, bool_or(not own) as d from k group by all), n as (select artist_id, count(*) filter (where o) as own, count(*) filter (where d) as told, count(*) filter (where o and d) as common from b group by 1)
      select *, round(common / least(own, told), 4) as share from n where own > 0 and told > 0""",
    "bar_grid": f"""with {_NEAR}, c as (select vec_id, near_label as label, round(median(sim) * 1e6)::bigint as med, count(*) as n, round(max(sim) * 1e6)::bigint as best from k where place <= 10 and near_label is not null group by all),
      m as (select c.*, best - coalesce((select max(best) from c o where o.vec_id = c.vec_id and o.label <> c.label), 0) as margin, e.label as correct from c join e using (vec_id)),
      g as (select (18 + 2 * x)::int as bar, (5 * y - 5)::int as floor, w::int as least from range(1, 17) a(x), range(1, 6) b(y), range(1, 4) d(w)),
      l as (select bar, floor, least, vec_id, count(*) as n, bool_or(label = correct) as good from g join m on bar * 10000 <= med and floor * 10000 <= margin and least <= n group by all having count(*) = 1),
      t as (select bar, floor, least, count(vec_id) as binds, count(*) filter (where good) as correct from g left join l using (bar, floor, least) group by all),
      u as (select *, round(correct / nullif(binds, 0), 6) as precision, round(correct / (select count(distinct vec_id) from m where correct is not null), 4) as recall from t),
      w as (select * from u where precision >= 0.25 order by recall desc, binds desc, bar, floor, least limit 1)
      select u.*, (bar, floor, least) in (select (bar, floor, least) from w) as best from u""",
    "tag_rank_covered": f"with {_COVERED} select * from cov",
    "tier_chain": f"""with {_COVERED}, {_tags._CAND}, {_tags._APPROVED}, fold as ({_tags.SQL['alias_fold']}), rec as (select tag, unnest(string_split(genres, '|')) as genre from ({_tags.SQL['genre_token_recovery']})),
      gate as (select id, tag, max(weight) as weight from (select id, tag, weight from fold where tag in (select tag from approved) union all select id, genre, weight from fold join rec using (tag)) group by all),
      s as (select artist_id, tag, sum(weight)::bigint as weight from gate join cand using (id) where artist_id is not null group by all), h as (select * from (select *, row_number() over (partition by artist_id order by weight desc, tag) as place from s) where place <= 10),
      u as (select artist_id, tag, weight, 'people' as tier from h union all select artist_id, tag, weight, 'scored' from cov where artist_id not in (select artist_id from h))
      select * from u where tag not in (select tag from ({_tags.SQL['magnet_blocklist']}))""",
    "pending_heads": f"""with {_A}, h as (select * from (values {", ".join(map(str, HEADS))}) as t(head, version)), r as (select artist_id, kind as head, count(distinct doc_id) as ran from documents group by all)
      select a.id as artist_id, h.head, h.version from a cross join h left join r on r.artist_id = a.id and r.head = h.head where coalesce(ran, 0) < version""",
    "first_filled_pages": f"""with {_P}, q as (select *, platform = 'deezer' as d, bool_or(platform = 'deezer') over (partition by artist_id) as has from p where artist_id is not null and platform is not null),
      k as (select *, row_number() over (partition by artist_id order by first_seen_at nulls first, id) as place from q where d = has) select artist_id, id, platform, place::int as place from k where place <= 2""",
    "resolved_candidates": f"""with {_A}, {_P}, n as (select distinct band_name as name from (select id, max(band_name) as band_name from bc_candidate where id is not null group by 1)),
      c as (select artist_id as id, count(*) as pop from p group by 1), h as (select {_NAME.format('display_name')} as key, a.id, coalesce(pop, 0) as pop from a left join c using (id)),
      b as (select *, row_number() over (partition by key order by pop desc, id) as rn from h where key <> '') select name, b.id as artist_id from n join b on {_NAME.format('name')} = key where rn = 1""",
    "texts_to_fetch": """select url from (select url, row_number() over (partition by url order by fetched_at desc nulls last, coalesce(text, '') = '' desc) as rn, text from documents where url is not null) where rn = 1 and coalesce(text, '') = ''""",
}
