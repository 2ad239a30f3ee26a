"""Vectors as arrays: norms, centroids, coherence, separation and votes of neighbours."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import signals
from ..session import settle, table
from .ranks import placed

#: About how many vectors a block of an exact search holds, and how many queries are compared with a block at once.
BLOCK_ROWS, STEP_ROWS = 32_768, 512
#: The sum of similarities from which on anchors decide a label.
LEAST_VOTE = 0.8


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def sound_vectors(spark, sf_dir: str) -> DataFrame:
    """(artist_id, model, v): the latest vector of each that has its length and only finite values."""
    held = table(spark, sf_dir, "artist_embedding").groupBy("artist_id", "model").agg(F.max(F.struct("computed_at", "dim", "embedding")).alias("h"))
    rows = held.select("artist_id", "model", F.col("h.dim").alias("dim"), F.col("h.embedding").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where("size(v) = dim").where(~odd).where(norm(F.col("v")) > 0)


def vector_norm_audit(spark, sf_dir: str) -> DataFrame:
    """Vectors per model, and how many aren't of unit length."""
    n = norm(F.col("v"))
    return sound_vectors(spark, sf_dir).groupBy("model").agg(F.count("*").alias("vectors"), F.count_if((n < 0.99) | (n > 1.01)).alias("off_norm"))


def mean_vector(rows: DataFrame, keys: list[str], v: str = "v") -> DataFrame:
    """(keys, pos, mean, n): the mean of each coordinate of the vectors of a group."""
    cells = rows.select(*keys, F.posexplode(v).alias("pos", "x"))
    return cells.groupBy(*keys, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"), F.count("*").alias("n"))


def source_centroids(spark, sf_dir: str) -> DataFrame:
    """(source, model, pos, mean): the centroid of each embedding source's artists, of unit length."""
    source = table(spark, sf_dir, "artist").where("embedding_source is not null").select(F.col("id").alias("artist_id"), F.col("embedding_source").alias("source")).distinct()
    cells = mean_vector(sound_vectors(spark, sf_dir).join(source, "artist_id"), ["source", "model"])
    length = cells.groupBy("source", "model").agg(F.sqrt(F.sum(F.col("mean") * F.col("mean"))).alias("length"))
    return cells.join(length, ["source", "model"]).select("source", "model", "pos", F.round(F.col("mean") / F.col("length"), 5).alias("value"), "n")


def source_coherence(spark, sf_dir: str) -> DataFrame:
    """The cosine of each two sources' centroids of a model."""
    source = table(spark, sf_dir, "artist").where("embedding_source is not null").select(F.col("id").alias("artist_id"), F.col("embedding_source").alias("source")).distinct()
    cells = mean_vector(sound_vectors(spark, sf_dir).join(source, "artist_id"), ["source", "model"])
    a, b = cells.select(F.col("source").alias("source_a"), "model", "pos", F.col("mean").alias("x")), cells.select(F.col("source").alias("source_b"), "model", "pos", F.col("mean").alias("y"))
    sums = a.join(b, ["model", "pos"]).where("source_a < source_b").groupBy("model", "source_a", "source_b").agg(F.sum(F.col("x") * F.col("y")).alias("xy"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("y") * F.col("y")).alias("yy"))
    return sums.select("model", "source_a", "source_b", F.round(F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")), 4).alias("cosine"))


def label_separation(spark, sf_dir: str) -> DataFrame:
    """Mean cosine within and between labels, over unit vectors: from the labels' sums, without any pair of rows."""
    rows = table(spark, sf_dir, "embeddings").where("embedding is not null and label is not null").select("label", "embedding").withColumn("len", norm(F.col("embedding"))).where("len > 0")
    cells = rows.select("label", F.posexplode(F.transform("embedding", lambda x: x / F.col("len"))).alias("pos", "x"))
    sums = cells.groupBy("label", "pos").agg(F.sum("x").alias("s"))
    own = sums.groupBy("label").agg(F.sum(F.col("s") * F.col("s")).alias("ss")).join(rows.groupBy("label").agg(F.count("*").alias("n")), "label")
    within = own.agg(F.sum(F.col("ss") - F.col("n")).alias("w"), F.sum(F.col("n") * (F.col("n") - 1)).alias("wn"), F.sum("ss").alias("ss"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"))
    total = sums.groupBy("pos").agg(F.sum("s").alias("s")).agg(F.sum(F.col("s") * F.col("s")).alias("tt"))
    one = within.crossJoin(F.broadcast(total))  # one row each
    intra, inter = F.col("w") / F.col("wn"), (F.col("tt") - F.col("ss")) / (F.col("n") * F.col("n") - F.col("nn"))
    return one.select(F.round(intra, 5).alias("intra"), F.round(inter, 5).alias("inter"), F.round(intra - inter, 5).alias("separation"))


def _best_of_tile(k: int):
    """The k most similar rows of one tile for each of its queries, ties by id, a row itself left out."""

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows and rows.num_rows:
            own, ids = asked.column("vec_id").to_numpy(), rows.column("near_id").to_numpy()
            q, m = (np.stack(t.column("v").to_numpy()) for t in (asked, rows))
            for at in range(0, len(q), STEP_ROWS):
                sims = np.round(q[at : at + STEP_ROWS] @ m.T, 6)
                sims[own[at : at + STEP_ROWS, None] == ids[None, :]] = -2
                least = np.partition(sims, -min(k, sims.shape[1]), axis=1)[:, -min(k, sims.shape[1])]
                i, j = np.nonzero(sims >= np.maximum(least, -1.5)[:, None])  # with all that equal the last one
                order = np.lexsort((ids[j], -sims[i, j], i))
                i, j = i[order], j[order]
                first = np.searchsorted(i, np.arange(len(sims)))
                kept = np.arange(len(i)) - first[i] < k
                out.append((own[at + i[kept]], ids[j[kept]], sims[i[kept], j[kept]]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], names=["vec_id", "near_id", "sim"])

    return run


def block_search(asked: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(vec_id, near_id, sim, place): the k rows with the greatest product with each of the queries, exactly.

    Both sides hold (vec_id, v). They are cut into blocks of about ``BLOCK_ROWS`` rows by
    the hash of the id; each pair of blocks is one tile of bounded size in one task, and
    the k best of each tile are merged. Nothing is broadcast or collected. Vectors must
    have one length; an empty side gives no rows. Both sides are counted first, so they
    had better be settled.
    """
    counts = [max(1, -(-side.count() // BLOCK_ROWS)) for side in (asked, rows)]
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("vec_id", "v", block(counts[0]).alias("a"), all_of(counts[1]).alias("b"))
    right = rows.select(F.col("vec_id").alias("near_id"), "v", block(counts[1]).alias("b"), all_of(counts[0]).alias("a"))
    tiles = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(_best_of_tile(k), "vec_id bigint, near_id bigint, sim double")
    place = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("sim"), "near_id"))
    return tiles.withColumn("place", place).where(F.col("place") <= k)


def knn_table(spark, sf_dir: str, k: int) -> DataFrame:
    """Neighbours by cosine of every vector of the ``embeddings`` whose id is divisible by 20, among all of them."""
    rows = table(spark, sf_dir, "embeddings").where("embedding is not null").select("vec_id", "embedding").dropDuplicates(["vec_id"])
    unit = rows.withColumn("len", norm(F.col("embedding"))).where("len > 0").select("vec_id", F.transform("embedding", lambda x: x / F.col("len")).alias("v"))
    unit = settle(unit)
    return block_search(unit.where("vec_id % 20 = 0"), unit, k)


def knn_topk(spark, sf_dir: str) -> DataFrame:
    return knn_table(spark, sf_dir, 5)


def precision_at_1(spark, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "embeddings").select("vec_id", "label").dropDuplicates(["vec_id"])
    near = knn_table(spark, sf_dir, 1).join(labels, "vec_id").join(labels.select(F.col("vec_id").alias("near_id"), F.col("label").alias("near_label")), "near_id")
    return near.agg(F.count("*").alias("n"), F.round(F.avg((F.col("label") == F.col("near_label")).cast("double")), 6).alias("precision"))


def knn_label_votes(spark, sf_dir: str) -> DataFrame:
    """Each vector's label by its neighbours' votes, weighted by similarity."""
    labels = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("near_id"), "label").dropDuplicates(["near_id"])
    votes = knn_table(spark, sf_dir, 25).join(labels, "near_id").groupBy("vec_id", "label").agg(F.sum(F.greatest("sim", F.lit(0.0))).alias("vote"))
    of = Window.partitionBy("vec_id")
    ranked = votes.withColumn("total", F.sum("vote").over(of)).withColumn("rn", F.row_number().over(of.orderBy(F.desc(F.round("vote", 6)), "label")))
    return ranked.where("rn = 1 and total > 0").select("vec_id", "label", F.round(F.col("vote") / F.col("total"), 4).alias("share"))


def mean_alignment(spark, sf_dir: str) -> DataFrame:
    """(artist_id, model, d): the cosine of each artist's vector with its model's mean direction."""
    rows = sound_vectors(spark, sf_dir)
    means = mean_vector(rows, ["model"]).groupBy("model").agg(F.sort_array(F.collect_list(F.struct("pos", "mean"))).alias("m"))  # as long as a vector
    joined = rows.join(F.broadcast(means.select("model", F.col("m.mean").alias("m"))), "model")  # a row a model
    d = F.round(dot(F.col("v"), F.col("m")) / (norm(F.col("v")) * norm(F.col("m"))), 4)
    return joined.select("artist_id", "model", F.when(d == 0, 0.0).otherwise(d).alias("d"))  # no negative zero


def label_scorecards(spark, sf_dir: str) -> DataFrame:
    """Per label the median, least, greatest and number of its vectors' cosines with its centroid, and the median's
    margin over the nearest other label's centroid. Cosines count to four places, so a label's states are few."""
    rows = table(spark, sf_dir, "embeddings").where("embedding is not null and label is not null").select("vec_id", "label", "embedding").dropDuplicates(["vec_id"])
    cells = mean_vector(rows, ["label"], "embedding")
    centre = cells.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "mean"))).alias("m")).select("label", F.col("m.mean").alias("m"))
    sim = F.round(dot(F.col("embedding"), F.col("m")) / (norm(F.col("embedding")) * norm(F.col("m"))), 4)
    cards = rows.join(centre, "label").where(norm(F.col("embedding")) > 0).select("label", sim.alias("sim")).groupBy("label").agg(
        F.median("sim").alias("mid"), F.min("sim").alias("low"), F.max("sim").alias("high"), F.count("*").alias("n")
    )
    length = cells.groupBy("label").agg(F.sqrt(F.sum(F.col("mean") * F.col("mean"))).alias("len"))
    unit = cells.join(length, "label").select("label", "pos", (F.col("mean") / F.col("len")).alias("x"))
    other = unit.withColumnRenamed("label", "other").withColumnRenamed("x", "y")
    near = unit.join(other, "pos").where("label <> other").groupBy("label", "other").agg(F.sum(F.col("x") * F.col("y")).alias("c")).groupBy("label").agg(F.max("c").alias("near"))
    return cards.join(near, "label", "left").select("label", F.round("mid", 5).alias("median"), "low", "high", "n", F.round(F.col("mid") - F.col("near"), 4).alias("margin"))


def clip_soundness(spark, sf_dir: str) -> DataFrame:
    """The arrays of the clips read as signals: per model and verdict, how many there are."""
    clips = table(spark, sf_dir, "clip_embedding").select("id", "model", "embedding").where("embedding is not null and not exists(embedding, x -> x is null or isnan(x))").dropDuplicates(["id"])
    return clips.groupBy("model", signals.soundness(F.col("embedding"), 20, 0.02, 0.0).alias("verdict")).agg(F.count("*").alias("n"))


def equal_clips(spark, sf_dir: str) -> DataFrame:
    """Clips of equal vectors, one row a clip with its class, the least id of the class, and the tracks it is under."""
    clips = table(spark, sf_dir, "clip_embedding").where("embedding is not null").select("id", "track_id", "model", "embedding").dropDuplicates(["id"])
    keyed = clips.select("id", "track_id", F.sha2(F.concat_ws(":", "model", F.col("embedding").cast("string")), 256).alias("k"))
    classes = keyed.groupBy("k").agg(F.min("id").alias("class_id"), F.count("*").alias("members"), F.count_distinct("track_id").alias("tracks")).where("members > 1")
    return keyed.join(classes, "k").select("id", "class_id", "members", "tracks")


def sign_neighbours(spark, sf_dir: str) -> DataFrame:
    """Of every vector with an id divisible by 20 the three with most coordinates of the same sign, and their share."""
    rows = table(spark, sf_dir, "embeddings").where("embedding is not null and size(embedding) > 0").select("vec_id", "embedding").dropDuplicates(["vec_id"])
    bits = rows.select("vec_id", F.transform("embedding", lambda x: F.when(x > 0, 1.0).otherwise(-1.0) / F.sqrt(F.size("embedding"))).alias("v"))
    bits = settle(bits)
    near = block_search(bits.where("vec_id % 20 = 0"), bits, 3)
    return near.select("vec_id", "near_id", F.round((F.col("sim") + 1) / 2, 4).alias("likeness"), "place")


def clip_keys(spark, sf_dir: str) -> DataFrame:
    """The first twelve values of each clip's vector read as chroma means: its key and mode. Vectors with a null or NaN there are left out."""
    clips = table(spark, sf_dir, "clip_embedding").where("id is not null and size(embedding) >= 12").groupBy("id").agg(F.max("embedding").alias("v"))
    first = clips.select("id", F.slice("v", 1, 12).alias("c")).where("not exists(c, x -> x is null or isnan(x) or abs(x) > 1e30) and array_max(c) > array_min(c)")
    return first.select("id", signals.key_of(F.transform("c", lambda x: x.cast("double"))).alias("k")).select("id", "k.key", "k.mode")


def sign_words(v: Column) -> Column:
    """The signs of a vector as words of 32 bits; what is left over at the end is dropped."""
    word = lambda i: F.aggregate(F.slice(v, i * 32 + 1, F.lit(32)), F.lit(0).cast("bigint"), lambda s, x: s * 2 + F.when(x > 0, 1).otherwise(0))
    n = F.floor(F.size(v) / 32).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), word))


def clip_likeness(spark, sf_dir: str) -> DataFrame:
    """Of each clip and the next of its track and model, by start and id, the share of equal bits of the signs: near-duplicate
    neighbours within a recording, one row a clip, without all pairs of a track."""
    clips = table(spark, sf_dir, "clip_embedding").where("id is not null and track_id is not null and size(embedding) = dim and dim >= 32").groupBy("id").agg(F.max(F.struct("track_id", "model", "segment_start_s", "embedding")).alias("c")).select("id", "c.*")
    words = clips.select("id", "track_id", "model", "segment_start_s", sign_words(F.col("embedding")).alias("w"))
    at = settle(placed(words, ["track_id", "model"], ["segment_start_s", "id"], "n"))  # of any number of clips
    after = at.select("track_id", "model", (F.col("n") - 1).alias("n"), F.col("id").alias("next_id"), F.col("w").alias("next_w"))
    pairs = at.join(after, ["track_id", "model", "n"])
    return pairs.select("id", "next_id", F.round(signals.likeness(F.col("w"), F.col("next_w"), least=1), 6).alias("alike"))


def anchored_labels(spark, sf_dir: str) -> DataFrame:
    """Each asked vector's label by the votes of its ten nearest anchors, the vectors whose label is even, weighted by similarity;
    without a vote of ``LEAST_VOTE`` the anchors' most frequent label, of equals the least, as a fallback."""
    rows = table(spark, sf_dir, "embeddings").where("embedding is not null and vec_id is not null").select("vec_id", "label", "embedding").dropDuplicates(["vec_id"])
    unit = settle(rows.withColumn("len", norm(F.col("embedding"))).where("len > 0").select("vec_id", "label", F.transform("embedding", lambda x: x / F.col("len")).alias("v")))
    anchors, asked = unit.where("label % 2 = 0"), unit.where("vec_id % 20 = 0")
    near = block_search(asked.select("vec_id", "v"), anchors.select("vec_id", "v"), 10).join(anchors.select(F.col("vec_id").alias("near_id"), "label"), "near_id")
    votes = near.groupBy("vec_id", "label").agg(F.round(F.sum(F.greatest("sim", F.lit(0.0))), 6).alias("vote"))
    best = votes.groupBy("vec_id").agg(F.min(F.struct((-F.col("vote")).alias("m"), "label")).alias("b")).select("vec_id", F.col("b.label").alias("voted"), (-F.col("b.m")).alias("vote"))
    usual = anchors.groupBy("label").agg(F.count("*").alias("n")).agg(F.min(F.struct((-F.col("n")).alias("m"), "label"))["label"].alias("usual"))
    told = asked.select("vec_id").join(best, "vec_id", "left").crossJoin(F.broadcast(usual))  # one row
    sure = F.coalesce(F.col("vote") >= LEAST_VOTE, F.lit(False))
    return told.select("vec_id", F.when(sure, F.col("voted")).otherwise(F.col("usual")).alias("label"), F.when(sure, "anchors").otherwise("usual").alias("via"))


_V = """h as (select *, row_number() over (partition by artist_id, model order by computed_at desc nulls last, dim desc, embedding desc) as rn from artist_embedding),
  sv as (select artist_id, model, embedding as v from h where rn = 1 and len(embedding) = dim and not list_bool_or(list_transform(embedding, lambda x: x is null or isnan(x) or isinf(x)))
    and list_sum(list_transform(embedding, lambda x: x::double * x::double)) > 0)"""
_CELLS = "src as (select distinct id as artist_id, embedding_source as source from artist where embedding_source is not null), cells as (select source, model, pos, avg(x) as mean, count(*) as n from (select source, model, unnest(range(0, len(v))) as pos, unnest(v)::double as x from sv join src using (artist_id)) group by all)"
_NEAR = """e as (select distinct on (vec_id) vec_id, label, list_transform(embedding, lambda x: x::double / sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double)))) as v from embeddings where embedding is not null),
  s as (select a.vec_id, b.vec_id as near_id, b.label as near_label, a.label, round(list_inner_product(a.v, b.v), 6) as sim from e a join e b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
  k as (select *, row_number() over (partition by vec_id order by sim desc, near_id) as place from s)"""
_PROFILES = [(name, mode, np.roll(p, i)) for i, name in enumerate(signals.KEYS) for mode, p in (("major", signals.MAJOR), ("minor", signals.MINOR))]
_TURNED = ", ".join(f"('{name}', '{mode}', {[float(x) for x in (p - p.mean()) / p.std()]})" for name, mode, p in _PROFILES)
QUERIES = {f.__name__: f for f in (vector_norm_audit, source_centroids, source_coherence, label_separation, knn_topk, precision_at_1, knn_label_votes, mean_alignment, label_scorecards, clip_soundness, equal_clips, sign_neighbours, clip_keys, clip_likeness, anchored_labels)}
SQL = {
    "vector_norm_audit": f"with {_V}, n as (select model, sqrt(list_sum(list_transform(v, lambda x: x::double * x::double))) as n from sv) select model, count(*) as vectors, count(*) filter (where n < 0.99 or n > 1.01) as off_norm from n group by 1",
    "source_centroids": f"with {_V}, {_CELLS}, l as (select source, model, sqrt(sum(mean * mean)) as len from cells group by all) select source, model, pos, round(mean / len, 5) as value, n from cells join l using (source, model)",
    "source_coherence": f"with {_V}, {_CELLS} select model, a.source as source_a, b.source as source_b, round(sum(a.mean * b.mean) / sqrt(sum(a.mean * a.mean) * sum(b.mean * b.mean)), 4) as cosine from cells a join cells b using (model, pos) where a.source < b.source group by all",
    "label_separation": """with e as (select vec_id, label, list_transform(embedding, lambda x: x::double / sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double)))) as v from embeddings where embedding is not null and label is not null),
      s as (select a.label = b.label as own, avg(list_inner_product(a.v, b.v)) as m from e a join e b on a.vec_id < b.vec_id group by 1)
      select round(max(m) filter (where own), 5) as intra, round(max(m) filter (where not own), 5) as inter, round(max(m) filter (where own) - max(m) filter (where not own), 5) as separation from s""",
    "knn_topk": f"with {_NEAR} select vec_id, near_id, sim, place::int as place from k where place <= 5",
    "precision_at_1": f"with {_NEAR} select count(*) as n, round(avg((label = near_label)::int), 6) as precision from k where place = 1",
    "knn_label_votes": f"with {_NEAR}, v as (select vec_id, near_label as label, sum(greatest(sim, 0)) as vote from k where place <= 25 group by all), r as (select *, sum(vote) over (partition by vec_id) as total, row_number() over (partition by vec_id order by round(vote, 6) desc, label) as rn from v) select vec_id, label, round(vote / total, 4) as share from r where rn = 1 and total > 0",
    "mean_alignment": f"""with {_V}, c as (select model, pos, avg(x) as mean from (select model, unnest(range(0, len(v))) as pos, unnest(v)::double as x from sv) group by all), m as (select model, list(mean order by pos) as m from c group by 1)
      select artist_id, model, case when d = 0 then 0.0 else d end as d from (select artist_id, model, round(list_cosine_similarity(v::double[], m), 4) as d from sv join m using (model))""",
    "label_scorecards": """with e as (select distinct on (vec_id) vec_id, label, embedding::double[] as v from embeddings where embedding is not null and label is not null),
      c as (select label, pos, avg(x) as mean from (select label, unnest(range(0, len(v))) as pos, unnest(v) as x from e) group by all), m as (select label, list(mean order by pos) as m from c group by 1),
      s as (select label, round(list_cosine_similarity(v, m), 4) as sim from e join m using (label)), k as (select label, median(sim) as mid, min(sim) as low, max(sim) as high, count(*) as n from s group by 1),
      o as (select a.label, max(list_cosine_similarity(a.m, b.m)) as near from m a join m b on a.label <> b.label group by 1)
      select label, round(mid, 5) as median, low, high, n, round(mid - near, 4) as margin from k left join o using (label)""",
    "clip_soundness": """with c as (select distinct on (id) id, model, embedding as v from clip_embedding where embedding is not null and not list_bool_or(list_transform(embedding, lambda x: x is null or isnan(x)))),
      r as (select model, len(v) as n, len(list_filter(v, lambda x: abs(x) < 1e-3::float)) as s, len(list_filter(v, lambda x: abs(x) > 0.99::float)) as k from c)
      select model, case when n < 100 then 'short' when s > 0.02 * n then 'silent' when k > 0 then 'clipped' else 'ok' end as verdict, count(*) as n from r group by all""",
    "equal_clips": """with c as (select distinct on (id) id, track_id, model, embedding as v from clip_embedding where embedding is not null), k as (select model, v, min(id) as class_id, count(*) as members, count(distinct track_id) as tracks from c group by all having count(*) > 1)
      select c.id, class_id, members, tracks from c join k on c.model is not distinct from k.model and c.v = k.v""",
    "sign_neighbours": """with e as (select distinct on (vec_id) vec_id, list_transform(embedding, lambda x: case when x > 0 then 1 else 0 end) as b from embeddings where embedding is not null and len(embedding) > 0),
      s as (select a.vec_id, b.vec_id as near_id, list_sum(list_transform(list_zip(a.b, b.b), lambda p: case when p[1] = p[2] then 1 else 0 end)) / len(a.b)::double as likeness from e a join e b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
      k as (select *, row_number() over (partition by vec_id order by likeness desc, near_id) as place from s) select vec_id, near_id, round(likeness, 4) as likeness, place::int as place from k where place <= 3""",
    "clip_keys": f"""with c as (select id, max(embedding)[1:12]::double[] as c from clip_embedding where id is not null and len(embedding) >= 12 group by 1), d as (select id, list_transform(c, lambda x: x - list_avg(c)) as c from c where not list_bool_or(list_transform(c, lambda x: x is null or isnan(x) or abs(x) > 1e30)) and list_max(c) > list_min(c)),
      k as (select id, key, mode, row_number() over (partition by id order by list_inner_product(c, p) desc) as rn from d cross join (values {_TURNED}) t(key, mode, p)) select id, key, mode from k where rn = 1""",
    "clip_likeness": """with c as (select distinct on (id) id, track_id, model, segment_start_s, embedding as v from clip_embedding where id is not null and track_id is not null and len(embedding) = dim and dim >= 32),
      n as (select id, v, lead(id) over w as next_id, lead(v) over w as next_v from c window w as (partition by track_id, model order by segment_start_s nulls first, id))
      select id, next_id, round(list_sum(list_transform(range(1, len(v) + 1), lambda i: (coalesce(v[i] > 0, false) = coalesce(next_v[i] > 0, false))::int)) / len(v), 6) as alike from n where next_id is not null""",
    "anchored_labels": f"""with {_NEAR.replace("a.vec_id <> b.vec_id", "a.vec_id <> b.vec_id and b.label % 2 = 0")}, v as (select vec_id, near_label as label, round(sum(greatest(sim, 0)), 6) as vote from k where place <= 10 group by all),
      b as (select * from (select *, row_number() over (partition by vec_id order by vote desc, label) as rn from v) where rn = 1), u as (select label from e where label % 2 = 0 group by 1 order by count(*) desc, label limit 1)
      select e.vec_id, case when vote >= 0.8 then b.label else u.label end as label, case when vote >= 0.8 then 'anchors' else 'usual' end as via from e left join b using (vec_id) cross join u where e.vec_id % 20 = 0""",
}
