import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonarium.functions import signals, titles
from sonarium.operators import history, publishing, refresh, ranks, vectors
from sonarium.sources import dumps, generations


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()[0]


def test_places_equal_brute_force_in_hot_and_null_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(None if g == 9 else "hot" if g < 6 else str(g), None if t % 11 == 0 else int(t), i) for i, (g, t) in enumerate(zip(rng.integers(0, 10, 900), rng.integers(0, 40, 900)))]
    df = spark.createDataFrame(rows, "g string, t int, id int").repartition(7)
    got = {r.id: r.place for r in ranks.placed(df, ["g"], ["t", "id"]).collect()}
    want = {}
    for group in {r[0] for r in rows}:
        inside = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want |= {r[2]: n for n, r in enumerate(inside, 1)}
    assert got == want
    assert ranks.placed(df.limit(0), ["g"], ["t", "id"]).count() == 0


def test_pages_of_a_walk(spark):
    df = spark.range(10)
    assert [r.id for r in ranks.page_after(df, "id", None, 3).collect()] == [0, 1, 2]
    assert [r.id for r in ranks.page_after(df, "id", 8, 3).collect()] == [9]


def test_block_search_equals_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(5)
    m = np.round(rng.normal(size=(210, 6)), 1)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[50:60] = m[50]  # ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, v array<double>")
    got = {(r.vec_id, r.place): r.near_id for r in vectors.block_search(df.where("vec_id % 5 = 0"), df, 4).collect()}
    sims = np.round(m @ m.T, 6)
    for q in range(0, 210, 5):
        near = sorted((i for i in range(210) if i != q), key=lambda i: (-sims[q, i], i))[:4]
        assert [got[q, p] for p in range(1, 5)] == near
    assert vectors.block_search(df.limit(0), df, 4).count() == 0
    assert vectors.block_search(df.where("vec_id = 1"), df.where("vec_id = 1"), 4).count() == 0


@pytest.mark.parametrize("raw, want", [("Café – Noir", "cafe noir"), ("Song (feat. X)", "song"), ("Song ft. Someone", "song"), ("A/B", "a b"), ("", ""), (None, None), ("ロック", "")])
def test_plain_title(spark, raw, want):
    assert one(spark, titles.plain_title, raw, "string") == want


def test_titles_compared(spark):
    rows = [("a", "Alpha (feat. X)"), ("a", "BETA ft. Y"), ("a", "Intro"), ("a", "abc"), ("a", None), (None, "alpha"), ("a", "alpha"), ("b", "Beta"), ("b", "Gamma – Delta"), ("c", "gamma delta"), ("c", "Älpha"), ("c", "beta"), ("d", "live")]
    df = spark.createDataFrame(rows, "owner string, title string")
    sets = titles.title_sets(df, "owner", "title")
    assert {tuple(r) for r in sets.collect()} == {("a", "alpha"), ("a", "beta"), ("b", "beta"), ("b", "gamma delta"), ("c", "gamma delta"), ("c", "alpha"), ("c", "beta")}
    other = sets.withColumnRenamed("owner", "mate")
    assert {tuple(r) for r in titles.common_titles(sets, other, "owner", "mate").where("owner < mate").collect()} == {("a", "b", 1, 2), ("a", "c", 2, 2), ("b", "c", 2, 2)}
    assert titles.common_titles(sets.limit(0), other, "owner", "mate").count() == 0
    assert [one(spark, titles.is_numbered, t, "string") for t in ("Mix Vol. 3", "Song 12", "Song")] == [True, True, False]


def test_signals(spark):
    sound = lambda x: one(spark, lambda c: signals.soundness(c, 10), x, "array<double>")
    assert [sound([0.5] * 10), sound([0.0] * 100), sound([1.0] * 100), sound([0.5] * 100), sound(None)] == ["short", "silent", "clipped", "ok", None]
    x = np.full(200, 0.1)
    x[50:80], x[120:150] = 1.0, 0.8
    got = one(spark, lambda c: signals.loud_windows(c, 1, k=2), x.tolist(), "array<double>")
    assert [(w["start"], w["end"]) for w in got] == [(50, 80), (120, 150)]
    assert [(w["start"], w["end"]) for w in one(spark, lambda c: signals.loud_windows(c, 1), [0.1] * 12, "array<double>")] == [(0, 12)]
    assert one(spark, lambda c: signals.loud_windows(c, 1), None, "array<double>") is None
    for i, name in enumerate(signals.KEYS):
        for mode, profile in (("major", signals.MAJOR), ("minor", signals.MINOR)):
            if i in (0, 7):
                assert tuple(one(spark, signals.key_of, np.roll(profile, i).tolist(), "array<double>")) == (name, mode)
    assert tuple(one(spark, signals.key_of, [1.0], "array<double>")) == (None, None)


def test_bits(spark):
    rng = np.random.default_rng(1)
    frames = rng.normal(size=(60, 33))
    words = one(spark, signals.words_of, frames.tolist(), "array<array<double>>")
    bits = (np.diff(np.diff(frames, axis=1), axis=0) > 0).astype(int)
    assert list(words) == [int("".join(map(str, row)), 2) for row in bits]
    pairs = [(list(words), list(words)[5:50]), (list(words)[:45], [w ^ 1 for w in words][:45]), (list(words)[:10], list(words))]
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>").coalesce(1)
    assert [round(r[0], 5) for r in df.select(signals.likeness(F.col("a"), F.col("b"))).collect()] == [1.0, 1 - 1 / 32, 0.0]


def test_platform_ids(spark):
    read = lambda u: [tuple(x) for x in one(spark, publishing.platform_ids, u, "string") or []]
    assert read("https://www.deezer.com/fr/artist/77") == [("deezer", "77")]
    assert read("https://open.qobuz.com/artist/5") == [("qobuz", "5")] and read("https://www.qobuz.com/fr-fr/interpreter/-/9") == [("qobuz", "9")]
    assert read("https://example.org/") == [] == read("https://youtube.com/channel/") == read(None)


def test_flags_and_gates(spark):
    users = lambda *ids: spark.createDataFrame([(i,) for i in ids], "user_id int")
    got = {tuple(r) for r in history.flag_changes(users(1, 1, 2), users(2, 3, 3), ["user_id"]).collect()}
    assert got == {(1, "open"), (2, "keep"), (3, "close")}
    now = spark.createDataFrame([("a", 2), ("b", 3), ("c", 1)], "k string, n int")
    seen = spark.createDataFrame([("a", 2), ("b", 1), ("b", 2)], "k string, n int")
    assert {r.k for r in history.grown_keys(now, seen, "k", "n").collect()} == {"b", "c"}


def test_stream_gate(spark, tmp_path):
    from sonarium.streaming.incremental import gate_grown

    src, out = str(tmp_path / "in"), []
    for rows in ([("a",), ("a",), ("b",), (None,)], [("a",), ("c",)]):
        spark.createDataFrame(rows, "k string").write.mode("append").parquet(src)
        q = gate_grown(spark.readStream.schema("k string").parquet(src), "k").writeStream.outputMode("update").foreachBatch(lambda b, _: out.extend(map(tuple, b.collect())))
        q.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(90)
    assert sorted(out) == [("a", 0, 2), ("a", 2, 3), ("b", 0, 1), ("c", 0, 1)]


def test_pages_and_lists(spark):
    album = """<div class="location">Oslo, Norway</div><a class="tag" href="x">Dark &amp; Slow</a><a class="tag">oslo</a><a class="tag">dark &amp; slow</a>
      <script data-tralbum="{&quot;artist&quot;:&quot;P&quot;,&quot;trackinfo&quot;:[{&quot;track_id&quot;:1,&quot;title&quot;:&quot;T&quot;,&quot;duration&quot;:61.9,&quot;artist&quot;:&quot;Q&quot;,&quot;file&quot;:{&quot;mp3-128&quot;:&quot;u&quot;}},{&quot;id&quot;:2,&quot;duration&quot;:5.0,&quot;artist&quot;:&quot;P&quot;,&quot;file&quot;:{&quot;mp3-128&quot;:&quot;v&quot;}},{&quot;id&quot;:3,&quot;duration&quot;:5.0,&quot;file&quot;:null}]}"></script>"""
    df = spark.createDataFrame([("k", album), ("none", "<p>"), ("null", None)], "k string, html string")
    assert [(r.id, r.title, r.seconds, r.stream, r.track_artist) for r in dumps.album_tracks(df, "html", ["k"]).orderBy("track_index").collect()] == [("1", "T", 61, "u", "Q"), ("2", "", 5, "v", None)]
    assert [list(r[0] or []) for r in df.where("k = 'k'").select(dumps.page_tags(F.col("html"))).collect()] == [["dark & slow"]]
    body = spark.createDataFrame([("k", '{"collection":[{"id":1,"title":"t","duration":61999,"streamable":true,"stream_url":"u"},{"id":2,"streamable":false,"stream_url":"u"},{"id":3,"streamable":true}]}')], "k string, b string")
    assert [(r.id, r.seconds) for r in dumps.streamable_tracks(body, "b", ["k"]).collect()] == [("1", 61)]
    body = spark.createDataFrame([("k", '{"entries":[{"id":"a","duration":120},{"id":"b","duration":481},{"id":"c","duration":480},{"id":"d"}]}')], "k string, b string")
    assert [r.id for r in dumps.entries_of_length(body, "b", ["k"]).collect()] == ["a", "c"]


def test_heads_and_keys(spark):
    heads = [bytearray(b"ID3\x04"), bytearray(b"\xff\xfb\x90"), bytearray(b"RIFFxx"), bytearray(b"OggS"), bytearray(b"fLaC"), bytearray(b"<htm"), bytearray(b""), None]
    df = spark.createDataFrame([(h,) for h in heads], "h binary").coalesce(1)
    assert [r[0] for r in df.select(dumps.sound_kind(F.col("h"))).collect()] == ["mp3", "mp3", "wav", "ogg", "flac", None, None, None]
    keys = spark.createDataFrame([("u", None, None), ("u", "b", "d1")], "u string, b string, d string").coalesce(1)
    first, second = (r[0] for r in keys.select(dumps.cache_key(F.col("u"), F.col("b"), F.col("d"))).collect())
    assert first == "u" and second.startswith("u#post:") and second.endswith(":d1") and len(second) == len("u#post:") + 24 + len(":d1")


def test_events_of_no_one_and_empty_tables(spark, tmp_path):
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    for name, rows in (("empty", []), ("nulls", [(None, None, None, None, None, None), (1, dt.datetime(2024, 1, 1), None, None, 1.0, "no json"), (1, dt.datetime(2024, 1, 1), None, None, 1.0, "no json")])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(folder + "/events.parquet")
        for query in (history.stalls, history.stale_users, history.flag_lifecycle, history.regate_users, history.trailing_counts, history.tumbling_counts):
            assert query(spark, folder).count() <= 2


def test_upsert_by_either_key(spark):
    kept = spark.createDataFrame([("a", "m1", "old", "s"), ("b", None, "b", None), ("c", "m3", "c", "s")], "id string, mbid string, name string, source string")
    new = spark.createDataFrame([("x", "m1", "new", None, 1), ("y", "m1", "newer", "t", 2), ("b", "m2", None, "u", 1), ("z", "m9", "z", None, 1), (None, "m3", "lost", None, 9)], "id string, mbid string, name string, source string, t int")
    got = {tuple(r) for r in refresh.upsert_by_either(kept, new, ["name"], ["source"], "t").select("id", "mbid", "name", "source").collect()}
    assert got == {("a", "m1", "newer", "t"), ("b", "m2", None, "u"), ("c", "m3", "c", "s"), ("z", "m9", "z", None)}


def test_redirects_are_followed_to_their_end(spark):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(21)]
    edges = spark.createDataFrame(chain + [("p", "q"), ("q", "p"), ("r", "p"), ("s", "s"), ("t", "z"), ("t", "u"), (None, "v")], "source string, target string")
    got = {r.source: r.final for r in refresh.resolve_redirects(edges).collect()}
    assert got == {**{f"c{i}": "c21" for i in range(21)}, "p": None, "q": None, "r": None, "t": "u"}
    assert refresh.resolve_redirects(edges.limit(0)).count() == 0


def test_generations(spark, tmp_path):
    kept = generations.Generations(spark, str(tmp_path / "g"))
    with pytest.raises(ValueError):
        kept.current()
    for n in (3, 5):
        kept.load(spark.range(n).toDF("id"), least=2)
    assert kept.current().count() == 5
    with pytest.raises(ValueError):
        kept.load(spark.range(1).toDF("id"), least=2)
    assert generations.Generations(spark, kept.path).current().count() == 5
