import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonarium.functions.text import same_text
from sonarium.operators import entities, history, snapshots, tags
from sonarium.plans import registry
from sonarium.sources import dumps

SNAP = "serial string, id string, display_name string, status string, mbid string, embedding_source string, delivered_at timestamp, extra string"


def at(day):
    return dt.datetime(2026, 1, day)


def changes(spark, rows, runs):
    s = spark.createDataFrame(rows, SNAP)
    r = spark.createDataFrame(runs, "serial string, applied_at timestamp")
    return {(x.serial, x.artist_id, x.change) for x in snapshots.artist_changes(s, r).collect()}


def row(serial, id, name="n", status="active", mbid=None, source=None, day=1):
    return (serial, id, name, status, mbid, source, at(day), "x")


def test_changes_of_each_kind_and_what_is_none(spark):
    rows = [
        row("s1", "a", "Café"), row("s1", "b"), row("s1", "c", "old"), row("s1", "d", mbid=""), row("s1", "g", "x  y"),
        row("s2", "a", "Café"), row("s2", "c", "new"), row("s2", "d", mbid=None), row("s2", "e"), row("s2", "g", " x\ty "),
        row("s2", "f", "first", day=1), row("s2", "f", "second", day=2),
        row("s3", "a", "Café", status="hidden"), row("s3", "c", "new"), row("s3", "d"), row("s3", "e"), row("s3", "f", "second"), row("s3", "g", "x y"), row("s3", None), row(None, "z"),
        row("s2x", "a", "never applied"),
    ]
    runs = [("s1", at(1)), ("s2", at(2)), ("s2", at(2)), ("s2x", None), ("s3", at(3)), (None, at(3))]
    want = {("s2", "b", "removed"), ("s2", "c", "renamed"), ("s2", "e", "added"), ("s2", "f", "added"), ("s3", "a", "changed")}
    assert changes(spark, rows + rows[:3], runs) == want


def test_no_runs_and_no_rows(spark):
    assert changes(spark, [], [("s1", at(1))]) == set()
    assert changes(spark, [row("s1", "a")], []) == set()


def test_changes_equal_brute_force_over_many_chunks(spark):
    old = {f"{i:05d}": f"n{i % 7}" for i in range(0, 3000, 2)}
    new = {k: (v + "!" if int(k) % 100 == 0 else v) for k, v in old.items() if int(k) % 77}
    new |= {f"{i:05d}": "added" for i in range(1, 3000, 500)}
    got = changes(spark, [row("s1", k, v) for k, v in old.items()] + [row("s2", k, v) for k, v in new.items()], [("s1", at(1)), ("s2", at(1))])
    want = {("s2", k, "removed") for k in old.keys() - new.keys()} | {("s2", k, "added") for k in new.keys() - old.keys()}
    assert got == want | {("s2", k, "renamed") for k in old.keys() & new.keys() if old[k] != new[k]}


def test_a_null_that_moves_is_a_change(spark):
    columns = ["name", "status", "mbid", "source"]
    rows, want = [], set()
    for a in columns:
        for b in columns:
            if a != b:  # the same texts in order, a null before or behind
                old, new = {c: None for c in columns}, {c: None for c in columns}
                old[a], new[b] = "X", "X"
                rows += [row("s1", f"{a}-{b}", **old), row("s2", f"{a}-{b}", **new)]
                want.add(("s2", f"{a}-{b}", "renamed" if "name" in (a, b) else "changed"))
    assert changes(spark, rows, [("s1", at(1)), ("s2", at(1))]) == want


def test_same_text(spark):
    df = spark.createDataFrame([("  a \t b ",), ("",), (" ",), (None,), ("Å",)], "t string")
    assert [r[0] for r in df.select(same_text(F.col("t"))).collect()] == ["a b", None, None, None, "Å"]


def test_slugs_and_keys(spark):
    df = spark.createDataFrame([("Püblish Fixture!",), ("",), ("Delić",)], "n string")
    got = df.select(entities.slug_base(F.col("n")), entities.normal_name(F.col("n")), entities.sql_key(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("publish-fixture", "publishfixture", "pblishfixture"), ("artist", "", ""), ("delic", "delic", "deli")]


def slugs(spark, names, stored=None):
    rows = spark.createDataFrame([(f"i{i}", n, at(1 + i)) for i, n in enumerate(names)], "id string, name string, created_at timestamp")
    kept = spark.createDataFrame(stored, "id string, slug string") if stored else None
    return {r.id: r.slug for r in entities.assign_slugs(rows.select("id", entities.slug_base(F.col("name")).alias("base"), "created_at"), kept).collect()}


def test_slugs_are_unique_and_stay(spark):
    assert slugs(spark, ["Foo", "Foo", "Foo 2"]) == {"i0": "foo", "i1": "foo-3", "i2": "foo-2"}
    names = ["Foo", "foo!", "FOO", "Foo 3", "Foo 3", "", "", "Foo 2"]
    got = slugs(spark, names)
    assert len(set(got.values())) == len(names) and {got[f"i{i}"] for i in (0, 1, 2)} == {"foo", "foo-4", "foo-5"} and got["i6"] == "artist-2" and got["i4"] == "foo-3-2"
    stored = [("i2", "foo"), ("gone", "foo-2"), ("i1", "foo-7")]
    again = slugs(spark, names[:3], stored)
    assert again == {"i2": "foo", "gone": "foo-2", "i1": "foo-7", "i0": "foo-3"}  # an older one that comes later takes nothing away


def test_tag_kinds(spark):
    kinds = {"berlin": "location", "austin tx": "location", "or": None, "saxophone": "instrument", "female vocals": "meta", "eighties": "era", "90's hip hop": "era", "creepy": "mood", "big tapes": "label", "1984": "meta", "dub": None, "lo-fi": None}
    df = spark.createDataFrame([(t,) for t in kinds], "tag string")
    assert {r.tag: r.kind for r in df.select("tag", tags.category(F.col("tag")).alias("kind")).collect()} == kinds


def test_aliases_may_give_several_names(spark):
    rows = spark.createDataFrame([(1, "hiphop", 2), (1, "hip hop", 1), (1, "dnb", 1), (2, "rock", 1)], "id int, tag string, weight int")
    aliases = spark.createDataFrame([("hiphop", "hip hop"), ("dnb", "drum and bass"), ("dnb", "jungle"), ("dnb", "jungle")], "alias string, name string")
    assert {tuple(r) for r in tags.fold_aliases(rows, aliases, ["id"]).collect()} == {(1, "hip hop", 3), (1, "drum and bass", 1), (1, "jungle", 1), (2, "rock", 1)}


def test_genre_tokens(spark):
    tags_ = spark.createDataFrame([("atmospheric black metal",), ("crust/punk",), ("voodoo",)], "tag string")
    approved = spark.createDataFrame([("black metal",), ("metal",), ("punk",), ("black",)], "gram string")
    hits = tags_.select("tag", F.explode(tags.ngrams(F.col("tag"))).alias("g")).join(approved, F.col("g.gram") == F.col("gram")).groupBy("tag").agg(F.collect_list("g").alias("gs"))
    assert {r[0]: r[1] for r in hits.select("tag", tags.recovered(F.col("gs"))).collect()} == {"atmospheric black metal": ["black metal"], "crust/punk": ["punk"]}


def test_upserts_are_idempotent(spark):
    kept = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "k int, t int, v string")
    new = spark.createDataFrame([(1, 2, "c"), (2, 4, "d"), (3, 1, None)], "k int, t int, v string")
    once = history.latest_wins(kept, new, ["k"], "t")
    twice = history.latest_wins(once, new, ["k"], "t")
    want = {(1, 2, "c"), (2, 5, "b"), (3, 1, None)}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in twice.collect()}
    assert {tuple(r) for r in history.insert_absent(kept, new, ["k"]).collect()} == {(1, 1, "a"), (2, 5, "b"), (3, 1, None)}
    assert {tuple(r) for r in history.replace_groups(kept, new.where("k = 1"), ["k"]).collect()} == {(1, 2, "c"), (2, 5, "b")}
    merged = history.merge_fields(kept, new, ["k"], ["t"], ["v"])
    assert {tuple(r) for r in merged.collect()} == {(1, 2, "c"), (2, 4, "d"), (3, 1, None)}


def test_dump(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("1\ta\\tb\tt\n2\t\\N\tf\n3\t\\\\n\t\\N\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("s", T.StringType()), T.StructField("b", T.BooleanType())])
    got = dumps.read_dump(spark, str(tmp_path / "d.tsv"), schema).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a\tb", True), (2, None, False), (3, "\\n", None)]
    with pytest.raises(dumps.LayoutError):
        dumps.check_layout(spark, str(tmp_path / "d.tsv"), 2)


def test_payloads(spark):
    df = spark.createDataFrame([("7", '{"data":[{"id":1,"title":"t","preview":"u","duration":3,"artist":{"id":7}},{"id":2,"preview":"","artist":{"id":7}},{"id":3,"preview":"u","artist":{"id":8}}]}')], "owner string, body string")
    assert [r["id"] for r in dumps.platform_tracks(df, "body", "owner").collect()] == [1]
    page = spark.createDataFrame([('<a href="/a?x">A</a><a href="/b#y">B</a><a href="/a">A</a>', "a &amp;lt; b &#34;&#x41;&#8217;&#; &#0; x&#99999999;")], "h string, t string")
    r = page.select(dumps.html_links(F.col("h")), dumps.unescape_html(F.col("t"))).first()
    assert list(r[0]) == ["/a", "/b"] and r[1] == 'a &lt; b "A’&#; &#0; x&#99999999;'


def test_stream_publishes_and_repeats(spark, tmp_path):
    from sonarium.streaming.incremental import SnapshotSink, publish, windowed_counts

    schema = "k int, t timestamp, v string"
    src, sink = str(tmp_path / "in"), SnapshotSink(spark, str(tmp_path / "out"), ["k"], "t")
    spark.createDataFrame([(1, at(1), "a"), (2, at(1), "b")], schema).write.mode("append").parquet(src)
    for rows in ([], [(1, at(2), "c"), (3, at(1), "d")]):
        if rows:
            spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        publish(spark.readStream.schema(schema).parquet(src), sink, str(tmp_path / "cp")).awaitTermination(60)
    assert {(r.k, r.v) for r in sink.read(1).collect()} == {(1, "c"), (2, "b"), (3, "d")}
    sink.upsert(spark.createDataFrame([(1, at(2), "c"), (3, at(1), "d")], schema), 1)
    assert sink.read(1).count() == 3
    for i in range(2, 7):
        sink.upsert(spark.createDataFrame([(1, at(i), f"v{i}")], schema), i)
    assert sink.versions() == [4, 5, 6] and {(r.k, r.v) for r in sink.read(6).collect()} == {(1, "v6"), (2, "b"), (3, "d")}
    with pytest.raises(ValueError):
        sink.upsert(spark.createDataFrame([(1, at(9), "x")], schema), 9)  # version 8 is missing
    q = windowed_counts(spark.readStream.schema(schema).parquet(src), "t", "v").writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)


def test_registry_names_columns_once(spark):
    assert set(registry.oracle_sql()) <= set(registry.queries())
