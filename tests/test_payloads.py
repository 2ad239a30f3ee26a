"""Payloads of platforms on small fixtures, made up here."""

import json

import pytest

from sonarium.sources import payloads


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_three_shapes_of_hits(spark):
    bodies = spark.createDataFrame(
        [
            (1, "deezer", json.dumps({"data": [{"name": "Noa", "id": 7, "nb_fan": 3}, {"name": "Noa B", "id": 8}]})),
            (2, "bandcamp", json.dumps({"auto": {"results": [{"type": "b", "name": "Noa", "item_url_root": "https://noa.bandcamp.com"}, {"type": "a", "name": "x", "item_url_root": "https://x.bandcamp.com"}, {"type": "b", "name": "y", "item_url_root": "https://y.example"}]}})),
            (3, "soundcloud", json.dumps({"collection": [{"username": None, "permalink": "noa-s", "track_count": 4}, {"username": "z"}]})),
            (4, "deezer", "no json"), (5, "deezer", None), (6, "soundcloud", "{}"),
        ],
        "q int, platform string, body string",
    )
    got = payloads.search_hits(bodies, ["q"])
    assert rows(got, "q", "place", "name", "platform_id", "popularity") == [(1, 0, "Noa", "7", 3), (1, 1, "Noa B", "8", 0), (2, 0, "Noa", "noa", 0), (3, 0, "", "noa-s", 4)]


def test_names_are_resolved_by_equality_then_popularity(spark):
    hits = spark.createDataFrame([("Nóa", "1", 5), ("NOA", "2", 9), ("noa", "3", 9), ("noab", "4", 99), ("!", "5", 1), (None, "6", 1)], "name string, platform_id string, popularity long")
    wanted = spark.createDataFrame([("noa",), ("noa",), ("other",), ("?",), (None,)], "name string")
    assert rows(payloads.resolve_names(wanted, hits), "name", "platform_id") == [("noa", "2")]


def test_second_branch_only_for_owners_without_the_first(spark):
    a = spark.createDataFrame([("x", i) for i in range(5)], "o string, n int")
    b = spark.createDataFrame([("x", 100), ("y", 3), ("y", 1)], "o string, n int")
    assert rows(payloads.first_filled(a, b, "o", ["n"], 3), "o", "n", "place") == [("x", 0, 1), ("x", 1, 2), ("x", 2, 3), ("y", 1, 1), ("y", 3, 2)]
    assert payloads.first_filled(a.limit(0), b.limit(0), "o", ["n"], 3).count() == 0


def release(tracks):
    body = json.dumps({"artist": "N", "trackinfo": tracks}).replace('"', "&quot;")
    return f'<div data-tralbum="{body}"></div>'


def test_release_walk(spark):
    track = lambda i: {"track_id": i, "title": f"t{i}", "duration": 61.5, "artist": None, "file": {"mp3-128": f"u{i}"}}
    lists = spark.createDataFrame([("a", '<a href="/album/one"><a href="/track/two?x"><a href="/track/two"><a href="/album/one">'), ("b", "nothing"), ("c", None)], "o string, html string")
    assert rows(payloads.walked_releases(lists, "o", "html"), "o", "release_index", "path") == [("a", 0, "/album/one"), ("a", 1, "/track/two"), ("b", 0, ""), ("c", 0, "")]
    cached = spark.createDataFrame([("a", "/track/two", release([track(1), track(2)])), ("a", "/album/one", "no tracks"), ("b", "", release([track(3)]))], "o string, path string, html string")
    got = payloads.release_walk(lists, cached, "o")
    assert rows(got, "o", "release_index", "track_index", "id", "seconds") == [("a", 1, 0, "1", 61), ("a", 1, 1, "2", 61), ("b", 0, 0, "3", 61)]
    assert rows(payloads.walked_releases(lists, "o", "html", 1), "o", "path")[0] == ("a", "/album/one")


def test_tags_of_cached_pages_and_tree(spark):
    tag = lambda *t: "".join(f'<a class="tag" href="#">{x}</a>' for x in t)
    cached = spark.createDataFrame(
        [("https://Noa.bandcamp.com/b", 200, "text/html; x", tag("Jazz", "drone")), ("https://noa.bandcamp.com/a", 200, "text/html", tag("drone", "noise")), ("https://noa.bandcamp.com/c", 404, "text/html", tag("gone")),
         ("https://noa.bandcamp.com/d", 200, "application/json", tag("json")), ("https://noa.bandcamp.com/e", 200, "text/html", None), ("https://other.bandcamp.com/", 200, "text/html", tag("other"))],
        "url string, status int, content_type string, body string",
    )
    owners = spark.createDataFrame([("NOA", "n"), ("other", None)], "platform_id string, artist_id string")
    got = {r["artist_id"]: r["tags"] for r in payloads.harvest_tags(cached, owners).collect()}
    assert got == {"n": ["jazz", "drone", "noise"]}  # the address of the first page sorts first, capitals before
    blob = json.dumps({"appData": {"initialState": {"genres": [{"slug": "rock"}, {"slug": ""}, {"slug": "folk"}], "subgenres": [{"slug": "rock"}, {"slug": "drone"}]}}}).replace('"', "&quot;")
    pages = spark.createDataFrame([(f'<div data-blob="{blob}">',), ("none",)], "html string")
    assert [r[0] for r in pages.select(payloads.tag_tree(pages["html"])).collect()] == [["rock", "folk", "drone"], []]


def test_labelled_files(spark, tmp_path):
    for name in ("rock/b.wav", "rock/a.wav", "folk/c.wav", "folk/c.txt", "loose.wav"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    got = payloads.labelled_files(spark, str(tmp_path), "*.wav")
    assert rows(got, "label", "file", "content") == [("folk", "c.wav", b"folk/c.wav"), ("rock", "a.wav", b"rock/a.wav"), ("rock", "b.wav", b"rock/b.wav")]


def test_required_and_to_fetch(spark):
    known = spark.createDataFrame([("p", "1", "i1"), ("p", "1", "i0")], "platform string, page string, id string")
    ask = lambda *pages: payloads.required(spark.createDataFrame([("p", x) for x in pages], "platform string, page string"), known, ["platform", "page"], "id")
    assert rows(ask("1"), "page", "id") == [("1", "i0")]
    with pytest.raises(Exception, match="no id for p 2"):
        ask("1", "2").collect()
    cached = spark.createDataFrame([("a", 200, "x", 1), ("a", 500, "x", 2), ("b", 404, "", 1), ("c", 200, None, 3), ("d", 500, "x", 1), ("d", 204, "x", 2)], "key string, status int, body string, fetched_at int")
    wanted = spark.createDataFrame([(k,) for k in "aabcde"] + [(None,)], "key string")
    assert rows(payloads.to_fetch(wanted, cached), "key") == [("a",), ("c",), ("e",)]


def test_dump_round_trip(spark, tmp_path):
    from sonarium.sources import dumps

    data = [("a\tb", True, 1), ("\\N", False, None), ("line\nnext\r", None, 2), ("\\t", True, 3), ("", None, 4), (None, None, 5)]
    frame = spark.createDataFrame(data, "s string, b boolean, n long")
    dumps.write_dump(frame, f"{tmp_path}/dump")
    assert sorted(map(repr, (tuple(r) for r in dumps.read_dump(spark, f"{tmp_path}/dump", frame.schema).collect()))) == sorted(map(repr, data))


def test_identities_by_earliest_claim(spark):
    from sonarium.operators.feeds import derive_identities

    claims = spark.createDataFrame([("b", "d", "1", 2), ("a", "d", "1", 3), ("c", "d", "1", 2), ("c", "d", "2", None), ("a", "d", "2", 9), (None, "d", "3", 1), ("a", "d", "", 1), ("a", "s", "1", 1), ("e", "d", "1", None)], "artist_id string, platform string, platform_id string, at int")
    filed = spark.createDataFrame([("e", "d")], "artist_id string, platform string")
    got = derive_identities(claims, filed)
    assert rows(got, "kind", "artist_id", "platform", "platform_id") == [("identity", "a", "d", "2"), ("identity", "a", "s", "1"), ("identity", "b", "d", "1"), ("review", "a", "d", "1"), ("review", "c", "d", "1")]
    assert derive_identities(claims.limit(0), filed).count() == 0
