import datetime as dt
import itertools
import math
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

tiktoken = pytest.importorskip("tiktoken")

from sonarium.llm import bpe, leakage, linkage, names, neighbours, residue, spelling, term_counts, topn  # noqa: E402


def at(day):
    return dt.datetime(2026, 1, day)


# 1
def found_names(spark, rows):
    df = spark.createDataFrame(rows, "key string, name string, mbid string, extra int")
    return {(r.key_a, r.key_b) for r in names.variant_pairs(df).collect()}


def test_name_variants(spark):
    rows = [("a1", "Elizabeth Kravomeil", "m1", 1), ("a2", "Liz Kravomiel", None, 1), ("a3", "КРАВОМЕИЛ, Елизабетх", None, 1), ("a4", "E. Kravomeil [live]", None, 1),
            ("b1", "Kravomeil Ghosts", "m2", 1), ("b2", "Kravomeil Cathedral", "m3", 1), ("c", None, None, 1), ("d", "  ", None, 1), ("e", "!!!", None, 1), (None, "Liz Kravomeil", None, 1),
            ("f1", "Zupelo & Moths", "m4", 1), ("f2", "Zupelo & Moths", "m5", 1), ("f3", "zupelo und moths", None, 1)]
    pairs = {("a1", "a2"), ("a1", "a3"), ("a1", "a4"), ("a2", "a3"), ("a2", "a4"), ("a3", "a4"), ("f1", "f3"), ("f2", "f3")}
    assert found_names(spark, rows + rows[:4]) == pairs
    assert found_names(spark, []) == set()


def test_trie_equals_brute_force():
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(150)]

    def plain(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return last[-1]

    trie, asked = names.Trie(words[:80]), sorted(set(words[80:]))
    got = {(asked[i], trie.words[j], int(d)) for q, w, ds in trie.within(asked, 2) for i, j, d in zip(q, w, ds)}
    assert got == {(a, b, d) for a in asked for b in trie.words if (d := plain(a, b)) <= 2}


def test_long_names_and_word_order(spark):
    long = "Word " * 400
    assert spelling.tokens(None) == [] == spelling.tokens(" ")
    assert names.name_cost(["sebastian", "kroma"], ["kroma", "bastian"]) == 0
    assert names.name_cost(["kroma", "ghosts"], ["kroma", "moths"]) > names.BOUND
    assert found_names(spark, [("a", long, None, 1), ("b", long, None, 1)]) == {("a", "b")}


def test_typos_in_long_names_are_found(spark):
    rng = random.Random(9)
    made = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(4))
    rows, want = [], set()
    for i in range(60):
        words = [made() for _ in range(rng.randint(8, 12))]
        typed = list(words)
        for at_word in rng.sample(range(len(words)), rng.choice((1, 2))):
            w, at = typed[at_word], rng.randint(1, 6)
            typed[at_word] = rng.choice((w[:at] + w[at + 1 :], w[:at] + "z" + w[at:], w[:at] + w[at + 1] + w[at] + w[at + 2 :], w[:at] + "z" + w[at + 1 :]))
        if i % 3 == 0:
            rng.shuffle(typed)
        rows += [(f"a{i}", " ".join(words), None, 1), (f"b{i}", " ".join(typed), None, 1)]
        want.add((f"a{i}", f"b{i}"))
    got = found_names(spark, rows)
    assert len(got & want) >= 0.95 * len(want) and got <= want


def test_names_of_common_words_alone(spark):
    # every word below is in more than 60 names
    firsts = ["Christopher", "Veiwatusim", "Dorimanta", "Kelubrofa"] + ["".join(c) + "ombaruf" for c in zip("bdfgklmnprst", "aeiouaeiouae")]
    lasts = ["Static", "Orchestra", "Gabasuni"] + [a + b + "vult" for a in "bdfgklmnprst" for b in "aeiou"]
    crowd = [(f"n{i}.{j}", f"{x} {y}", f"m{i}.{j}", 1) for i, x in enumerate(firsts) for j, y in enumerate(lasts)]
    rows = [("a", "christophergabasuni", None, 1), ("b", "Veiwatusim Statik Gabasuni", "mb", 1), ("c", "VeiwatusimStatic Gabasuni", None, 1), ("d", "Kit Orchestra", None, 1), ("e", "Torimanta Urchestra", None, 1)]
    got = found_names(spark, crowd + rows)
    assert {("a", "n0.2"), ("b", "c"), ("d", "n0.1"), ("e", "n2.1")} <= got


def test_trie_counts_a_swap_as_one():
    rng = random.Random(6)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(150)]
    trie, asked = names.Trie(words[:80]), sorted(set(words[80:]))
    for most in (0, 1, 2):
        got = {(asked[i], trie.words[j], int(d)) for q, w, ds in trie.within(asked, most, swaps=True) for i, j, d in zip(q, w, ds)}
        assert got == {(a, b, d) for a in asked for b in trie.words if (d := spelling.distance(a, b, most)) <= most}


def test_search_is_as_wide_as_the_comparison(spark):
    crowd = [(f"n{i}", f"{a}{b}vult{c}{d}mos Choir", f"m{i}", 1) for i, (a, b, c, d) in enumerate((a, b, c, d) for a in "bdfg" for b in "aei" for c in "klm" for d in "ou")]
    long = "Grand Symphonic Kravomeil Orchestra Zupelo Vareny Olmstad Tuskarem"
    rows = [("a", "Dove Choir", "m", 1), ("b", "Dvoe Choir", None, 1), ("c", long, None, 1), ("d", long.replace("Vareny", "Varemy"), None, 1), ("e", "Phabol Choir", None, 1), ("f", "Phatul Choir", None, 1),
            ("g", "MC Gephopawen Restless", None, 1), ("h", "MC Geofpeawen Restless", None, 1)]
    assert {("a", "b"), ("c", "d"), ("e", "f"), ("g", "h")} <= found_names(spark, crowd + rows)
    costs = [[random.Random(i * 7 + j).choice([0, 1, 2, 99]) for j in range(6)] for i in range(6)]
    assert names._pairing(costs) == min(sum(costs[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(6)))


# 3
TAGS = "record string, tag string, occurrences int"


def read_counts(df):
    return {(r.term, r.occurrences, r.records) for r in df.collect()}


def test_term_counts_by_increments_equal_a_recount(spark):
    before = spark.createDataFrame([("r1", "Rock ", 1), ("r1", "rock", 1), ("r2", "jazz", 1), ("r3", "jazz", 1), ("r4", None, 1), ("r4", " ", 1), (None, "x", 1)], TAGS)
    after = spark.createDataFrame([("r1", "Rock ", 1), ("r2", "jazz", 1), ("r5", "É", 1), ("r6", "É", 1)], TAGS)
    b, a = term_counts.record_terms(before), term_counts.record_terms(after)
    kept = term_counts.TermCounts(spark).update(b)
    assert read_counts(kept.counts()) == {("rock", 2, 1), ("jazz", 2, 2)}
    kept = term_counts.TermCounts(spark, kept.path)  # as another process would
    kept.update(a)
    assert kept.version == 2
    whole = term_counts.TermCounts(spark).update(a).counts()
    assert read_counts(term_counts.TermCounts(spark, kept.path).counts()) == read_counts(whole) == {("rock", 1, 1), ("jazz", 1, 1), ("é", 2, 2)}
    marks = term_counts.marked(whole, spark.createDataFrame([(5,)], "n bigint"), rare_below=2, common_share=0.3)
    assert {(r.term, r.mark) for r in marks.collect()} == {("rock", "rare"), ("jazz", "rare"), ("é", "common")}
    assert term_counts.TermCounts(spark).update(a.limit(0)).counts().count() == 0


def test_an_increment_writes_what_it_touches(spark, monkeypatch):
    monkeypatch.setattr(term_counts, "BUCKET_ROWS", 20)
    rows = [(f"r{i}", f"t{j}", 1) for i in range(40) for j in range(i, i + 10)]
    first = term_counts.record_terms(spark.createDataFrame(rows, TAGS))
    kept = term_counts.TermCounts(spark).update(first)
    changed = [r for r in rows if r[0] != "r3"] + [("r3", "t3", 1), ("new", "t3", 2)]
    kept = term_counts.TermCounts(spark, kept.path).update(term_counts.record_terms(spark.createDataFrame(changed, TAGS)))
    want = {}
    for r, t, n in changed:
        o, k = want.get(t, (0, set()))
        want[t] = (o + n, k | {r})
    assert read_counts(kept.counts()) == {(t, o, len(k)) for t, (o, k) in want.items()}
    written = spark.read.parquet(f"{kept.path}/records/v=2")
    assert written.count() < 0.7 * len(rows) and written.where("record = 'r3'").count() == 1
    same = kept.update(term_counts.record_terms(spark.createDataFrame(changed, TAGS)))
    assert same.version == 2  # nothing changed, nothing is written


# 4
def test_neighbours_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 60)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 16))
    v = centres[rng.integers(0, 6, 400)] + 0.4 * rng.normal(size=(400, 16))
    rows = [("g", f"k{i:03d}", [float(x) for x in v[i] * (1 + i % 3)], 16, 1) for i in range(400)]
    bad = [("g", "n", None, 16, 1), ("g", "z", [0.0] * 16, 16, 1), ("g", "w", [1.0] * 15, 16, 1), ("g", "nan", [math.nan] * 16, 16, 1), ("g", "inf", [math.inf] * 16, 16, 1), ("alone", "a", [1.0] * 16, 16, 1), ("g", None, [1.0] * 16, 16, 1)]
    df = spark.createDataFrame(rows + bad + rows[:20], "grp string, key string, embedding array<float>, dim int, extra int")
    got = {r.key: {x.key for x in r.near} for r in neighbours.nearest(df).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = {f"k{i:03d}": {f"k{j:03d}" for j in np.argsort(-s[i])[:5]} for i in range(400)}
    assert got.keys() == want.keys()
    assert sum(len(got[k] & want[k]) for k in want) / 2000 >= 0.97


def test_many_copies_of_one_vector(spark):
    rows = [("g", f"c{i:02d}", [1.0, 2.0], 2) for i in range(30)] + [("g", "o", [2.0, 1.0], 2), ("g", "p", [2.1, 1.0], 2)]
    df = spark.createDataFrame(rows, "grp string, key string, embedding array<float>, dim int")
    got = {r.key: [x.key for x in r.near] for r in neighbours.nearest(df).collect()}
    assert got["c20"] == ["c00", "c01", "c02", "c03", "c04"] and got["c00"] == ["c01", "c02", "c03", "c04", "c05"]
    assert got["o"] == ["p", "c00", "c01", "c02", "c03"]
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_tile_is_exact():
    rng = np.random.default_rng(1)
    q, m = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.normal(size=(40, 32)).astype(np.float32), rng.normal(size=(1500, 32)).astype(np.float32)))
    i, j, _ = neighbours.tile_neighbours(q, m, np.full(40, -1), 5)
    assert all(set(j[i == a]) == set(np.argsort(-(q[a] @ m.T))[:5]) for a in range(40))


def vector_batch(v):
    return pa.RecordBatch.from_arrays(
        [pa.array(["g#"] * len(v)), pa.array([f"k{i}" for i in range(len(v))]), pa.array(v.tolist(), pa.list_(pa.float32()))], names=["grp", "key", "embedding"]
    )


def test_vectors_travel_packed_and_unharmed():
    rng = np.random.default_rng(4)
    for d in (1, 5, 96):
        v = rng.normal(size=(300, d)).astype(np.float32)
        v[::7, 0] = 40.0  # rows with a value near 1 need more bits
        (units,) = neighbours._to_units([vector_batch(v)])
        w = v.astype(np.float64)
        want = (np.round(w / np.linalg.norm(w, axis=1, keepdims=True), 6) + 0.0).astype(np.float32)
        assert np.array_equal(neighbours._matrix(units.column(2)), want)
        lengths = [len(x) for x in units.column(2).to_pylist()]
        assert max(lengths) <= 3 * d + 1 and (d < 96 or np.median(lengths) <= 2.5 * d + 1)


def test_vector_goes_to_its_own_tile_once():
    (units,) = neighbours._to_units([vector_batch(np.random.default_rng(5).normal(size=(50, 8)))])
    cls = pa.array([bytes([0, 0, i, 7 * i % 256]) for i in range(50)], pa.binary())
    batch = pa.RecordBatch.from_arrays([units.column(0), units.column(1), cls, units.column(2)], names=["grp", "key", "cls", "unit"])
    sites, blocks = SimpleNamespace(value={"g#": np.eye(8, dtype=np.float32)[:1]}), SimpleNamespace(value={("g#", 0): (2, 3)})
    tiles = [x for b in neighbours._routed(sites, blocks, 6)([batch]) for x in b.to_pylist()]
    assert len(tiles) == len({(x["key"], x["mb"], x["qb"]) for x in tiles}) == 50 * (2 + 3 - 1)
    for key in {x["key"] for x in tiles}:
        asked, held = ({(x["mb"], x["qb"]) for x in tiles if x["key"] == key and x["role"] & bit} for bit in (2, 1))
        assert {mb for mb, _ in asked} == {0, 1} and {qb for _, qb in held} == {0, 1, 2} and len(asked & held) == 1


# 5
def test_linkage(spark):
    c = [(1, "p1", "Anna Kravomeil", "Tusk, Vareny", ["dub", "acid jazz"], '{"site": "https://www.kravo.example/"}', 1), (2, "p2", "Anna Kravomeil", "Olm", ["metal"], None, 1), (3, "p3", None, None, None, None, 1), (1, "p1", "Anna Kravomeil", "Tusk, Vareny", ["dub", "acid jazz"], '{"site": "https://www.kravo.example/"}', 1)]
    p = [("x", None, "youtube", "UC1", None, "unknown", '{"candidate_name": "Ana Kravomeil", "city": "Tusk"}'), ("y", None, "youtube", "UC2", None, "unknown", '{"candidate_name": "Anna Kravomeil", "city": "Rilm", "tags": ["opera"]}'),
         ("z", None, "deezer", "1", None, "unknown", '{"site": "http://kravo.example"}'), ("q", "a", "deezer", "2", None, "artist", '{"candidate_name": "Anna Kravomeil", "city": "Tusk"}'), ("n", None, "deezer", "3", None, "unknown", None)]
    cs = spark.createDataFrame(c, "id bigint, platform_id string, band_name string, location string, tags array<string>, links string, extra int")
    ps = spark.createDataFrame(p, "id string, artist_id string, platform string, platform_id string, vanity_url string, page_type string, binding_evidence string")
    sure = {(r.candidate_id, r.identity_id) for r in linkage.linked(cs, ps).where(F.col("sureness") >= linkage.SURE).collect()}
    assert sure == {(1, "x"), (1, "z")}
    assert linkage.linked(cs.limit(0), ps).count() == 0 == linkage.linked(cs, ps.limit(0)).count()


def test_linkage_of_names_typed_as_one_or_further_apart(spark):
    c = [(1, "p1", "The Iron Brazommurol Weather", "N. Brovolulim, Olm", ["dub"], None), (2, "p2", "MC Gitsustenr Blue", "Hawa", ["metal", "disco"], None), (3, "p3", "Hostal Quintet", None, [], '{"site": "many.example"}')]
    c += [(10 + i, f"q{i}", f"Pale {w}", None, [], '{"site": "many.example"}') for i, w in enumerate("bavuk hemod jifal kopaz mulen nirot pubas rosed suvik tezom vafil wogan zubet cadov dimuk fapol gesir lutan havem kiron".split())]
    p = [("x", None, "youtube", "UC1", None, "unknown", '{"candidate_name": "theironbrazomurolweather", "city": "New Brovolulim"}'), ("y", None, "deezer", "1", None, "unknown", '{"candidate_name": "MC Gistiustenir Blue", "city": "Hawa", "tags": ["disco"]}'),
         ("z", None, "deezer", "2", None, "unknown", '{"candidate_name": "Unlike", "site": "many.example"}'), ("n", None, "deezer", "3", None, "unknown", '{"candidate_name": "Hostal Quintet", "site": "many.example"}')]
    cs = spark.createDataFrame(c, "id bigint, platform_id string, band_name string, location string, tags array<string>, links string")
    ps = spark.createDataFrame(p, "id string, artist_id string, platform string, platform_id string, vanity_url string, page_type string, binding_evidence string")
    got = {(r.candidate_id, r.identity_id): r.sureness for r in linkage.linked(cs, ps).collect()}
    assert {k for k, v in got.items() if v >= linkage.SURE} == {(1, "x"), (2, "y")} and set(got) == {(1, "x"), (2, "y"), (3, "n")}


def test_a_site_is_told_by_its_acts_not_by_its_records(spark):
    words = "bavuk hemod jifal kopaz mulen nirot pubas rosed suvik tezom vafil wogan zubet cadov dimuk fapol gesir lutan havem kiron letig morun"
    c = [(i, f"p{i}", ("Anna Kravomeil", "Ana Kravomeil")[i % 2], "Tusk, Vareny", [], '{"site": "https://kravo.example/"}') for i in range(30)]  # records of one act
    c += [(100 + i, f"q{i}", f"Pale {w}", None, [], f'{{"site": "https://many.example/{w}/"}}') for i, w in enumerate(words.split())]  # one record of each of many acts
    p = [("x", None, "youtube", "UC1", None, "unknown", '{"candidate_name": "Unlike", "site": "http://www.kravo.example"}'), ("y", None, "deezer", "1", None, "unknown", '{"candidate_name": "Other Thing", "site": "many.example/kopaz#top"}'),
         ("z", None, "deezer", "2", None, "unknown", '{"candidate_name": "Unlike", "site": "many.example"}'), ("n", None, "soundcloud", "3", None, "unknown", '{"candidate_name": "Anna Kravomeil", "city": "Tusk", "site": "zupelo.example"}')]
    cs = spark.createDataFrame(c, "id bigint, platform_id string, band_name string, location string, tags array<string>, links string")
    ps = spark.createDataFrame(p, "id string, artist_id string, platform string, platform_id string, vanity_url string, page_type string, binding_evidence string")
    for candidates in (cs, cs.unionByName(cs.withColumn("id", F.col("id") + 1000))):  # a larger table with the same acts
        got = {(r.candidate_id, r.identity_id): r.sureness for r in linkage.linked(candidates, ps).collect()}
        ids = {r.id for r in candidates.collect()}
        assert {k for k, v in got.items() if v >= linkage.SURE} == {(i, "x") for i in ids if i % 1000 < 30} | {(i, "y") for i in ids if i % 1000 == 103}
        assert {k for k in got if k[1] in "zn"} == {(i, "n") for i in ids if i % 1000 < 30}


def test_what_a_shared_site_says_fades(spark):
    # a host of n acts, "Anna Kravomeil" among them: a page of that name on it is surely hers up to 20, and less and less in question beyond
    made = ["".join(w) for w in itertools.product(("brol", "dinz", "fumk", "gash", "jevt", "pixo"), ("amur", "etok", "ilsh", "onde", "uvig", "yrap"))]
    for n, weight in ((2, 6.0), (20, 1.025), (30, 20.5 / 30)):
        c = [(i, w, None, [], "many.example", "many.example") for i, w in enumerate(["Anna Kravomeil", *made[: n - 1]])]
        left = spark.createDataFrame(c, "id bigint, name string, place string, tags array<string>, site string, address string")
        right = spark.createDataFrame([("x", "deezer", *c[0][1:])], "id string, platform string, name string, place string, tags array<string>, site string, address string")
        pairs = linkage.paired(left, right)
        rules = {r["rule"]: r["weight"] for r in linkage.ground_rules(pairs).collect()}
        assert rules["site:0|x"] == pytest.approx(weight)
        assert ("site:1|x" in rules) == (n <= 20)


def test_a_page_belongs_to_one_of_the_candidates_that_differ(spark):
    row = (1, "x", "deezer", 1.0, 1, 0, None), (2, "x", "deezer", 1.0, -1, 0, 0.9), (3, "x", "deezer", 0.75, 0, 0, 0.9)
    pairs = spark.createDataFrame(row, "a int, b string, platform string, name double, town int, site int, tags double")
    got = {r["var"]: r["value"] for r in linkage.solve(linkage.ground_rules(pairs)).collect()}
    assert got["1|x"] > 0.9 and got["2|x"] < 0.1 and got["3|x"] > 0.6


def test_alternating_directions_reach_the_optimum(spark):
    # 3 * max(0, 0.9 - x) + x, and x + y <= 1 beside 2 * max(0, 0.8 - y) + 0.5 * y
    rules = [("a", "x", -1.0, 0.9, 3.0), ("b", "x", 1.0, 0.0, 1.0), ("c", "y", -1.0, 0.8, 2.0), ("d", "y", 1.0, 0.0, 0.5), ("e", "x", 1.0, -1.0, 5.0), ("e", "y", 1.0, -1.0, 5.0)]
    got = {r["var"]: r["value"] for r in linkage.solve(spark.createDataFrame(rules, "rule string, var string, coef double, base double, weight double"), rounds=30).collect()}
    assert got["x"] == pytest.approx(0.9, abs=0.06) and got["y"] == pytest.approx(0.1, abs=0.06)


def test_countries_are_told_by_where_they_stand(spark):
    # one town has a third of the rows, the table is small, and a town has three letters
    places = ["Tusk, Vareny"] * 30 + [f"T{i}m, Vareny" for i in range(5)] + ["Olm, Dresk", "Rilm, Dresk", "Vareny, Tusk", "Tusk", "Dresk", None, " "] + ["Ulf"] * 25
    df = spark.createDataFrame([(i, p) for i, p in enumerate(places)], "id int, place string")
    countries = linkage.countries_of(df)
    assert {r.part for r in countries.collect()} == {"vareny", "dresk"}
    towns = {r.place: sorted(r.towns) for r in linkage._placed(df, countries).collect()}
    assert (towns["Tusk, Vareny"], towns["Olm, Dresk"], towns["Ulf"], towns["Dresk"], towns[None]) == (["tusk"], ["olm"], ["ulf"], [], [])


def test_many_pages_of_one_candidate_reach_the_optimum(spark):
    # as ground_rules has it for pages of equal name and town: 3 * max(0, 1 - x) + x each, and their sum up to 1
    rules = [r for k, n in (("h", 30), ("t", 10)) for i in range(n) for r in ((f"p{k}{i}", f"{k}{i}", -1.0, 1.0, 3.0), (f"q{k}{i}", f"{k}{i}", 1.0, 0.0, 1.0), (f"one:{k}", f"{k}{i}", 1.0, -1.0, 1.0))]
    got = [r["value"] for r in linkage.solve(spark.createDataFrame(rules, "rule string, var string, coef double, base double, weight double")).collect()]
    assert len(got) == 40 and min(got) > 0.97


# 6
def test_top_n_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([0.5, 0.25, -0.0, 0.0, None, math.nan, 1.0]), f"t{rng.randint(0, 400)}", 1) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, s float, t string, place0 int")
    got = sorted(((r.g or "", r.place, r.t) for r in topn.top_n(df, ["g"], "s", ["t"], 7).collect()))
    want = []
    for g in ("hot", "a", "b", None):
        kept = sorted((-s + 0.0, t) for x, s, t, _ in rows if x == g and s is not None and not math.isnan(s))
        want += [(g or "", i, t) for i, (_, t) in enumerate(kept[:7], 1)]
    assert got == sorted(want)
    assert topn.top_n(df.limit(0), ["g"], "s", ["t"], 7).count() == 0


# 7
def test_ids_equal_the_public_encoder(spark):
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hello, wörld! it's 2024\n\n  x", "на концерте アルバム 👩🏽‍🎤", "a" * 5000, "ab" * 300, "<|endoftext|>", "\t  ​", "x" + " " * 200 + "y", "nó" * 90]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: list(r.ids) for r in bpe.encode_texts(df, "text", ranks).collect()}
    assert got == {i: ref.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    words = [("".join(random.Random(i).choice("abeost") for _ in range(60))).encode() for i in range(50)]
    assert all(bpe.merge_by_scan(w, ranks) == bpe.merge_by_heap(w, ranks) for w in words)


# 8
def test_repeated_texts_are_encoded_once(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (3, None), (3, None)], "doc_id bigint, text string")
    assert sorted(map(str, bpe.once(df, "doc_id").collect())) == sorted(map(str, df.distinct().collect()))


@pytest.mark.parametrize("grams", [1_000_000, 0])
def test_leakage(spark, monkeypatch, grams):
    monkeypatch.setattr(leakage, "BROADCAST_GRAMS", grams)
    words = [f"w{i}" for i in range(60)]
    passage, question = " ".join(words), " ".join(f"q{i}" for i in range(20))
    edited = " ".join(w if i % 9 else "zz" for i, w in enumerate(words))
    docs = [(1, "x y " + passage[:200].upper() + " z"), (2, f"<p>{edited}</p>"), (3, " ".join(words[:11])), (4, " , ".join(words[20:32])), (5, None), (6, "  "), (7, ""), (8, "a b " * 20000 + " ".join(f"q{i}" for i in range(4, 17))), (9, "w­1 " + " ".join(f"w​{i}" for i in range(2, 20)))]
    d = spark.createDataFrame(docs + docs[:2], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, passage, question, 1), (8, None, None, 1), (9, "", "short one", 1)], "item_id bigint, passage string, question string, extra int")
    shared = leakage.shared_passages(d, items)
    found = shared.where(F.col("run") | ((F.col("field") == "passage") & (F.col("share") >= leakage.NEARLY_ALL)))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 7), (2, 7), (4, 7), (8, 7), (9, 7)}
    assert leakage.shared_passages(d.limit(0), items).count() == 0 == leakage.shared_passages(d, items.limit(0)).count()


def test_passages_with_altered_words_are_found(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"{rng.choice('bdfgk')}{rng.randint(0, 99999)}" for _ in range(60)), None) for i in range(60)]
    altered = [(100 + i, "so it was " + " ".join(f"x{rng.random()}" if j % 5 == 2 else w for j, w in enumerate(p.split())) + " and so on") for i, p, _ in items]
    d, e = spark.createDataFrame(altered, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, passage string, question string")
    found = {(r.doc_id, r.item_id) for r in leakage.shared_passages(d, e).where(F.col("share") >= leakage.NEARLY_ALL).collect()}
    assert found <= {(100 + i, i) for i in range(60)} and len(found) >= 57  # every fifth word altered leaves runs of four


def test_every_shared_span_has_a_fingerprint():
    rng = np.random.default_rng(0)
    for _ in range(60):
        item, text = rng.integers(0, 1 << 40, 80), rng.integers(1 << 41, 1 << 42, 200)
        a, b = rng.integers(0, 80 - leakage.SPAN), rng.integers(0, 200 - leakage.SPAN)
        text[b : b + leakage.SPAN] = item[a : a + leakage.SPAN]
        h = leakage.gram_hashes(text)
        assert np.isin(h[leakage.winnowed(h)], leakage.gram_hashes(item)).any()


# 9
def residue_of(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id bigint, text string, why string")
    return {r.doc_id: (r.why, r.template) for r in residue.residue(df.union(df.limit(3))).collect()}


def test_residue(spark):
    pages = ["Please enable JavaScript to view this page.", "The Band | Please enable JavaScript to view this page!", "503 Service Unavailable.", "503 SERVICE UNAVAILABLE", "Lorem ipsum dolor sit amet", "Lorem ipsum zut dolor pam sit amet kro."]
    bad = {1: "Welcome to {{ artist_name }}!", 2: "A song by ${CITY} and more.", 3: "The band of {city} plays.", 7: "abc, abc, abc, abc, abc, abc", 8: "Real text here, and much of it, by a band of four. Please enable JavaScript to view this page.", 9: "[[city]] again", 14: "%%ARTIST_NAME%%"}
    bad |= dict(enumerate(pages, 30))
    good = {10: "X wrote the visuals in JavaScript, and the show ran for 404 minutes.", 11: '"Access Denied", the closing piece, has a flute.', 12: "Set list: 1. Song {dub}", 13: "A tune [live] and a drum (official)", 20: None, 21: "", 22: "  \n", 23: "long text " * 30000}
    assert set(residue_of(spark, {**bad, **good})) == set(bad)
    assert residue_of(spark, {1: None}) == {}


def test_slots_are_induced_from_templates(spark):
    # the names are in no list; in braces and without they are known by the templates around them and by each other
    filled = {i: f"For bookings in Tusk write to {n}. See you there." for i, n in enumerate(("Kravo", "Zupelo", "Olm"))}
    left = {10: "For bookings in Tusk write to {{zorp.quxBlee}}. See you there.", 11: "For bookings in Rilm write to %%ZORP_QUX%%. See you there.", 12: "Good old Vareny. For bookings in Rilm write to {quxZorp} now.", 13: "For bookings in Olm write to (). See you there.",
            14: "For bookings in Olm write to zorp_qux. See you there.", 15: "Her {zorp} was late."}
    lone = {20: "He said {blee-blop} in a song.", 21: "An album by zorp_qux itself was late.", 22: "Nothing () here."}
    got = residue_of(spark, {**filled, **left, **lone})
    assert set(got) == set(left) and {got[i] for i in (10, 11, 13, 14)} <= {("placeholder", "<> see you"), ("placeholder", "write to <>")}


def test_a_template_of_pages_is_what_whole_pages_repeat(spark):
    # every text has the seed; only one wording fills pages of its own
    page = "Zuga browser tapplo wemi krast."
    texts = {1: page, 2: "MENU\n" + page.upper(), 3: "A long and true story of a band that plays in a barn above a bakery. " + page, 4: "Their browser song is a long and true story of a band that plays in a barn.", 5: "Their browser song has a long and odd story of a band that plays in a barn."}
    assert set(residue_of(spark, texts)) == {1, 2, 3}


def test_short_forms_follow_a_rule():
    from sonarium.llm.spelling import contracted, tokens

    assert [contracted(w) for w in ("qrt", "chr", "prj", "dj", "mc", "rch", "orch", "trio", "", "bst")] == ["quartet", "choir", "project", "dj", "mc", "rch", "orch", "trio", "", "bst"]
    assert tokens("The Foo Qrt.") == tokens("Tkhe FOO Quartet") == ["foo", "quartet"]
