"""Choices by bars, ledgers of runs and the probe, against brute force and made-up cases."""

import random

import numpy as np

from sonarium.operators import serving


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_calibrate_equals_brute_force(spark):
    draw = random.Random(3)
    cards = [(v, label, draw.randrange(150_000, 550_000), draw.randrange(1, 5), draw.randrange(-90_000, 260_000), draw.choice([label, 9, None])) for v in range(60) for label in range(draw.randrange(1, 4))]
    frame = spark.createDataFrame(cards, "vec_id long, label int, median long, n long, margin long, correct int")
    got = serving.calibrate(frame, serving.BARS, serving.FLOORS, serving.LEAST, 0.3).collect()
    cells = {}
    for b in serving.BARS:
        for f in serving.FLOORS:
            for m in serving.LEAST:
                by = {}
                for v, label, med, n, margin, correct in cards:
                    if med >= b * 10_000 and margin >= f * 10_000 and n >= m:
                        by.setdefault(v, []).append(label == correct)
                one = [x[0] for x in by.values() if len(x) == 1]
                cells[b, f, m] = (len(one), sum(one))
    assert {(r["bar"], r["floor"], r["least"]): (r["binds"], r["correct"]) for r in got} == cells
    asked = len({c[0] for c in cards if c[5] is not None})
    good = [(-round(right / asked, 4), -n, cell) for cell, (n, right) in cells.items() if n and right / n >= 0.3]
    assert [(r["bar"], r["floor"], r["least"]) for r in got if r["best"]] == ([min(good)[2]] if good else [])
    none = serving.calibrate(frame.limit(0), serving.BARS, serving.FLOORS, serving.LEAST, 0.3).collect()
    assert len(none) == len(cells) and not any(r["binds"] or r["best"] for r in none)


def test_runs_below_the_version_required(spark):
    units = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "u string")
    heads = spark.createDataFrame([("mood", 2), ("key", 1)], "head string, version int")
    ledger = spark.createDataFrame([("a", "mood", 1, 5), ("b", "mood", 2, 5), ("b", "key", 3, 5), ("x", "key", 1, 5)], "u string, head string, version int, computed_at int")
    todo = serving.pending_runs(units, heads, ledger, "u")
    assert rows(todo, "u", "head", "version") == [("a", "key", 1), ("a", "mood", 2)]
    results = spark.createDataFrame([("a", "mood", 2, 7, None), ("a", "key", 1, 7, True), ("b", "key", 3, 8, False)], "u string, head string, version int, computed_at int, declined boolean")
    after = serving.record_runs(ledger, results, "u")
    assert rows(after, "u", "head", "version", "computed_at") == [("a", "mood", 2, 7), ("b", "key", 3, 8), ("b", "mood", 2, 5), ("x", "key", 1, 5)]
    assert rows(serving.pending_runs(units, heads, after, "u"), "u", "head") == [("a", "key")]  # what declined is asked again


def test_probe_tells_what_can_be_told(spark, tmp_path):
    draw = np.random.default_rng(5)
    data = [(i, [float(x) for x in draw.normal(3.0 if i % 3 == 0 else 0.0, 1.0, 8)], 0 if i % 3 == 0 else 1 + i % 2) for i in range(300)]
    frame = spark.createDataFrame([*data, data[0], (900, None, 0), (901, [0.0] * 8, None)], "vec_id long, embedding array<float>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    r = serving.logistic_probe(spark, str(tmp_path)).first()
    assert r["fitted"] + r["held"] == 300 and 40 < r["held"] < 110 and r["auc"] > 0.99
