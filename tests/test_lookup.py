import random

import pytest

from apiary.operators.lookup import range_lookup

BOUNDS = [(0.18, "a"), (0.23, "b"), (0.5, "c"), (0.9, "d"), (1.0, "e")]


def brute(u):
    if u != u:  # NaN
        return "All Other"
    for hi, name in BOUNDS:
        if hi >= u:
            return name
    return "All Other"


@pytest.mark.parametrize("bins", [1, 4, 1024])
def test_edges(spark, bins):
    probes = [0.0, -0.5, 0.18, 0.1800001, 0.23, 0.5, 0.99999, 1.0, 1.0000001, 3.0, float("nan")]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(probes)], "id int, u double")
    bounds = spark.createDataFrame(BOUNDS, "hi double, name string")
    got = {r.id: r.name for r in range_lookup(df, "u", bounds, bins=bins).collect()}
    assert got == {i: brute(u) for i, u in enumerate(probes)}


def test_random_against_brute_force(spark):
    rng = random.Random(7)
    his = sorted({round(rng.random(), 6) for _ in range(300)}) + [1.0]
    global BOUNDS
    saved = BOUNDS
    BOUNDS = [(h, f"n{i}") for i, h in enumerate(his)]
    try:
        probes = [rng.random() for _ in range(2000)] + his[:50]
        df = spark.createDataFrame([(i, u) for i, u in enumerate(probes)], "id int, u double")
        bounds = spark.createDataFrame(BOUNDS, "hi double, name string")
        got = {r.id: r.name for r in range_lookup(df, "u", bounds, bins=64).collect()}
        assert len(got) == len(probes)
        assert got == {i: brute(u) for i, u in enumerate(probes)}
    finally:
        BOUNDS = saved


def test_shuffle_path(spark):
    df = spark.createDataFrame([(i, i / 10) for i in range(11)], "id int, u double")
    bounds = spark.createDataFrame(BOUNDS, "hi double, name string")
    a = range_lookup(df, "u", bounds, max_broadcast_rows=1).collect()
    b = range_lookup(df, "u", bounds).collect()
    assert sorted(a) == sorted(b)
