"""Places in an order and joins by place against plain Python."""

import random

import pytest

from parley.operators import positions


def _rows(seed, n, keys):
    r = random.Random(seed)
    return [(r.choice(keys), r.randint(0, 10**9), i) for i in range(n)]


@pytest.mark.parametrize("keys", [["a"], ["hot"] * 30 + ["x", None, ""], list("abcdefghij")])
def test_places_equal_plain_counting(spark, keys):
    rows = _rows(1, 3_000, keys)
    df = spark.createDataFrame(rows, "k string, t long, id long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["id"]: r["position"] for r in positions.numbered(df, ["k"], ["t", "id"]).collect()}
        whole = {r["id"]: r["position"] for r in positions.numbered(df, [], ["t", "id"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for k in set(keys):
        for i, r in enumerate(sorted((x for x in rows if x[0] == k), key=lambda x: x[1:])):
            want[r[2]] = i
    assert got == want
    assert whole == {r[2]: i for i, r in enumerate(sorted(rows, key=lambda x: x[1:]))}


def test_places_of_no_rows_and_odd_columns(spark):
    df = spark.createDataFrame([], "k string, `a b` long, `a.b` long, `a-b` long, position long")
    assert positions.numbered(df, ["k"], ["a b"]).collect() == []
    one = spark.createDataFrame([("x", 5, 1, 2, 99), ("x", 4, 3, 4, 98)], df.schema)
    assert sorted((r["a b"], r["position"]) for r in positions.numbered(one, ["k"], ["a b"]).collect()) == [(4, 0), (5, 1)]


def test_zip_is_strict_about_lengths(spark):
    left = spark.createDataFrame([("t", 3), ("t", 1), ("u", 5)], "k string, at long")
    right = spark.createDataFrame([("t", 30), ("t", 10), ("t", 40), ("v", 1)], "k string, at long")
    got = sorted(((r["k"], r["position"], r["at"], r["other"] and r["other"]["at"]) for r in positions.zipped(left, right, ["k"], ["at"]).collect()), key=str)
    assert got == sorted([("t", 0, 1, 10), ("t", 1, 3, 30), ("t", 2, None, 40), ("u", 0, 5, None), ("v", 0, None, 1)], key=str)
    assert sorted(tuple(r) for r in positions.lengths(left, right, ["k"]).collect()) == [("t", 2, 3), ("u", 1, 0), ("v", 0, 1)]
