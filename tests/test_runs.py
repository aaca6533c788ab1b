"""Runs and looks back over buckets of time against plain loops."""

import random

import pytest

from parley.operators import quality, runs


def _rows(seed, n):
    r, at, out = random.Random(seed), 0, []
    for i in range(n):
        at += r.choice([1, 5, 40, 400])
        out.append((r.choice("aaaab"), at, at + r.randint(1, 30), r.choice([True, True, False, None]), i))
    return out


@pytest.mark.parametrize("bucket", [7, 100, 10_000_000])
def test_runs_previous_and_sums_equal_loops(spark, bucket):
    rows = _rows(bucket, 600)
    df = spark.createDataFrame(rows, "k string, start_ms long, end_ms long, label boolean, id long").repartition(5)
    told = runs.with_previous(df, ["k"], {"p_end": "end_ms", "p_id": "id"}, bucket)
    got = {r["id"]: (r["p_end"], r["p_id"]) for r in told.collect()}
    sums = {r["id"]: r["s"] for r in runs.with_running(df, ["k"], df["id"], "s", bucket).collect()}
    numbers = {r["id"]: r["run"] for r in runs.with_runs(df, ["k"], "label", "run", bucket).collect()}
    for k in "ab":
        total, run, before = 0, 0, None
        for row in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:3]):
            total += row[4]
            run += before is None or before[3] is not row[3]
            assert (got[row[4]], sums[row[4]], numbers[row[4]]) == ((before[2], before[4]) if before else (None, None), total, run)
            before = row


def test_short_bad_runs_between_good_ones_count_as_good(spark):
    r, at, rows = random.Random(3), 0, []
    for i in range(400):
        at += r.randint(0, 2_000)
        rows.append(("x" if i % 5 else "y", at, at + r.randint(1, 1_500), r.random() < 0.7))
        at = rows[-1][2]
    df = spark.createDataFrame(rows, "k string, start_ms long, end_ms long, is_good boolean")
    got = sorted(map(tuple, quality.absorb(df, ["k"]).collect()))
    want = []
    for k in "xy":
        own = sorted(x for x in rows if x[0] == k)
        parts = []
        for x in own:
            if not parts or parts[-1][0][3] != x[3]:
                parts.append([])
            parts[-1].append(x)
        for n, p in enumerate(parts):
            short = 0 < n < len(parts) - 1 and not p[0][3] and max(x[2] for x in p) - p[0][1] < 3_000
            want += [(*x[:3], x[3] or short) for x in p]
    assert got == sorted(want)
