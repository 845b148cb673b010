"""Overlapping intervals, buckets measured from the rows and several histories in one timeline, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import History, Measured, asof_join, asof_timeline, disjoint_intervals, forward_fill, measured_buckets, scd2

DAY = dt.date(2020, 1, 1)


def overlapping(spark, seed, n=400, keys=6, hot=0.0, unique=False):
    rng, rows = random.Random(seed), []
    for i in range(n):
        k = 0 if rng.random() < hot else rng.randrange(keys)
        a = rng.randrange(300)
        rows.append((k, DAY + dt.timedelta(a), DAY + dt.timedelta(a + rng.choice([0, 1, 3, 10, 80, 400]) - (rng.random() < 0.05)), f"v{i}"))
    if unique:                                 # the range join leaves ties of both bounds open
        rows = list({r[:3]: r for r in rows}.values())
    rows += [(1, None, DAY, "x"), (1, DAY, None, "y"), (None, DAY, DAY + dt.timedelta(9), "z")]
    return rows, spark.createDataFrame(rows, "k int, a date, b date, v string").repartition(5)


def winner(rows, k, t):
    hits = [(a, b, v) for kk, a, b, v in rows if kk == k and k is not None and a and b and a <= t < b]
    return max(hits)[2] if hits else None


@pytest.mark.parametrize("parts", [None, 4])
@pytest.mark.parametrize("seed", [1, 2])
def test_disjoint_intervals(spark, seed, parts):
    rows, df = overlapping(spark, seed, hot=0.5 if parts else 0.0)
    pieces = disjoint_intervals(df, "k", "a", "b", parts=parts)
    assert pieces.columns == df.columns
    found = pieces.collect()
    by_key = {}
    for r in found:
        by_key.setdefault(r["k"], []).append((r["a"], r["b"], r["v"]))
    for k, own in by_key.items():
        own.sort()
        assert all(x[1] <= y[0] for x, y in zip(own, own[1:])) and all(a < b for a, b, _ in own)
    for k in range(6):
        for d in range(-2, 720):
            t = DAY + dt.timedelta(d)
            hits = [v for a, b, v in by_key.get(k, ()) if a <= t < b]
            assert hits == ([w] if (w := winner(rows, k, t)) else []), (k, t)
    if parts:                                  # a hot key's sweep is spread over its buckets
        assert disjoint_intervals(df, "k", "a", "b").count() <= len(found)


@pytest.mark.parametrize("split_by", [None, "month", Measured(4)])
def test_sweep_equals_range(spark, split_by):
    rows, df = overlapping(spark, 5, hot=0.4, unique=True)
    rng = random.Random(9)
    facts = spark.createDataFrame([(i, rng.choice([0, 0, 1, 2, 3, 9, None]), DAY + dt.timedelta(rng.randrange(-5, 500))) for i in range(500)],
                                  "id int, k int, t date")
    kw = dict(key="k", at="t", cols=["v"], start="a", end="b", how="left", keep_bounds=True)
    got = asof_join(facts, df, method="sweep", split_by=split_by, **kw)
    want = asof_join(facts, df, method="range", grain=["id"], **kw)
    assert sorted(map(str, got.select("id", "k", "t", "a", "b", "v").collect())) == sorted(
        map(str, want.select("id", "k", "t", "a", "b", "v").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert asof_join(facts, df, method="sweep", **{**kw, "how": "inner"}).count() == want.where("v IS NOT NULL").count()


def test_empty_intervals_and_facts(spark):
    _, df = overlapping(spark, 1)
    assert disjoint_intervals(df.limit(0), "k", "a", "b").count() == 0
    facts = spark.createDataFrame([(1, 1, DAY)], "id int, k int, t date")
    assert asof_join(facts, df.limit(0), "k", "t", ["v"], "a", "b", how="left", method="sweep").collect()[0]["v"] is None
    assert asof_join(facts.limit(0), df, "k", "t", ["v"], "a", "b", method="sweep").count() == 0


def hot_rows(spark, n=12_000):
    """A third of all rows under one key at one timestamp, a third under another key over time, the rest spread."""
    i = F.col("id")
    return spark.range(n).select(
        i, F.when(i % 3 == 0, F.lit(-1)).when(i % 3 == 1, F.lit(-2)).otherwise(i % 400).alias("k"),
        F.when(i % 3 == 0, F.lit(1_000)).otherwise(F.floor(F.sqrt(i.cast("double")) * 50)).cast("long").alias("t"),
        F.when(i % 5 < 2, i).alias("v")).repartition(6)


def test_measured_buckets_are_even_and_ordered(spark):
    rows, parts = hot_rows(spark), 16
    n = rows.count()
    placed = measured_buckets(rows, ["k"], ["t", "id"], parts)
    sizes = [r["count"] for r in placed.groupBy("k", "__bucket").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / parts
    # never decreasing in (t, id): the largest of a bucket is below the smallest of the next
    spans = placed.groupBy("k", "__bucket").agg(F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi"))
    last = {}
    for r in spans.orderBy("k", "__bucket").collect():
        if r["k"] in last:
            assert last[r["k"]] < tuple(r["lo"])
        last[r["k"]] = tuple(r["hi"])


def test_equal_rows_are_cut_by_hash(spark):
    rows = spark.range(3_000).select(F.lit(1).alias("k"), F.lit(5).alias("t"), "id")
    sizes = [r["count"] for r in measured_buckets(rows, ["k"], ["t"], 8).groupBy("__bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 3_000 / 8


def test_null_times_and_keys(spark):
    rows = spark.range(2_000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).alias("k"), F.when(F.col("id") % 4 < 2, F.col("id")).alias("t"), "id",
                                     F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"))
    a = forward_fill(rows, "k", "t", ["v"], tiebreak=["id"]).collect()
    b = forward_fill(rows, "k", "t", ["v"], tiebreak=["id"], split_by=Measured(8)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_scans_with_measured_buckets(spark):
    rows = hot_rows(spark, 6_000)
    for kw in ({}, {"split_by": Measured(16)}):
        filled = sorted(map(tuple, forward_fill(rows, "k", "t", ["v"], tiebreak=["id"], **kw).select("id", "k", "t", "v").collect()))
        spans = sorted(map(str, scd2(rows.where("k < 0"), "k", "t", ["v"], tiebreak=["id"], passthrough=["id"], **kw).collect()))
        if not kw:
            want = filled, spans
    assert (filled, spans) == want


def test_timeline_of_two_histories(spark):
    rng = random.Random(4)
    prices = [(rng.randrange(4), rng.randrange(60), i, rng.choice([None, i])) for i in range(120)]
    states = [(rng.randrange(4), rng.randrange(60), rng.choice(["a", "b", None])) for _ in range(40)] + [(None, 3, "z"), (1, None, "z")]
    states = list({s[:2]: s for s in states}.values())
    facts = [(i, rng.choice([0, 1, 2, 3, 8, None]), rng.randrange(-3, 70)) for i in range(200)] + [(900, 1, None)]
    f = spark.createDataFrame(facts, "id int, k int, at int")
    hist = [History(spark.createDataFrame(prices, "k int, t int, seq int, price int"), "t", ["price"], ["seq"]),
            History(spark.createDataFrame(states, "k int, since int, state string"), "since", ["state"])]
    want = set()
    for i, k, at in facts:
        known = [(t, s, v) for kk, t, s, v in prices if kk == k and v is not None and k is not None and at is not None and t <= at]
        kept = [(t, v) for kk, t, v in states if kk == k and v is not None and k is not None and t is not None and at is not None and t <= at]
        want.add((i, k, at, max(known)[2] if known else None, max(kept)[1] if kept else None))
    for split in (None, lambda t: F.floor(t / 10), Measured(4)):
        assert {tuple(r) for r in asof_timeline(f, hist, "k", "at", split_by=split).collect()} == want
    with pytest.raises(ValueError):
        asof_timeline(f.withColumn("state", F.lit(1)), hist, "k", "at")
