"""Hot keys: one key holds a third of all rows.

The bucketed scans must give the single-window answer, the as-of scan the
brute-force answer, and the lines-to-orders join must be split by AQE's
skew handling instead of running the hot order key in one task.
"""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import asof_join, dedup_latest, forward_fill, scd2
from ledgerline.plans import claims_model as cm

N = 9000


@pytest.fixture(scope="module")
def hot_events(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(N):
        k = 0 if i % 3 == 0 else rnd.randint(1, 200)          # key 0 holds a third of the rows
        t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 60))
        v = None if rnd.random() < 0.4 else f"v{i}"
        rows.append((i, k, t, v))
    return spark.createDataFrame(rows, "id long, k int, ts timestamp_ntz, v string").repartition(6)


def _same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_hot_key_forward_fill_bucketed_equals_single_window(hot_events):
    a = forward_fill(hot_events, "k", "ts", ["v"], tiebreak=["id"])
    b = forward_fill(hot_events, "k", "ts", ["v"], tiebreak=["id"], split_by=F.to_date("ts"))
    assert _same(a, b)


def test_hot_key_scd2_bucketed_equals_single_window(hot_events):
    for timing in ("closes", "opens"):
        a = scd2(hot_events, "k", "ts", ["v"], tiebreak=["id"], attribute_timing=timing,
                 open_end="9999-12-31")
        b = scd2(hot_events, "k", "ts", ["v"], tiebreak=["id"], attribute_timing=timing,
                 open_end="9999-12-31", split_by=F.to_date("ts"))
        assert _same(a, b), timing


def test_hot_key_bucketed_window_is_partitioned_by_bucket(hot_events):
    b = forward_fill(hot_events, "k", "ts", ["v"], tiebreak=["id"], split_by=F.to_date("ts"))
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "__bucket" in plan and "Join" not in plan


def test_hot_key_asof_scan_equals_range_join(hot_events, spark):
    ev = hot_events.filter(F.col("id") % 5 != 0)
    prof = scd2(ev, "k", "ts", ["v"], tiebreak=["id"], attribute_timing="opens", open_end="9999-12-31",
                split_by=F.to_date("ts"))
    facts = hot_events.filter(F.col("id") % 5 == 0).select("id", "k", "ts")
    ref = asof_join(facts, prof, "k", "ts", ["v"], how="left", method="range", grain=["id"])
    for kw in ({}, {"split_by": "day"}):
        got = asof_join(facts, prof, "k", "ts", ["v"], how="left", **kw)
        assert _same(got.select("id", "v"), ref.select("id", "v")), kw


def test_hot_claim_key_dedup_reduces_map_side(spark):
    rows = [(1, 1, dt.date(2020, 1, 1) + dt.timedelta(days=i % 500), i) for i in range(6000)]
    rows += [(2 + i, 1, dt.date(2020, 1, 1), i) for i in range(12000)]
    df = spark.createDataFrame(rows, "o long, l int, load_date date, x int").repartition(8)
    out = dedup_latest(df, ["o", "l"], "load_date", tiebreak=["x"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    hot = out.filter(F.col("o") == 1).collect()
    assert len(hot) == 1 and hot[0].load_date == dt.date(2020, 1, 1) + dt.timedelta(days=499)
    assert out.count() == 12001


def test_hot_order_key_join_is_split_by_aqe(spark):
    """landing_claims on lines where one order holds a third of all lines."""
    n = 30000
    li = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 10).alias("l_orderkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 500).alias("l_partkey"), (F.col("id") % 20).alias("l_suppkey"),
        F.lit(3.0).alias("l_quantity"), F.lit(100.0).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
        F.lit("2001-03-04").cast("date").alias("l_shipdate"))
    orders = spark.range(n + 20).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 100).alias("o_custkey"),
        F.lit("2001-03-01").cast("date").alias("o_orderdate"))
    supplier = spark.range(20).select(F.col("id").alias("s_suppkey"), (F.col("id") % 5).alias("s_nationkey"))
    confs = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
             "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        df = cm.landing_claims(li, orders, supplier)
        rows = df.collect()                       # runs this plan; AQE then holds its final form
        draw = F.pmod(5 * F.col("l_orderkey") + 3 * F.col("l_linenumber"), F.lit(cm.DRAWS))
        assert len(rows) == n + li.filter(draw.isin(*cm.DEFECTS["resent"])).count()
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
