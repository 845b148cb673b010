"""Write, audit, publish; versions, pins and retention; layers shared between applications; months replaced in place."""

import json
import os
import shutil
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import GateBlocked, assert_key, key_integrity, surrogate_key_pair, write_audit_publish
from ledgerline.plans import pipeline as pl
from ledgerline.plans.declared import DeclaredPipeline
from ledgerline.plans.pipeline import ClaimsPipeline
from ledgerline.sources import Conflict, VersionStore, replace_partitions, write_table

ROWS = "month int, k long, v double"


class Clock:
    def __init__(self):
        self.now = 1_000_000.0

    def __call__(self):
        return self.now


@pytest.fixture()
def store(spark, tmp_path):
    return VersionStore(spark, f"file://{tmp_path}/store", Clock())


def rows(spark, *values):
    return spark.createDataFrame([(200001 + i, i, float(v)) for i, v in enumerate(values)], ROWS)


def audit(frames):
    """Blocks negative and missing values."""
    return frames["gold"].agg(F.count_if(F.col("v") < 0).alias("bad"), F.count("*").alias("n")).select(F.inline(F.array(
        F.struct(F.lit("negative").alias("metric"), F.col("bad").cast("string").alias("value"),
                 F.when(F.col("bad") > 0, "erro").otherwise("ok").alias("severity")),
        F.struct(F.lit("rows").alias("metric"), F.col("n").cast("string").alias("value"),
                 F.when(F.col("n") == 0, "erro").otherwise("informativo").alias("severity")))))


def values(df):
    return sorted(r["v"] for r in df.collect())


def test_a_failed_gate_leaves_readers_on_the_last_release(spark, store):
    first = store.stage("gold", "a", lambda: rows(spark, 1, 2))
    assert write_audit_publish(store, [first], audit).release == 1
    for name, bad in (("negative", rows(spark, 1, -2)), ("rows", rows(spark).limit(0))):
        staged = store.stage("gold", name, lambda: bad)
        with pytest.raises(GateBlocked, match=name) as caught:
            write_audit_publish(store, [staged], audit)
        assert set(caught.value.metrics) == {name}
        assert store.latest() == 1 and values(store.read(store.published("gold"))) == [1, 2]
    good = store.stage("gold", "b", lambda: rows(spark, 3))
    assert write_audit_publish(store, [good], audit).release == 2
    assert values(store.read(store.published("gold"))) == [3]
    assert values(store.read(store.published("gold", 1))) == [1, 2]       # a pinned release is still what it was


def test_an_audit_without_verdict_blocks(spark, store):
    staged = store.stage("gold", "a", lambda: rows(spark, 1))
    for panel in (lambda f: audit(f).limit(0), lambda f: audit(f).withColumn("severity", F.lit(None).cast("string"))):
        with pytest.raises(GateBlocked):
            write_audit_publish(store, [staged], panel)
    assert store.release() == {}


def test_changed_files_block(spark, store, tmp_path):
    staged = store.stage("gold", "a", lambda: rows(spark, 1, 2))
    folder = store.path(staged).removeprefix("file://")
    os.remove(next(os.path.join(folder, n) for n in os.listdir(folder) if n.endswith(".parquet")))
    with pytest.raises(GateBlocked, match="gold_files"):
        write_audit_publish(store, [staged], audit)


def test_layers_of_a_release_change_together(spark, store):
    fact, gold = (store.stage(n, "a", lambda: rows(spark, 1)) for n in ("fact", "gold"))
    store.publish([fact, gold])
    gold2 = store.stage("gold", "b", lambda: rows(spark, 2))
    store.publish([gold2])
    assert store.release() == {"fact": fact.version, "gold": gold2.version}
    assert store.release(1) == {"fact": fact.version, "gold": gold.version}


def test_of_two_publishers_one_looks_again(spark, store):
    seen = store.latest()
    a, b = store.stage("gold", "a", lambda: rows(spark, 1)), store.stage("gold", "b", lambda: rows(spark, 2))
    store.publish([a], based_on=seen)
    with pytest.raises(Conflict):
        store.publish([b], based_on=seen)
    # at the file level, too: one of many wins each number
    wins = []

    def race(i):
        try:
            store.files.create(f"{store.root}/releases/{9:012d}.json", json.dumps({"gold": str(i)}))
            wins.append(i)
        except Conflict:
            pass

    threads = [threading.Thread(target=race, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert wins and store.release(9)["gold"] in map(str, wins)
    assert not [n for n in store.files.names(f"{store.root}/releases") if n.startswith(".tmp")]


def test_equal_fingerprints_are_built_once(spark, store):
    calls = []

    def build():
        calls.append(1)
        return rows(spark, 1)

    assert store.stage("gold", "a", build) == store.stage("gold", "a", build)
    assert len(calls) == 1 and len(store.versions("gold")) == 1


def test_a_version_that_lost_files_is_built_again(spark, store):
    v = store.stage("gold", "a", lambda: rows(spark, 1))
    shutil.rmtree(store.path(v).removeprefix("file://"))
    again = store.stage("gold", "a", lambda: rows(spark, 1))
    assert again != v and values(store.read(again)) == [1] and store.stage("gold", "a", lambda: rows(spark, 9)) == again


def test_columns_and_types_of_a_partitioned_version(spark, store):
    df = spark.createDataFrame([(1, 200001, None), (2, 200002, "x")], "k long, month int, v string").withColumn("d", F.lit("2.50").cast("decimal(18,2)"))
    v = store.stage("fact", "a", lambda: df, ["month"])
    assert store.read(v).schema == df.schema and sorted(map(tuple, store.read(v).collect())) == sorted(map(tuple, df.collect()))


def test_a_bucketed_version_needs_no_exchange(spark, store):
    df = spark.range(500).select((F.col("id") % 40).alias("k"), (F.col("id") % 7).cast("int").alias("l"), "id")
    v = store.stage("fact", "a", lambda: df, bucket_by=["k", "l"], buckets=6)
    spark.sql(f"DROP TABLE {store._table('fact', v.version)}")          # as another application finds it
    read = store.read(v)
    grouped = read.groupBy("k", "l").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, grouped.collect())) == sorted(map(tuple, df.groupBy("k", "l").count().collect()))
    assert store.intact(v) and len([f for f in v.files if f.endswith(".parquet")]) <= 6


def test_claims_are_deduplicated_and_counted_in_place(spark):
    """One exchange fewer in both plans than over the same rows stored without buckets."""
    from ledgerline.operators import multi_version
    p = ClaimsPipeline(spark, SF_SMALL, fresh=("latest_claims",))
    flat = ClaimsPipeline(spark, SF_SMALL, fresh=("latest_claims", "bronze_claims"))

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(claim_order")

    def versions(q):
        return multi_version(q.conformed_claims.select("claim_order", "claim_line", "load_date", "paid"), ["claim_order", "claim_line"], 2)

    assert (exchanges(p.latest_claims), exchanges(flat.latest_claims)) == (0, 1)
    assert exchanges(versions(p)) < exchanges(versions(flat))
    assert sorted(map(tuple, p.latest_claims.collect())) == sorted(map(tuple, flat.latest_claims.collect()))
    assert sorted(map(tuple, versions(p).collect())) == sorted(map(tuple, versions(flat).collect()))


def test_claims_are_dealt_by_key_once(spark, tmp_path):
    """The lines move by claim key as source columns; bronze copies landing file by file and nothing stores the latest claims."""
    import glob
    folder = tmp_path / "sf"
    shutil.copytree(SF_SMALL, folder)
    p = ClaimsPipeline(spark, f"file://{folder}")
    bronze = p.bronze("claims")
    copied = p._claims_by_key()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in copied
    dealt = p._landed()._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in dealt and dealt.index("AS auth_no") < dealt.index("RepartitionByExpression")
    flat = ClaimsPipeline(spark, f"file://{folder}", reuse_layers=False)
    assert sorted(map(str, bronze.drop("_ingested_at").collect())) == sorted(map(str, flat.landing_claims.collect()))
    assert p.claims_checked.count() > 0 and "latest_claims" not in p.store.files.names(f"{p.store.root}/data")
    stored = glob.glob(f"{p.store.path(p.staged('bronze_claims', None)).removeprefix('file:')}/*.parquet")
    buckets = [f.rsplit("_", 1)[1].split(".")[0] for f in stored]
    assert len(buckets) == len(set(buckets)) and pq.ParquetFile(stored[0]).metadata.row_group(0).column(0).compression == "ZSTD"


def test_a_builder_that_dealt_its_rows_is_not_dealt_again(spark, store):
    df = spark.range(500).select((F.col("id") % 40).alias("k"), "id")
    v = store.stage("fact", "a", lambda: df.repartition(6, "k"), bucket_by=["k"], buckets=6, dealt=True)
    files = [f for f in v.files if f.endswith(".parquet")]
    assert len(files) <= 6 and sorted(map(tuple, store.read(v).collect())) == sorted(map(tuple, df.collect()))
    grouped = store.read(v).groupBy("k").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString() and grouped.count() == 40
    plain = store.read(v, by_bucket=False).groupBy("k").count()
    assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString() and plain.count() == 40


def test_retention(spark, store):
    clock = store.clock
    old = store.stage("gold", "a", lambda: rows(spark, 1))
    clock.now += 10
    held = store.stage("gold", "b", lambda: rows(spark, 2))
    token = store.pin([held], seconds=1_000)
    clock.now += 10
    now = store.stage("gold", "c", lambda: rows(spark, 3))
    store.publish([now])
    os.makedirs(f"{store.root.removeprefix('file://')}/data/gold/000000000000001-unfinished")    # a writer that died
    assert store.sweep(grace=10_000) == [("gold", "000000000000001-unfinished")]
    clock.now += 100
    assert store.sweep(grace=60) == [("gold", old.version)]
    assert values(store.read(held)) == [2]
    store.unpin(token)
    assert store.sweep(grace=60) == [("gold", held.version)]
    clock.now += 10_000
    assert store.sweep(grace=60) == [] and values(store.read(store.published("gold"))) == [3]
    lapsed = store.stage("gold", "d", lambda: rows(spark, 4))
    store.pin([lapsed], seconds=5)
    clock.now += 100
    assert store.sweep(grace=60) == [("gold", lapsed.version)] and store.files.names(f"{store.root}/pins") == []


# ----------------------------------------------------------------- the claims build
def test_a_corrupted_gold_is_not_published(spark, tmp_path, monkeypatch):
    folder = tmp_path / "sf"
    shutil.copytree(SF_SMALL, folder)
    p = ClaimsPipeline(spark, f"file://{folder}")
    good = p.publish()
    n, release = good.count(), p.store.latest()
    whole = ClaimsPipeline._gold
    for damage in (lambda g: g.withColumn("cost_total", -F.col("cost_total")), lambda g: g.limit(0), lambda g: g.unionByName(g)):
        monkeypatch.setattr(ClaimsPipeline, "_gold", lambda self, damage=damage: damage(whole(self)))
        monkeypatch.setattr(pl, "_code_fingerprint", lambda damage=damage: str(id(damage)))
        again = ClaimsPipeline(spark, f"file://{folder}")
        with pytest.raises(GateBlocked):
            again.publish()
        assert again.store.latest() == release
        assert again.store.read(again.store.published("gold")).count() == n


def test_applications_share_layers_and_replaced_inputs_go(spark, tmp_path, monkeypatch):
    folder = tmp_path / "sf"
    shutil.copytree(SF_SMALL, folder)
    uri = f"file://{folder}"
    ClaimsPipeline(spark, uri).gold.count()
    # another application: nothing remembered in this process
    monkeypatch.setattr(pl, "_STAGED", {})
    other = ClaimsPipeline(spark, uri)
    before = {n: [v.version for v in other.store.versions(n)] for n in pl.LAYER_TABLES}
    other.gold.count()
    assert {n: [v.version for v in other.store.versions(n)] for n in pl.LAYER_TABLES} == before
    # the input is replaced: new versions; the older ones go once no pin holds them
    (folder / "lineitem.parquet").chmod(0o644)
    pq.write_table(pq.read_table(f"{SF_SMALL}/lineitem.parquet").slice(0, 2000), folder / "lineitem.parquet")
    spark.catalog.clearCache()
    newer = ClaimsPipeline(spark, uri)
    newer.gold.count()
    assert newer.retire(grace=0) == []                     # still pinned
    for n in newer.store.files.names(f"{newer.store.root}/pins"):
        newer.store.unpin(n.removesuffix(".json"))
    gone = newer.retire(grace=0)
    assert {n for n, _ in gone} >= {"gold", "landing_claims", "claims_checked"}
    left = {n: [v.version for v in newer.store.versions(n)] for n in ("gold", "landing_claims")}
    assert all(len(v) == 1 and v[0] not in before[n] for n, v in left.items())
    assert newer.gold.count() > 0


def test_period_filters_prune_months(spark):
    p = ClaimsPipeline(spark, SF_SMALL)
    from ledgerline.operators import excess_by_entity
    one = excess_by_entity(p.gold, "provider_id", ["region_name"], F.expr("month BETWEEN 200001 AND 200003"), F.expr("month = 200106"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan and "200106" in plan
    lazy = ClaimsPipeline(spark, SF_SMALL, gold_base="lazy")      # not written in between, so the plan shows the scans
    for df in (lazy.gold_of(F.expr("month = 200106")), p.claims_checked.where("month >= 200101")):
        assert "PartitionFilters: [isnotnull(month" in df._jdf.queryExecution().executedPlan().toString()
    read = p.gold.where("month = 200106").select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("month=200106" in r["f"] for r in read) and len(p.gold.inputFiles()) > 50


def test_one_month_is_rewritten_alone(spark, tmp_path):
    p, path = ClaimsPipeline(spark, SF_SMALL), str(tmp_path / "gold")
    write_table(p.gold.where("month <> 200106 OR provider_id % 3 = 0"), path, partition_by=["month"])
    files = {f: os.stat(f).st_mtime_ns for f in (os.path.join(d, n) for d, _, ns in os.walk(path) for n in ns if n.endswith(".parquet"))}
    table = p.refreshed(path, F.expr("month = 200106"))
    after = {f: os.stat(f).st_mtime_ns for f in (os.path.join(d, n) for d, _, ns in os.walk(path) for n in ns if n.endswith(".parquet"))}
    assert {f: t for f, t in files.items() if "month=200106" not in f} == {f: t for f, t in after.items() if "month=200106" not in f}
    assert {f for f in files if "month=200106" in f}.isdisjoint(after)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, p.gold.collect()))


def test_replaced_partitions_are_few_files(spark, tmp_path):
    df = spark.range(4_000).select((F.col("id") % 3).cast("int").alias("m"), "id").repartition(16)
    path = str(tmp_path / "t")
    replace_partitions(df, path, ["m"])
    replace_partitions(df.where("m = 1 AND id < 100"), path, ["m"])
    assert [r["count"] for r in spark.read.parquet(path).groupBy("m").count().orderBy("m").collect()] == [1334, 33, 1333]
    assert all(len([n for n in ns if n.endswith(".parquet")]) == 1 for d, _, ns in os.walk(path) if "m=" in d)


# ----------------------------------------------------------------- keys and counters
def test_collision_is_told_from_duplicate(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, None)], "key long, grain string")
    r = key_integrity(df, "key", ["grain"]).first().asDict()
    assert r == {"n_rows": 5, "n_grains": 4, "n_keys": 3, "n_duplicate_grains": 1, "n_collisions": 1}
    with pytest.raises(AssertionError, match="collision"):
        assert_key(df, "key", ["grain"])
    with pytest.raises(AssertionError, match="repeated"):
        assert_key(df.where("key > 1"), "key", ["grain"])
    assert_key(df.where("key = 3"), "key", ["grain"])
    assert key_integrity(df.limit(0), "key", ["grain"]).first()["n_rows"] == 0


def test_key_pair_tells_grains_apart(spark):
    grains = [("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc"), ("abc", None), ("-", "abc"), ("1:a", "b"), ("1", ":ab")]
    rows = surrogate_key_pair(spark.createDataFrame(grains, "a string, b string"), ["a", "b"]).collect()
    assert len({(r["sk_hi"], r["sk_lo"]) for r in rows}) == len(grains)
    assert min(r["sk_hi"] for r in rows) < 0 < max(r["sk_hi"] for r in rows)      # whole signed range


def test_counters_come_from_the_write(spark, tmp_path, monkeypatch):
    """The counters equal an aggregate over the dataset, and reading them scans only the stored counters."""
    monkeypatch.setattr(pl, "_code_fingerprint", lambda: "counters from the write")
    p = DeclaredPipeline(spark, SF_SMALL)
    metrics = p.metrics()
    from ledgerline.operators import expect
    from ledgerline.plans.declared import EXPECTATIONS, _rules
    stored = {(r["dataset"], r["expectation"]): (r["n_passed"], r["n_failed"]) for r in metrics.collect()}
    for name in EXPECTATIONS:
        if EXPECTATIONS[name]:
            for r in expect(p.declared(name), _rules(name))[1].collect():
                assert stored[name, r["expectation"]] == (r["n_passed"], r["n_failed"])
    assert all("_counts/" in f for f in metrics.inputFiles())
