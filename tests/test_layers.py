"""Stored layers, the gate and the checks: replaced inputs, failures that must raise, no cached frames."""

import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import (assert_conserved, assert_gate, assert_unique, asof_join, expect, ingest_bronze, ingest_check,
                                  parity, reconcile, top_outliers)
from ledgerline.plans.pipeline import ClaimsPipeline, _gt0
from ledgerline.plans.queries import QUERIES


def test_a_replaced_input_under_a_uri_is_read_again(spark, tmp_path):
    folder = tmp_path / "sf"
    shutil.copytree(SF_SMALL, folder)
    uri = f"file://{folder}"
    before = ClaimsPipeline(spark, uri).landing_claims.count()
    (folder / "lineitem.parquet").chmod(0o644)
    pq.write_table(pq.read_table(f"{SF_SMALL}/lineitem.parquet").slice(0, 1000), folder / "lineitem.parquet")
    spark.catalog.clearCache()
    assert ClaimsPipeline(spark, uri).landing_claims.count() < before
    with pytest.raises(Exception):
        ClaimsPipeline(spark, f"file://{tmp_path}/missing")._layer_key("gold")


def test_queries_leave_no_persisted_frame(spark):
    for name in ("gold_cost_by_supplier_month", "claims_with_versions", "excess_by_region"):
        QUERIES[name](spark, SF_SMALL).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_gate_names_every_blocking_metric(spark):
    bad = spark.createDataFrame([(f"m{i:03}", 1.0, "erro") for i in range(80)] + [("ok", 0.0, "ok")], "metric string, value double, severity string")
    with pytest.raises(AssertionError, match="80 rows.*m000.*m079"):
        assert_gate(bad)
    assert_gate(bad.where("severity = 'ok'"))


def test_duplicate_keys_raise(spark):
    with pytest.raises(AssertionError):
        assert_unique(spark.createDataFrame([(1,), (1,)], "k long"), "k")


def test_null_metric_is_an_error(spark):
    rows = spark.createDataFrame([(None,), (0,), (2,)], "v long").select(_gt0(F.col("v"), "alerta").alias("s")).collect()
    assert [r["s"] for r in rows] == ["erro", "ok", "alerta"]


def test_inner_asof_ignores_null_keys(spark):
    fact = spark.createDataFrame([(None, 5)] * 50 + [(1, 5)], "k long, at long")
    spans = spark.createDataFrame([(1, 0, 10, "a"), (None, 0, 10, "b")], "k long, valid_from long, valid_to long, v string")
    found = asof_join(fact, spans, "k", "at", cols=["v"], how="inner").collect()
    assert [(r["k"], r["v"]) for r in found] == [(1, "a")]


def test_bronze_check_sees_lost_changed_and_repeated_rows(spark):
    source = spark.createDataFrame([(1, "a", None), (2, None, "b"), (3, "c", "c")], "k long, x string, y string")
    bronze = ingest_bronze(source)
    seen = [ingest_check(source, b, "t").first() for b in (
        bronze, bronze.where("k < 3"), bronze.unionByName(bronze.where("k = 3")),
        bronze.withColumns({"x": F.col("y"), "y": F.col("x")}))]
    assert [(r["source_rows"], r["bronze_rows"], r["same_content"]) for r in seen] == [
        (3, 3, True), (3, 2, False), (3, 4, False), (3, 3, False)]
    empty = ingest_check(source.limit(0), bronze.limit(0), "t").first()
    assert (empty["source_rows"], empty["bronze_rows"], empty["same_content"]) == (0, 0, True)


def test_reconcile_by_group_sees_errors_that_cancel_out(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 1.0), (None, 4.0)], "m int, v double")
    right = spark.createDataFrame([(1, 5.0), (2, 10.0), (4, 1.0), (None, 4.0)], "m int, v double")
    assert reconcile(left, right, "v", "v").first()["severity"] == "ok"
    rows = {r["m"]: (float(r["value"]), r["severity"]) for r in reconcile(left, right, "v", "v", by=["m"]).collect()}
    assert rows == {1: (5.0, "erro"), 2: (5.0, "erro"), 3: (1.0, "erro"), 4: (1.0, "erro"), None: (0.0, "ok")}
    assert reconcile(left.limit(0), right.limit(0), "v", "v", by=["m"]).count() == 0
    assert reconcile(left, right.limit(0), "v", "v").first()["severity"] == "erro"  # an empty gold is no agreement


def test_lost_rows_raise(spark):
    total = spark.range(10)
    assert_conserved(total, {"a": total.where("id < 4"), "b": total.where("id >= 4")})
    with pytest.raises(AssertionError):
        assert_conserved(total, {"a": total.where("id < 4"), "b": total.where("id > 4")})


def test_parity_counts_keys_with_other_values(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, None, 2), (3, "z", 3)], "k long, v string, w int")
    b = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (4, "z", 3)], "k long, v string, w int")
    r = parity(a, b, ["k"], "d", values=["v", "w"]).first()
    assert (r["rows_a"], r["rows_b"], r["only_a"], r["only_b"], r["n_differing"]) == (3, 3, 1, 1, 1)
    assert parity(a, a, ["k"], "d", values=["v", "w"]).first()["n_differing"] == 0


def test_no_expectations_keep_all_rows_and_count_nothing(spark):
    kept, metrics = expect(spark.range(3), {})
    assert kept.count() == 3 and metrics.count() == 0


def test_top_outliers_cut_with_ties(spark):
    rows = spark.createDataFrame([(i, 2.0 if i < 6 else 1.0) for i in range(10)], "k long, score double")
    found = top_outliers(rows, 4, "score", ["k"], cols=["k", "score"]).collect()
    assert [r["k"] for r in found] == [0, 1, 2, 3]


def test_landing_and_bronze_are_written_once_for_both_delete_orders(spark):
    keys = [{ClaimsPipeline(spark, SF_SMALL, deleted=d)._layer_key(n) for d in ("before_dedup", "after_dedup")}
            for n in ("landing_claims", "bronze_claims", "latest_claims")]
    assert [len(k) for k in keys] == [1, 1, 2]
