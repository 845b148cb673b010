"""Invariants of the whole pipeline on the sf0.01 driver tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from ledgerline.operators import assert_conserved, assert_gate, assert_unique, key_uniqueness
from ledgerline.plans import claims_model as cm
from ledgerline.plans.pipeline import ClaimsPipeline


@pytest.fixture(scope="module")
def pipe(spark):
    p = ClaimsPipeline(spark, SF_MID)
    # materialize the shared silver/gold layers once (written to the checkpoint folder)
    return p


def test_conservation(pipe):
    assert_conserved(pipe.latest_claims, {"valid": pipe.valid_claims, "rejected": pipe.rejected_claims})


def test_every_reason_planted_is_seen(pipe):
    reasons = {r.quarantine_reason for r in pipe.rejected_claims.select("quarantine_reason").distinct().collect()}
    assert reasons == set(cm.CLAIM_REASONS)


def test_no_overlapping_intervals(pipe):
    from ledgerline.operators import scd2_overlaps
    assert scd2_overlaps(pipe.intervals, "provider_id").count() == 0


def test_history_varies(pipe):
    from ledgerline.operators import history_variation
    hist = {r.n_distinct_values for r in history_variation(pipe.intervals, "provider_id", "specialty").collect()}
    assert max(hist) > 1


def test_gold_grain_unique_and_gate_passes(pipe):
    assert_unique(pipe.gold, "sk")
    assert key_uniqueness(pipe.gold, ["provider_id", "month"]).first().n_duplicates == 0
    assert_gate(pipe.panel())


def test_gold_rows_equal_grain_pairs(pipe):
    # every provider x month of the clean fact finds exactly one interval
    pairs = pipe.valid_claims.select("provider_id", "month").distinct().count()
    assert pipe.gold.count() == pairs


def test_planted_signal_found_exactly_at_quarter_grain(pipe):
    flagged = {r.provider_id for r in pipe.gold_quarter().filter("anomaly_flag = 1").select("provider_id")
               .distinct().collect()}
    assert flagged == set(cm.PLANTED_SUPPLIERS)


def test_regional_signal_surfaces_only_by_region(pipe):
    from ledgerline.operators import excess_by_segment
    g = pipe.gold
    # an explicit exclusion set (the concentrated cause), not only the month-grain flags
    known = g.sparkSession.createDataFrame([(s,) for s in cm.PLANTED_SUPPLIERS], "provider_id bigint")
    seg = excess_by_segment(g, "region_name", pipe.base_period(), pipe.recent_period(),
                            exclude=known, entity="provider_id")
    change = {r.region_name: r.idx_recent / r.idx_base - 1 for r in seg.collect()}
    planted_region = "AFRICA"   # nations 0 and 5 belong to region 0
    others = [v for k, v in change.items() if k != planted_region]
    assert change[planted_region] > 0.05 and all(v < change[planted_region] / 2 for v in others)


def test_rerun_is_idempotent(spark, tmp_path):
    from ledgerline.sources import write_table
    p = ClaimsPipeline(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "gold")
    write_table(p.gold, path, partition_by=["month"])
    write_table(p.gold, path, partition_by=["month"])
    assert spark.read.parquet(path).count() == p.gold.count()


def test_dedup_invariant_to_input_partitioning(spark):
    from ledgerline.operators import dedup_latest
    from ledgerline.plans.pipeline import CLAIM_KEY, CLAIM_TIEBREAK
    p = ClaimsPipeline(spark, "/root/testdata/sf0.001")
    base = p.conformed_claims
    a = dedup_latest(base, CLAIM_KEY, "load_date", CLAIM_TIEBREAK)
    b = dedup_latest(base.repartition(7, "paid"), CLAIM_KEY, "load_date", CLAIM_TIEBREAK)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_layer_reuse_equals_full_recompute(spark):
    from ledgerline.plans.pipeline import GOLD_COLS
    small = "/root/testdata/sf0.001"
    a = ClaimsPipeline(spark, small, fresh=("gold",)).gold.select(*GOLD_COLS)
    b = ClaimsPipeline(spark, small, reuse_layers=False, gold_base="recompute").gold.select(*GOLD_COLS)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_gold_invariant_to_shuffle_partition_count(spark):
    """Metamorphic: the whole gold build (dedup, cascade, bucketed SCD2, as-of
    scan, peer index) recomputed with another partition count is the same."""
    from ledgerline.plans.pipeline import GOLD_COLS
    small = "/root/testdata/sf0.001"
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            p = ClaimsPipeline(spark, small, reuse_layers=False, gold_base="recompute")
            out.append(sorted(map(repr, p.gold.select(*GOLD_COLS).collect())))
            out.append(sorted(map(repr, p.intervals.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[2] and out[1] == out[3] and len(out[0]) > 0
