"""Composite operators (the W-items): DataFrame -> DataFrame functions."""

from ledgerline.operators.asof import History, asof_join, asof_timeline, disjoint_intervals
from ledgerline.operators.buckets import Measured, measured_buckets
from ledgerline.operators.conform import conform, conform_dimension, dedup_latest, multi_version
from ledgerline.operators.history import (event_timeline, forward_fill, history_variation, scd2,
                                          scd2_overlaps)
from ledgerline.operators.ingest import ingest_bronze, ingest_check
from ledgerline.operators.integrity import (assert_conserved, conservation, conservation_tagged, fk_profile, quarantine,
                                            quarantine_summary, row_counts, split_orphans,
                                            split_tagged, tag_first_failing)
from ledgerline.operators.measures import (assert_key, assert_unique, key_integrity, key_uniqueness, peer_index, ratio_measures,
                                           rollup_grain, surrogate_key, surrogate_key_pair)
from ledgerline.operators.publish import GateBlocked, Publication, write_audit_publish
from ledgerline.operators.quality import (Metric, Reconciliation, assert_gate, counted, dq_panel, expect, expectation_rows,
                                          null_profile, observed_expectations, ordered_panel, parity,
                                          profile, quality_gate, reconcile)
from ledgerline.operators.sampling import hash_bucket, mod_sample, stable_sample
from ledgerline.operators.variance import (decompose_price_volume, drill_down, excess_by_entity,
                                           excess_by_segment, flagged_entities, index_variation,
                                           post_event_activity, post_event_difference, segment_cost, top_outliers, trend)

__all__ = [n for n in dir() if not n.startswith("_")]
