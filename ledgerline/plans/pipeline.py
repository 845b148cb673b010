"""The medallion pipeline over the claims overlay, composed from the operators.

landing (derived from driver tables) -> bronze -> silver (conformed dims,
deduplicated fact, quarantine, SCD2 intervals) -> gold (provider x month)
-> quality panel -> variance analysis. Every attribute is a lazy
DataFrame over its upstream layers; the first access to a layer table of
:data:`LAYER_TABLES` writes it (and what it reads) to the shared folder.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Mapping
from functools import cache, cached_property
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import decode, month_start, quarter_int
from ledgerline.operators import (
    Metric, Reconciliation, asof_join, conform, conform_dimension, dedup_latest, dq_panel, event_timeline,
    ingest_bronze, peer_index, ratio_measures, rollup_grain, scd2,
    split_orphans, split_tagged, surrogate_key, tag_first_failing, write_audit_publish,
)
from ledgerline.plans import claims_model as cm
from ledgerline.session import checkpoint_dir
from ledgerline.sources.tables import materialize, read_table, replace_partitions
from ledgerline.sources.versions import Version, VersionStore, fingerprint_of

CLAIM_KEY = ["claim_order", "claim_line"]
CLAIM_TYPES = {
    "claim_order": "bigint", "claim_line": "int", "provider_id": "bigint", "member_id": "bigint",
    "facility_id": "bigint", "procedure_id": "bigint", "service_ts": "date", "presented_ts": "date",
    "month": "int", "qty": "int", "ref_amount": "decimal(18,2)", "billed": "decimal(18,2)",
    "disallowed": "decimal(18,2)", "paid": "decimal(18,2)", "auth_no": "string",
    "post_termination": "int",
}
CLAIM_RENAME = {"service_ts": "service_date", "presented_ts": "presented_date"}
CLAIM_COLS = [CLAIM_RENAME.get(c, c) for c in CLAIM_TYPES]
CLAIM_TIEBREAK = [c for c in CLAIM_COLS if c not in CLAIM_KEY]

PROVIDER_TYPES = {
    "provider_id": "bigint", "provider_name": "string", "facility_id": "bigint", "status": "int",
    "specialty": "int", "provider_type": "int", "unit": "int", "credential_date": "date",
    "termination_date": "date", "termination_reason": "int", "capacity": "int",
}
FACILITY_TYPES = {
    "facility_id": "bigint", "facility_name": "string", "facility_code": "string",
    "region_id": "int", "region_name": "string",
}
MEMBER_TYPES = {"member_id": "bigint", "member_name": "string", "nation_id": "bigint",
                "segment": "string", "age_band": "int"}
PROCEDURE_TYPES = {"procedure_id": "bigint", "procedure_name": "string", "group_code": "int",
                   "group_name": "string", "high_complexity": "int"}
AUDIT_COLS = ["provider_id", "facility_id", "status", "specialty", "unit", "capacity",
              "credential_date", "termination_date", "termination_reason"]
FILL_COLS = ["facility_id", "status", "specialty", "unit", "capacity", "credential_date"]
ANY_OF = ["status", "specialty", "unit", "credential_date"]

GOLD_COLS = [
    "provider_id", "provider_name", "month", "month_start", "specialty", "specialty_name",
    "provider_type", "status", "facility_id", "facility_name", "region_name",
    "n_claims", "n_members", "n_post_termination", "capacity", "capacity_use_pct",
    "cost_total", "billed_total", "disallowed_total", "ref_total",
    "mean_cost_claim", "mean_cost_member", "pct_disallowed", "cost_index", "peer_index", "anomaly_flag",
]


def _gt0(v: Column, hit: str) -> Column:
    """NULL is an error: an unknown count proves nothing."""
    return F.when(v.isNull(), F.lit("erro")).when(v > 0, F.lit(hit)).otherwise(F.lit("ok"))


# Layers written as tables (like the reference's CREATE OR REPLACE TABLE per
# module) and reused by downstream modules and by other applications.
LAYER_TABLES = frozenset({
    "landing_facility", "landing_provider", "landing_audit", "landing_member", "landing_procedure",
    "landing_claims", "bronze_facility", "bronze_provider", "bronze_audit", "bronze_member", "bronze_procedure",
    "bronze_claims", "facility_clean", "provider_clean", "dim_provider", "dim_member", "dim_procedure",
    "claims_checked", "intervals", "gold",
})
# Facts that the period filters of W26-W31 read: a folder per month, so other months are not opened.
PARTITIONED = {"claims_checked": ("month",), "gold": ("month",)}
# The claims by their key: versions are counted, deduplicated and compared on it without an exchange.
# Landing deals its rows by the key once; bronze copies them file by file.
# The latest claims are a scan of bronze in place, so they are not stored once more.
BUCKETED = {"landing_claims": tuple(CLAIM_KEY), "bronze_claims": tuple(CLAIM_KEY)}
DEALT = frozenset(BUCKETED)
PIN_SECONDS = 24 * 3600.0       # how long a pipeline keeps the versions that it reads
_STAGED: dict[tuple[str, str, str], Version] = {}


@cache
def _code_fingerprint() -> str:
    """Digest of the modules that define the layers: other code builds other versions."""
    folder = Path(__file__).parent.parent
    texts = [p.read_bytes() for part in ("functions", "operators", "plans", "sources") for p in sorted((folder / part).glob("*.py"))]
    return hashlib.sha256(b"\0".join(texts)).hexdigest()


def _input_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Paths, sizes and modification times of the input files, listed through
    the Hadoop file system of the path (local, hdfs, s3a, ...); a folder that
    cannot be listed or holds no file is an error, never a stale answer."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    if not found:
        raise FileNotFoundError(f"no input files under {sf_dir}")
    return hashlib.sha1("\n".join(sorted(found)).encode()).hexdigest()[:16]


class ClaimsPipeline:
    """All layers of the claims build for one folder of driver tables.

    With ``reuse_layers`` (default) the layer tables in :data:`LAYER_TABLES`
    are staged as versions in a store under the shared checkpoint folder, one
    store per input folder, and read back by every later consumer, in this and
    in other applications: a version is built once per input files, parameters
    and code. Versions in use are pinned; :meth:`retire` removes those of
    replaced inputs. Each module reads its upstream *tables*, as the
    reference's notebooks do, instead of recomputing the whole chain. Written tables also give the planner
    real sizes, so small dimensions are broadcast up front and large ones
    take a sort-merge join. ``fresh`` names layers this instance must build
    itself (from the stored upstream layers) rather than read.
    """

    layers = LAYER_TABLES

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = cm.AS_OF,
                 deleted: str = "before_dedup", reuse_layers: bool = True, fresh: tuple[str, ...] = (),
                 gold_base: str = "write"):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.deleted = deleted
        self.reuse_layers = reuse_layers
        self.fresh = frozenset(fresh)
        self.gold_base = gold_base
        self._overrides: dict[str, DataFrame] = {}
        self._fingerprint: str | None = None

    # ------------------------------------------------------------- sources
    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def store(self) -> VersionStore:
        place = hashlib.sha256(str(self.sf_dir).rstrip("/").encode()).hexdigest()[:16]
        return VersionStore(self.spark, os.path.join(checkpoint_dir(self.spark), "layers", place))

    def _layer_key(self, name: str) -> str:
        if self._fingerprint is None:       # one listing of the input folder per pipeline
            self._fingerprint = _input_fingerprint(self.spark, self.sf_dir)
        own = () if name.startswith(("landing_", "bronze_")) else (self.as_of, self.deleted)
        return fingerprint_of({"input": self._fingerprint, "code": _code_fingerprint(), "own": own, "layer": name})

    def staged(self, name: str, build) -> Version:
        """The version of a layer for this input, built if there is none; pinned for this application."""
        key = (self.store.root, name, self._layer_key(name))
        if key not in _STAGED:
            _STAGED[key] = self.store.stage(name, key[2], build, PARTITIONED.get(name, ()), BUCKETED.get(name, ()), dealt=name in DEALT)
            self.store.pin([_STAGED[key]], PIN_SECONDS)
        return _STAGED[key]

    def retire(self, grace: float = PIN_SECONDS) -> list[tuple[str, str]]:
        """Remove versions of other inputs or code that nobody holds and that are older than ``grace`` seconds."""
        return self.store.sweep(grace, keep=lambda v: v.fingerprint == self._layer_key(v.layer))

    def _stores(self, name: str) -> bool:
        return self.reuse_layers and name in self.layers and name not in self.fresh

    def _get(self, name: str, build):
        if name not in self._overrides:
            if self._stores(name):
                # landing is read as plain files: queries on it are dealt by what they group by
                self._overrides[name] = self.store.read(self.staged(name, build), by_bucket=name != "landing_claims")
            else:
                self._overrides[name] = build()
        return self._overrides[name]

    # ------------------------------------------------------------- landing
    @property
    def landing(self) -> dict[str, DataFrame]:
        return {
            "facility": self.landing_facility, "provider": self.landing_provider,
            "audit": self.landing_audit, "member": self.landing_member,
            "procedure": self.landing_procedure, "claims": self.landing_claims,
        }

    @property
    def landing_facility(self) -> DataFrame:
        return self._get("landing_facility", lambda: cm.landing_facility(self.table("nation"), self.table("region")))

    @property
    def landing_provider(self) -> DataFrame:
        return self._get("landing_provider", lambda: cm.landing_provider(self.table("supplier")))

    @property
    def landing_audit(self) -> DataFrame:
        return self._get("landing_audit", lambda: cm.landing_audit(self.table("lineitem"), self.table("supplier")))

    @property
    def landing_member(self) -> DataFrame:
        return self._get("landing_member", lambda: cm.landing_member(self.table("customer")))

    @property
    def landing_procedure(self) -> DataFrame:
        return self._get("landing_procedure", lambda: cm.landing_procedure(self.table("part")))

    @property
    def landing_claims(self) -> DataFrame:
        return self._get("landing_claims", self._landed)

    def _landed(self) -> DataFrame:
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions")) if self._stores("landing_claims") else None
        return cm.landing_claims(self.table("lineitem"), self.table("orders"), self.table("supplier"), parts)

    # -------------------------------------------------------------- bronze
    def bronze(self, name: str) -> DataFrame:
        """The stored faithful copy of a landing table; silver reads this one."""
        return self._get(f"bronze_{name}", lambda: ingest_bronze(
            self._claims_by_key() if name == "claims" and self._stores("bronze_claims") else getattr(self, f"landing_{name}")))

    def _claims_by_key(self) -> DataFrame:
        """Landing claims dealt by their key, for the bronze layer: file by file if landing is stored so, else by an exchange."""
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if self._stores("landing_claims") and self.staged("landing_claims", self._landed).buckets == parts:
            return self.landing_claims
        return self.landing_claims.repartition(parts, *CLAIM_KEY)

    # -------------------------------------------------------------- silver
    @property
    def facility_clean(self) -> DataFrame:
        return self._get("facility_clean", lambda: dedup_latest(
            conform(self.bronze("facility"), FACILITY_TYPES, keep=["deleted", "load_date"]),
            ["facility_id"], "load_date", tiebreak=list(FACILITY_TYPES)[1:], deleted_flag="deleted",
            deleted=self.deleted, drop=["deleted", "load_date"]))

    @property
    def provider_clean(self) -> DataFrame:
        return self._get("provider_clean", lambda: dedup_latest(
            conform(self.bronze("provider"), PROVIDER_TYPES, keep=["deleted", "load_date"]),
            ["provider_id"], "load_date", tiebreak=list(PROVIDER_TYPES)[1:], deleted_flag="deleted",
            deleted=self.deleted, drop=["deleted", "load_date"]))

    @property
    def dim_provider(self) -> DataFrame:
        """Conformed provider x facility, code labels decoded once."""
        return self._get("dim_provider", lambda: self._provider_facility("inner"))

    def _provider_facility(self, how: str) -> DataFrame:
        return conform_dimension(
            self.provider_clean, self.facility_clean, "facility_id", how=how,
            decode_cols={"specialty_name": ("specialty", cm.SPECIALTY_NAMES, cm.UNKNOWN_LABEL),
                         "unit_name": ("unit", cm.SERVICE_TYPE_NAMES, cm.UNKNOWN_LABEL)},
            select=["provider_id", "provider_name", "status", "specialty", "specialty_name", "provider_type", "unit",
                    "unit_name", "credential_date", "termination_date", "termination_reason", "capacity",
                    "facility_id", "facility_name", "facility_code", "region_id", "region_name"])

    @property
    def orphan_providers(self) -> DataFrame:
        """Providers whose facility does not resolve in the *cleaned* facility."""
        def build():
            _, orphans = split_orphans(
                self.provider_clean, self.facility_clean.select("facility_id"), "facility_id",
                reason="facility_id without match in facility", at=F.lit(self.as_of).cast("date"),
                orphan_cols=["provider_id", "facility_id", "provider_name"])
            return orphans
        return self._get("orphan_providers", build)

    @property
    def dim_member(self) -> DataFrame:
        return self._get("dim_member", lambda: self._member_nation("inner"))

    @property
    def member_clean(self) -> DataFrame:
        return self._get("member_clean", lambda: dedup_latest(conform(self.bronze("member"), MEMBER_TYPES, keep=["deleted", "load_date"]),
            ["member_id"], "load_date", tiebreak=list(MEMBER_TYPES)[1:],
            deleted_flag="deleted", deleted=self.deleted, drop=["deleted", "load_date"]))

    def _member_nation(self, how: str) -> DataFrame:
        nations = self.facility_clean.select(F.col("facility_id").alias("nation_id"),
                                             F.col("facility_name").alias("nation_name"), "region_name")
        return conform_dimension(
            self.member_clean, nations, "nation_id", how=how,
            decode_cols={"plan_name": ("segment", cm.PLAN_SEGMENT_NAMES, cm.UNKNOWN_LABEL)},
            select=["member_id", "member_name", "segment", "plan_name", "age_band", "nation_id", "nation_name", "region_name"])

    @property
    def dim_procedure(self) -> DataFrame:
        return self._get("dim_procedure", lambda: dedup_latest(
            conform(self.bronze("procedure"), PROCEDURE_TYPES, keep=["deleted", "load_date"]),
            ["procedure_id"], "load_date", tiebreak=list(PROCEDURE_TYPES)[1:], deleted_flag="deleted",
            deleted=self.deleted, drop=["deleted", "load_date"]))

    @property
    def conformed_claims(self) -> DataFrame:
        """Delete filter on the raw flag, then the typing layer."""
        return self._get("conformed_claims", lambda: conform(
            self.bronze("claims"), CLAIM_TYPES, deleted_flag="deleted", keep=["load_date"], rename=CLAIM_RENAME))

    @property
    def latest_claims(self) -> DataFrame:
        """One version per claim, newest load first, full tiebreak."""
        def build():
            if self.deleted == "after_dedup":
                typed = conform(self.bronze("claims"), CLAIM_TYPES, keep=["load_date", "deleted"], rename=CLAIM_RENAME)
                return dedup_latest(typed, CLAIM_KEY, "load_date", CLAIM_TIEBREAK, deleted_flag="deleted",
                                    deleted="after_dedup", drop=["load_date", "deleted"])
            return dedup_latest(self.conformed_claims, CLAIM_KEY, "load_date", CLAIM_TIEBREAK, drop=["load_date"])
        return self._get("latest_claims", build)

    def claim_rules(self) -> list[tuple[str, Column]]:
        c = F.col
        return list(zip(cm.CLAIM_REASONS, [
            c("provider_id").isNotNull(),
            c("__p_provider").isNotNull(),
            c("__pr_procedure").isNotNull(),
            c("__m_member").isNotNull(),
            c("facility_id") == c("__p_facility"),
            c("presented_date") >= c("service_date"),
            c("paid") >= F.lit(0),
            c("paid") <= c("billed"),
        ]))

    @property
    def _claims_star(self) -> DataFrame:
        """The fact with its three parents, left-joined once for both sides."""
        def build():
            p = self.dim_provider.select(F.col("provider_id").alias("__p_provider"),
                                         F.col("facility_id").alias("__p_facility"))
            pr = self.dim_procedure.select(F.col("procedure_id").alias("__pr_procedure"),
                                           "group_code", "group_name", "high_complexity")
            m = self.dim_member.select(F.col("member_id").alias("__m_member"))
            f = self.latest_claims
            f = f.join(p, f["provider_id"] == p["__p_provider"], "left")
            f = f.join(pr, f["procedure_id"] == pr["__pr_procedure"], "left")
            f = f.join(m, f["member_id"] == m["__m_member"], "left")
            return f
        return self._get("_claims_star", build)

    VALID_COLS = ["claim_order", "claim_line", "month", "service_date", "presented_date", "member_id",
                  "provider_id", "facility_id", "procedure_id", "group_code", "group_name", "high_complexity",
                  "qty", "ref_amount", "billed", "disallowed", "paid", "auth_no", "post_termination"]
    REJECTED_COLS = ["claim_order", "claim_line", "provider_id", "month", "paid"]

    @property
    def claims_checked(self) -> DataFrame:
        """Every deduplicated claim with its first failing rule (NULL = valid).

        One evaluation of the star join decides both sides; written once, the
        valid fact and the quarantine are two filters of it."""
        return self._get("claims_checked", self._checked)

    def _checked(self) -> DataFrame:
        return tag_first_failing(self._claims_star, self.claim_rules()).select(*self.VALID_COLS, "quarantine_reason")

    @property
    def _split(self) -> tuple[DataFrame, DataFrame]:
        return self._get("_split", lambda: split_tagged(
            self.claims_checked, self.REJECTED_COLS, self.VALID_COLS, at=F.lit(self.as_of).cast("date")))

    @property
    def valid_claims(self) -> DataFrame:
        return self._get("valid_claims", lambda: self._split[0])

    @property
    def rejected_claims(self) -> DataFrame:
        return self._get("rejected_claims", lambda: self._split[1])

    # --------------------------------------------------------------- SCD2
    @property
    def event_timeline(self) -> DataFrame:
        """Audit (not reversed AND some attribute set) + current state at as_of."""
        return self._get("event_timeline", self._timeline)

    def _timeline(self) -> DataFrame:
        cur = self.dim_provider.withColumn("event_seq", F.lit(cm.CURRENT_EVENT_SEQ).cast("long"))
        return event_timeline(self.bronze("audit"), cur, ts="audit_date",
                              columns=AUDIT_COLS + ["event_seq"], any_of=ANY_OF,
                              as_of=self.as_of, deleted_flag="deleted")

    @property
    def intervals(self) -> DataFrame:
        """SCD2 intervals, "closes" timing, forward-filled attributes."""
        return self._get("intervals", self._scd2)

    def _scd2(self, keep_empty: bool = False) -> DataFrame:
        # bucketed by month: a provider with a very long audit trail is spread over its months
        return scd2(
            self.event_timeline, "provider_id", "audit_date", FILL_COLS, start_default="credential_date",
            tiebreak=["event_seq"], effective={"termination_date": ["termination_date", "termination_reason"]},
            split_by=F.trunc("audit_date", "month"), keep_empty=keep_empty)

    # --------------------------------------------------------------- gold
    def grain_measures(self) -> dict[str, Column]:
        return {
            "n_claims": F.count(F.lit(1)),
            "n_members": F.count_distinct("member_id"),
            "cost_total": F.sum("paid"),
            "billed_total": F.sum("billed"),
            "disallowed_total": F.sum("disallowed"),
            "ref_total": F.sum("ref_amount"),
            "n_post_termination": F.sum("post_termination"),
        }

    @property
    def grain_rollup(self) -> DataFrame:
        """Provider x month aggregate, before the as-of join (the fact is
        reduced to the grain first, so the interval join sees few rows)."""
        return self._get("grain_rollup", lambda: rollup_grain(
            self.valid_claims, ["provider_id", "month"], self.grain_measures()
        ).withColumn("month_start", month_start("month")))

    @property
    def asof_gold(self) -> DataFrame:
        """Attributes valid at the month start."""
        return self._get("asof_gold", lambda: asof_join(
            self.grain_rollup, self.intervals, "provider_id", "month_start",
            cols=["specialty", "status", "capacity"], how="inner", split_by=lambda t: F.trunc(t, "year")))

    def gold_at(self, grain_df: DataFrame, period: str) -> DataFrame:
        d = self.dim_provider.select("provider_id", "provider_name", "provider_type", "facility_id",
                                     "facility_name", "region_name")
        g = grain_df.join(d, on="provider_id", how="inner")
        g = ratio_measures(g, {
            "mean_cost_claim": ("cost_total", "n_claims", 2, None, "decimal"),
            "mean_cost_member": ("cost_total", "n_members", 2, None, "decimal"),
            "pct_disallowed": ("disallowed_total", "billed_total", 2, 100.0),
            "capacity_use_pct": ("n_claims", "capacity", 2, 100.0),
            "cost_index": ("cost_total", "ref_total", 4),
        })
        g = g.withColumn("specialty_name", decode("specialty", cm.SPECIALTY_NAMES, cm.UNKNOWN_LABEL))
        # The peer mean is a grouped aggregate joined back to these rows. Keeping
        # the per-grain rows (written to the checkpoint folder) stops the claim aggregation from running once per side of that join.
        if self.gold_base == "write":
            g = materialize(g, f"gold_base_{period}")
        return peer_index(g, "cost_index", ["specialty", period], threshold=cm.PEER_THRESHOLD,
                          volume="n_claims", min_volume=cm.PEER_MIN_CLAIMS)

    @property
    def gold(self) -> DataFrame:
        """Provider x month gold with measures, peer index, flag and SK."""
        return self._get("gold", self._gold)

    def _gold(self) -> DataFrame:
        g = self.gold_at(self.asof_gold, "month")
        return surrogate_key(g.select(*GOLD_COLS), ["provider_id", "month"], "sk")

    def gold_of(self, months: Column) -> DataFrame:
        """Gold of some months only, from their claims (the other months' files are not opened).

        A month's gold needs no other month: its peers are those of the month.
        """
        grain = rollup_grain(self.valid_claims.where(months), ["provider_id", "month"], self.grain_measures()).withColumn(
            "month_start", month_start("month"))
        placed = asof_join(grain, self.intervals, "provider_id", "month_start", cols=["specialty", "status", "capacity"], how="inner")
        return surrogate_key(self.gold_at(placed, "month").select(*GOLD_COLS), ["provider_id", "month"], "sk")

    def refreshed(self, path: str, months: Column) -> DataFrame:
        """A gold table at ``path`` with the folders of some months replaced, the others untouched; the table."""
        replace_partitions(self.gold_of(months), path, ["month"])
        return self.spark.read.schema(self.gold.schema).parquet(path).select(*self.gold.columns)

    def gold_quarter(self) -> DataFrame:
        """The same operators at provider x quarter grain (planted-signal check)."""
        q = self.valid_claims.withColumn("quarter", quarter_int(month_start("month")))
        r = rollup_grain(q, ["provider_id", "quarter"], self.grain_measures()).withColumn(
            "quarter_start", F.make_date(F.floor(F.col("quarter") / 10).cast("int"),
                                         ((F.col("quarter") % 10) * 3 - 2).cast("int"), F.lit(1)))
        a = asof_join(r, self.intervals, "provider_id", "quarter_start",
                      cols=["specialty", "status", "capacity"], how="inner")
        return self.gold_at(a, "quarter")

    # ------------------------------------------------------------ quality
    def panel(self, staged: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """The 13-row DQ panel, one aggregate per source table.

        ``staged`` puts other frames in the place of layers, so that a version
        can be judged before it is published.

        Valid and quarantined claims are the two sides of one checked table,
        so their metrics are conditional aggregates over a single scan of it."""
        c = F.col
        valid = c("quarantine_reason").isNull()
        rejected = c("quarantine_reason").isNotNull()
        metrics = [
            Metric("silver_valid_providers", "dim", F.count(F.lit(1))),
            Metric("silver_valid_claims", "checked", F.count_if(valid)),
            Metric("gold_rows", "gold", F.count(F.lit(1))),
            Metric("quarantine_orphan_providers", "orphans", F.count(F.lit(1)), lambda v: _gt0(v, "atencao")),
            Metric("quarantine_claims", "checked", F.count_if(rejected), lambda v: _gt0(v, "atencao")),
            Metric("quarantine_amount_retained", "checked",
                   F.round(F.coalesce(F.sum(F.when(rejected, c("paid"))), F.lit(0)), 2)),
            Metric("claims_without_authorization", "checked", F.count_if(valid & c("auth_no").isNull()),
                   lambda v: _gt0(v, "atencao")),
            Metric("claims_after_termination", "checked",
                   F.coalesce(F.sum(F.when(valid, c("post_termination"))), F.lit(0)),
                   lambda v: _gt0(v, "atencao")),
            Metric("gold_anomalous_rows", "gold", F.coalesce(F.sum("anomaly_flag"), F.lit(0)),
                   lambda v: _gt0(v, "atencao")),
            Metric("gold_duplicate_keys", "gold", F.count(F.lit(1)) - F.count_distinct("sk"),
                   lambda v: _gt0(v, "erro")),
            Metric("gold_negative_cost", "gold", F.count_if(c("cost_total") < 0), lambda v: _gt0(v, "erro")),
            Metric("gold_null_cost_index", "gold", F.count_if(c("cost_index").isNull()),
                   lambda v: _gt0(v, "erro")),
        ]
        recon = [Reconciliation("reconciliation_cost_silver_gold", "checked", F.sum(F.when(valid, c("paid"))),
                                "gold", F.sum("cost_total"))]
        of = {name: getattr(self, name) for name in ("dim_provider", "claims_checked", "gold", "orphan_providers")
              if name not in (staged or {})} | dict(staged or {})
        return dq_panel({"dim": of["dim_provider"], "checked": of["claims_checked"], "gold": of["gold"],
                         "orphans": of["orphan_providers"]}, metrics, recon)

    def publish(self) -> DataFrame:
        """Stage the checked claims and gold, audit the staged files, release both together; gold as released.

        A blocked gate raises and leaves readers on the last release.
        """
        staged = [self.staged("claims_checked", self._checked), self.staged("gold", self._gold)]
        now = self.store.release()
        if any(now.get(v.layer) != v.version for v in staged):
            write_audit_publish(self.store, staged, self.panel)
        return self.store.read(self.store.published("gold"))

    # --------------------------------------------------- period predicates
    @staticmethod
    def base_period(col: str = "month") -> Column:
        return F.col(col) <= F.lit(cm.BASE_LAST_MONTH)

    @staticmethod
    def recent_period(col: str = "month") -> Column:
        return F.col(col) >= F.lit(cm.SIGNAL_FROM_MONTH)
