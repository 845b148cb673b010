"""The declarative twin: six datasets, each a query and named expectations.

Every dataset is built from the twin's own upstream datasets without the
filters of the imperative build (timeline, intervals and gold from SQL of their
own, so that parity compares two definitions); its expectations decide which rows stay. The
unfiltered dataset is written once: the kept rows are a filter of it, and the
counters are observed by the tasks that write it and stored beside it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import counted, expect, expectation_rows, parity
from ledgerline.plans import claims_model as cm
from ledgerline.plans.pipeline import AUDIT_COLS, FILL_COLS, LAYER_TABLES, ClaimsPipeline

# dataset -> expectation -> (predicate, what happens to a row that fails)
EXPECTATIONS = {
    "dim_provider": {
        "facility_resolved": ("facility_name IS NOT NULL", "drop"),
        "status_known": ("status IS NOT NULL", "warn"),
        "capacity_plausible": ("capacity BETWEEN 1 AND 5000", "warn"),
    },
    "dim_member": {
        "nation_resolved": ("nation_name IS NOT NULL", "drop"),
        "age_band_valid": ("age_band BETWEEN 1 AND 10", "warn"),
    },
    "event_timeline": {},
    "intervals": {"interval_not_empty": ("valid_to > valid_from", "drop")},
    "valid_claims": {
        "presented_not_before_service": ("presented_date >= service_date", "drop"),
        "paid_not_negative": ("paid >= 0", "drop"),
        "paid_up_to_billed": ("paid <= billed", "drop"),
        "facility_consistent": ("facility_id IS NOT NULL", "drop"),
        "has_authorization": ("auth_no IS NOT NULL", "warn"),
    },
    "gold": {
        "key_present": ("sk IS NOT NULL", "drop"),
        "cost_not_negative": ("cost_total >= 0", "drop"),
        "index_computed": ("cost_index IS NOT NULL", "warn"),
    },
}


def _rules(name: str) -> dict[str, tuple[Column, str]]:
    return {rule: (F.expr(ok), action) for rule, (ok, action) in EXPECTATIONS[name].items()}


# dataset -> (keys, values) that both builds must share
COMPARED = {
    "dim_provider": (["provider_id"], ["provider_name", "status", "specialty_name", "unit_name", "capacity",
                                       "facility_id", "facility_name", "region_name"]),
    "dim_member": (["member_id"], ["member_name", "plan_name", "age_band", "nation_name", "region_name"]),
    "event_timeline": (["provider_id", "audit_date", "event_seq"], ["status", "specialty", "unit", "capacity"]),
    "intervals": (["provider_id", "valid_from", "valid_to"], [*FILL_COLS, "termination_date", "termination_reason"]),
    "valid_claims": (["claim_order", "claim_line"], ["provider_id", "facility_id", "month", "group_code", "billed", "paid"]),
    "gold": (["provider_id", "month"], ["n_claims", "n_members", "cost_total", "cost_index", "peer_index", "anomaly_flag"]),
}


class DeclaredPipeline(ClaimsPipeline):
    """The same datasets under the same names, declared with expectations."""

    layers = LAYER_TABLES | {f"declared_{name}{part}" for name in EXPECTATIONS for part in ("", "_counts")}

    def declared(self, name: str) -> DataFrame:
        """The dataset before its expectations, written once."""
        return self._counted(name, self._builds()[name])[0]

    def counts(self, name: str) -> DataFrame:
        return self._counted(name, self._builds()[name])[1]

    def _builds(self) -> dict:
        return {
            "dim_provider": lambda: self._provider_facility("left"),
            "dim_member": lambda: self._member_nation("left"),
            "event_timeline": self._events,
            "intervals": self._spans,
            "valid_claims": self._claims,
            "gold": self._provider_months,
        }

    def _counted(self, name: str, build) -> tuple[DataFrame, DataFrame | None]:
        """The dataset and the counters of its expectations; both are stored, the counters come from the write."""
        rules, layer = _rules(name), f"declared_{name}"
        if not rules:
            return self._get(layer, build), None
        if not self.reuse_layers or layer in self.fresh:
            df = self._get(layer, build)
            return df, expectation_rows(df, rules)
        seen = []

        def observed() -> DataFrame:
            df, obs = counted(build(), rules)
            seen.append(obs)
            return df

        df = self._get(layer, observed)
        counts = self._get(f"{layer}_counts", lambda: expectation_rows(df, rules, seen[0] if seen else None))
        return df, counts

    def _claims(self) -> DataFrame:
        """Inner star join; a facility that disagrees with the provider's is nulled."""
        p = self.dim_provider.select("provider_id", F.col("facility_id").alias("__p_facility"))
        pr = self.dim_procedure.select("procedure_id", "group_code", "group_name", "high_complexity")
        m = self.dim_member.select("member_id")
        return (self.latest_claims.join(p, "provider_id").join(m, "member_id").join(pr, "procedure_id")
                .withColumn("facility_id", F.when(F.col("facility_id") == F.col("__p_facility"), F.col("facility_id")))
                .drop("__p_facility"))

    def _events(self) -> DataFrame:
        """The twin's own timeline: a union in SQL, every rule in its WHERE."""
        cols = ", ".join(AUDIT_COLS)
        return self.spark.sql(f"""
            SELECT {cols}, event_seq, audit_date FROM {{audit}}
            WHERE deleted = 0 AND coalesce(CAST(status AS STRING), CAST(specialty AS STRING), CAST(unit AS STRING),
                                           CAST(credential_date AS STRING)) IS NOT NULL
            UNION ALL
            SELECT {cols}, CAST({cm.CURRENT_EVENT_SEQ} AS BIGINT), DATE'{self.as_of}' FROM {{providers}}""",
            audit=self.bronze("audit"), providers=self.dim_provider)

    def _spans(self) -> DataFrame:
        """The twin's own intervals: one plain window per provider, where the other build scans in buckets and carries."""
        filled = ", ".join(f"last_value({c}) IGNORE NULLS OVER upto AS {c}" for c in FILL_COLS)
        return self.spark.sql(f"""
            SELECT provider_id, {', '.join(FILL_COLS)}, if(termination_date < valid_to, termination_date, NULL) AS termination_date,
                   if(termination_date < valid_to, termination_reason, NULL) AS termination_reason, valid_to AS audit_date, valid_from, valid_to
            FROM (SELECT provider_id, {filled}, termination_date, termination_reason, audit_date AS valid_to,
                         coalesce(lag(audit_date) OVER placed, credential_date, audit_date) AS valid_from
                  FROM {{events}}
                  WINDOW placed AS (PARTITION BY provider_id ORDER BY audit_date, event_seq NULLS LAST),
                         upto AS (PARTITION BY provider_id ORDER BY audit_date, event_seq NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) x""", events=self.event_timeline)

    def _provider_months(self) -> DataFrame:
        """The twin's own gold: intervals by their bounds with a guard, peer means by a window over the grain."""
        return self.spark.sql(f"""
            WITH grain AS (
              SELECT provider_id, month, count(*) AS n_claims, count(DISTINCT member_id) AS n_members, sum(paid) AS cost_total,
                     sum(ref_amount) AS ref_total, make_date(div(month, 100), month % 100, 1) AS month_start
              FROM {{claims}} GROUP BY provider_id, month),
            state AS (
              SELECT g.*, v.specialty, row_number() OVER (PARTITION BY g.provider_id, g.month ORDER BY v.valid_from DESC, v.valid_to DESC) AS nth
              FROM grain g JOIN {{spans}} v ON v.provider_id = g.provider_id AND v.valid_from <= g.month_start AND g.month_start < v.valid_to),
            indexed AS (
              SELECT s.provider_id, s.month, n_claims, n_members, cost_total, ref_total, s.specialty,
                     round(CAST(cost_total AS DOUBLE) / nullif(CAST(ref_total AS DOUBLE), 0D), 4) AS cost_index
              FROM state s JOIN {{providers}} d ON d.provider_id = s.provider_id WHERE nth = 1),
            peers AS (
              SELECT *, cost_index / nullif(avg(cost_index) OVER (PARTITION BY specialty, month), 0D) AS ratio FROM indexed)
            SELECT provider_id, month, n_claims, n_members, cost_total, ref_total, cost_index, round(ratio, 4) AS peer_index,
                   CAST(coalesce(ratio >= {cm.PEER_THRESHOLD} AND n_claims >= {cm.PEER_MIN_CLAIMS}, false) AS INT) AS anomaly_flag,
                   xxhash64(CAST(provider_id AS STRING), CAST(month AS STRING)) AS sk
            FROM peers""", claims=self.valid_claims, spans=self.intervals, providers=self.dim_provider)

    def kept(self, name: str) -> DataFrame:
        return expect(self.declared(name), _rules(name))[0]

    dim_provider = property(lambda self: self.kept("dim_provider"))
    dim_member = property(lambda self: self.kept("dim_member"))
    event_timeline = property(lambda self: self.kept("event_timeline"))
    intervals = property(lambda self: self.kept("intervals"))
    valid_claims = property(lambda self: self.kept("valid_claims"))
    gold = property(lambda self: self.kept("gold"))

    def metrics(self) -> DataFrame:
        """One row per expectation ``(dataset, expectation, action, n_passed, n_failed)``."""
        return reduce(DataFrame.unionByName, [
            self.counts(name).select(F.lit(name).alias("dataset"), "*")
            for name, rules in EXPECTATIONS.items() if rules])


def twin_parity(imperative: ClaimsPipeline, declared: DeclaredPipeline) -> DataFrame:
    """One row per dataset, keys and shared values compared."""
    return reduce(DataFrame.unionByName, [
        parity(getattr(imperative, name), getattr(declared, name), keys, dataset=name, values=values)
        for name, (keys, values) in COMPARED.items()])
