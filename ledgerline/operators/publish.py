"""W21 — write, audit, publish: a gate that decides what readers see."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerline.operators.quality import quality_gate
from ledgerline.sources.versions import Version, VersionStore


class GateBlocked(AssertionError):
    """The audit found blocking rows; nothing was published. ``metrics`` maps their names to their values."""

    def __init__(self, metrics: Mapping[str, str | None]):
        super().__init__(f"publication blocked by {len(metrics)} metrics: {dict(sorted(metrics.items()))}")
        self.metrics = dict(metrics)


@dataclass(frozen=True)
class Publication:
    release: int
    versions: tuple[Version, ...]
    panel: DataFrame


def write_audit_publish(store: VersionStore, staged: Sequence[Version], panel: Callable[[Mapping[str, DataFrame]], DataFrame],
                        fail_on: str = "erro") -> Publication:
    """Publish staged versions as one release if their audit has no blocking row.

    The panel (metric, value, severity) is computed from the staged *files*,
    so what was audited is what readers get: a version whose files differ from
    its manifest, a panel without rows and a row of severity ``fail_on`` (or
    without severity) all block. Readers stay on the last release meanwhile and
    after a blocked attempt. If another release came in during the audit,
    nothing is published either (``Conflict``): the audit saw other neighbours.
    The panel has a row per metric, so it is small enough to collect.
    """
    seen = store.latest()
    for v in staged:
        if not store.intact(v):
            raise GateBlocked({f"{v.layer}_files": v.version})
    audit = panel({v.layer: store.read(v) for v in staged})
    rows = audit.collect()
    if not rows:
        raise GateBlocked({"panel_rows": "0"})
    audited = store.spark.createDataFrame(rows, audit.schema)
    blocking = quality_gate(audited, fail_on).unionByName(audited.where("severity IS NULL")).collect()
    if blocking:
        raise GateBlocked({r["metric"]: r["value"] for r in blocking})
    return Publication(store.publish(staged, based_on=seen), tuple(staged), audited)
