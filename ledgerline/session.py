"""Session construction and the few settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library expects. They are defaults: a cluster
# session that already sets a key keeps its own value.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``master``/``shuffle_partitions`` are only for local runs and tests; on a
    cluster leave them unset so spark-submit's values win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only when nothing is configured (local tests) is a scratch folder made.
    The value is never changed on a session that already has one.
    """
    current = None
    try:
        current = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - Connect sessions may not expose core confs
        current = None
    sc = getattr(spark, "sparkContext", None)
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        master = sc.master if sc is not None else ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: layer tables and "
                               "checkpoints must survive the loss of an executor")
        current = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def application_id(spark: SparkSession) -> str:
    """Identifier of the running application (stable for the session's life)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return spark.conf.get("spark.app.id", "app")
