"""Session helpers.

On a cluster the session is created by the platform; these helpers only
fill in settings that are unset, so a cluster configuration always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings this library relies on; applied only when the session lacks them.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "wtprof", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when a local session names none (tests) a scratch folder is made
    and registered, so ``DataFrame.checkpoint()`` can cut lineage reliably.
    A cluster must name one: a folder of the driver's machine is refused.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="wtprof-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for materialised tables."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df):
    """Run a small fitted-state plan once and cut its lineage.

    ``checkpoint()`` writes to the shared folder of ``spark.checkpoint.dir``
    (reliable: survives executor loss), so later scalar subqueries and joins
    on the fitted state read a tiny table instead of recomputing the fit.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
