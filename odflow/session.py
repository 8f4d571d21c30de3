"""Session set-up shared by the library, the tests and the benchmark.

The library never creates a cluster session on its own: callers pass theirs in.
``build_session`` is for local runs (tests, bench) and pins the settings the
operators rely on: UTC session zone (zone-less timestamps read as UTC seconds),
ANSI mode (Spark 4 default), adaptive query execution with skew-join handling.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "odflow",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Local session with the settings above (tests and benchmark only)."""
    master = master or os.environ.get("ODFLOW_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is used as
    is. Only a local-mode session without one (tests) gets a fresh temporary
    folder. On a cluster without the setting we refuse, rather than write
    lineage cuts to a machine-local folder that other executors cannot read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="odflow-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; the chain operator needs a shared "
                       "checkpoint folder to cut lineage between its passes")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
