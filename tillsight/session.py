"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library expects. AQE re-plans joins from runtime sizes (broadcast only below the
# threshold it measured) and splits skewed shuffle partitions; timestamps are wall-clock (NTZ).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tillsight",
                driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench. On a cluster, build the session with the cluster's
    own master and pass it in; every operator only needs an existing SparkSession."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", driver_memory))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local-mode session may fall back to a fresh
    temporary folder; a cluster must name a shared folder, since a machine-local one would not
    survive the loss of the executor that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        conf = tempfile.mkdtemp(prefix="tillsight-ckpt-", dir=os.environ.get("TILLSIGHT_TMP", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a materialised table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
