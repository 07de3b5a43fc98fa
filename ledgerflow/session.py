"""Session helpers.

The library never creates cluster-specific settings on its own: on a cluster
the session comes configured (``spark.checkpoint.dir`` pointing at a shared
folder).  ``local_session`` is for tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry: ANSI-safe parsing is done with
# try_cast in the operators, AQE re-plans joins and coalesces partitions at
# runtime, and its skew handling splits oversized shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "ledgerflow") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; a cluster session without it fails.  Only a bare local test session
    gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        opt = sc._jsc.sc().getCheckpointDir()
        current = opt.get() if opt.isDefined() else None
    if current:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="ledgerflow-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()

