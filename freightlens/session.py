"""SparkSession settings for the workload.

Adaptive query execution re-plans joins at run time (a shuffled side that
turns out small becomes a broadcast, skewed partitions are split) and
coalesces small shuffle partitions.  ``spark.checkpoint.dir`` is read from
the session; a local default is set only when it is missing (tests).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "freightlens",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a laptop) without the setting gets a
    temporary folder; on a cluster a machine-local folder would be lost with
    its executor, so a missing setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(e.g. on HDFS or an object store)")
        d = os.path.join(tempfile.gettempdir(), "freightlens-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
