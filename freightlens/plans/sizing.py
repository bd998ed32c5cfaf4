"""Shuffle partition count sized from the input, for the big one-off build.

AQE coalesces small shuffle partitions but does not split large ones
(except in skewed joins), so a job whose shuffles carry terabytes needs
enough partitions up front.  ``input_bytes`` reads only file lengths (the
``binaryFile`` source with the ``length`` column; contents are not read).
``scaled_shuffle`` raises ``spark.sql.shuffle.partitions`` for the duration
of a block when the input calls for more than the session has; AQE then
coalesces any excess back to the advisory partition size.  Settings that only
the block needs (``BUILD_CONF`` for the fact build) are restored with it.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Shuffle bytes per byte of parquet input (decompression, wider rows).
EXPANSION = 3.0
# Target shuffle bytes per reduce partition.
TARGET_PARTITION_BYTES = 512 * 1024 * 1024

# The fact build sorts each partition twice, for the join and for the months it
# writes, in rows about seven times the parquet: 64 MB keep both sorts in the
# memory of a task, so that nothing spills.
BUILD_PARTITION_BYTES = 64 * 1024 * 1024
# Its scans and coalesced partitions are bounded alike.  A side that the
# finished stage shows to be below 16 MB (about 700,000 suppliers) is broadcast
# instead of shuffling the joined lines once more; a larger one is shuffled.
BUILD_CONF = {
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "48m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16m",
}


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size in bytes of the files under ``paths``."""
    n = spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0]
    return int(n or 0)


def partitions_for(nbytes: int, expansion: float = EXPANSION, target: int = TARGET_PARTITION_BYTES) -> int:
    return max(1, math.ceil(nbytes * expansion / target))


@contextmanager
def scaled_shuffle(spark: SparkSession, paths: list[str], target: int = TARGET_PARTITION_BYTES, conf: dict[str, str] | None = None):
    """Within the block, use at least ``partitions_for(input_bytes(paths))``
    shuffle partitions and the settings of ``conf``; the previous settings are
    restored afterwards."""
    key = "spark.sql.shuffle.partitions"
    wanted = max(int(spark.conf.get(key)), partitions_for(input_bytes(spark, paths), target=target))
    settings = {**(conf or {}), key: str(wanted)}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield int(spark.conf.get(key))
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
