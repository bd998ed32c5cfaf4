"""Cut lineage by writing a table into the cluster's shared checkpoint folder.

Every table of an application lies under one folder named after it, which is
removed when the application's Python ends (or by ``remove_tables``), so that
runs do not leave copies of the facts behind.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from freightlens.session import ensure_checkpoint_dir

_FOLDERS: dict[str, SparkSession] = {}


def app_folder(spark: SparkSession) -> str:
    """The application's folder under ``spark.checkpoint.dir``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/freightlens/{spark.sparkContext.applicationId}"
    if not _FOLDERS:
        atexit.register(_remove_all)
    _FOLDERS[folder] = spark
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration() if spark.sparkContext._jsc else hadoop.conf.Configuration()
    path = hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


def remove_tables(spark: SparkSession) -> None:
    """Remove all tables that this application wrote; what reads them fails afterwards."""
    folder = app_folder(spark)
    remove_folder(spark, folder)
    del _FOLDERS[folder]


def _remove_all() -> None:
    for folder, spark in list(_FOLDERS.items()):
        with contextlib.suppress(Exception):  # the JVM may have ended before
            remove_folder(spark, folder)


def write_checkpoint_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the application's folder and read it back.

    The written files survive executor loss (unlike ``localCheckpoint``),
    and the returned DataFrame has a one-step lineage: a parquet scan.
    With ``partition_by`` each task sorts its rows by those columns and writes
    a file per partition: the rows are not shuffled for the layout.
    """
    spark = df.sparkSession
    path = f"{app_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
