"""Stages of a plan that several branches read: written once, as tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The application's folder under spark.checkpoint.dir; all in it goes when the driver's JVM ends."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if given is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="sparquill-"))  # one process: any folder is shared
    place = spark._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return sc.getCheckpointDir()


def stored(df: DataFrame, kind: str) -> DataFrame:
    """df written once and read again: whatever reads the result reads a table, not the plan behind it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
