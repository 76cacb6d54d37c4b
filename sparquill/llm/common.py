"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_going: set[str] = set()


def checkpoint_dir(spark: SparkSession) -> str:
    """The application's folder under spark.checkpoint.dir, which all executors share; a folder of our own only in local mode.

    It goes, with checkpoints and all else in it, when the driver's JVM ends.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="sparquill-"))
    folder = sc.getCheckpointDir()  # of this application alone
    if folder not in _going:
        _going.add(folder)
        files, place = _hadoop(spark, folder)
        files.deleteOnExit(place)
    return folder


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder.  What is written there goes when the driver's JVM ends, as lazy results may need it until then."""
    path = f"{checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    files, place = _hadoop(spark, path)
    files.mkdirs(place.getParent())
    files.deleteOnExit(place)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete what scratch() gave and nothing needs any more."""
    files, place = _hadoop(spark, path)
    files.delete(place, True)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder; columnar, so it suits wide or many rows.

    The driver's JVM is asked to collect garbage, for only then does Spark
    delete the shuffle files of finished jobs and the broadcast blocks that
    executors still hold; there is no call that gives back the latter.
    """
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    df.sparkSession._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of df has (case-insensitively)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def values(batch: pa.Array, rows: int = 256) -> Iterator:
    """The values of a batch; Python objects exist for `rows` of them at a time, as texts may be long."""
    for at in range(0, len(batch), rows):
        yield from batch.slice(at, rows).to_pylist()


def mapped(batch: pa.Array, f: Callable, kind: pa.DataType, rows: int = 256) -> pa.Array:
    """f of every value, as an Arrow array; Python objects exist for `rows` values and results at a time."""
    parts = [pa.array([f(x) for x in batch.slice(at, rows).to_pylist()], kind) for at in range(0, len(batch), rows)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def fold(doc_id: str, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; null ids are in no fold (null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, *, max_rows: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text, y) of a bounded sample of the labelled rows that `keep` accepts.

    One label per id: repeated labels count once, as their maximum; null ids
    and null labels are left out.  max_rows bounds the expected sample size;
    which rows are taken depends on a hash of the id alone.  The sampled ids
    (8 bytes each) are what is broadcast, so max_rows bounds that too.
    """
    ids = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull())
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .where(keep)
    )
    n = ids.count()
    if n > max_rows:
        ids = ids.where(F.shiftrightunsigned(F.xxhash64(F.col("id"), F.lit("sample")), 1) < int(max_rows / n * (1 << 63)))
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(F.broadcast(ids), "id")
