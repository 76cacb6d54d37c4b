"""A folder of XML files as a stream of records; an extension, since the batch engine has no streams."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparquill.sources import xml_archive


def follow(spark: SparkSession, folder: str, target: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the records of every new XML file in folder to the Parquet table at target; a batch that runs again replaces its part."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.xml")
        .load(folder)
        .select(F.regexp_extract("path", "([^/]+)$", 1).alias("filename"), F.col("content").alias("data"))
    )
    write = lambda batch, number: xml_archive.instructions(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")
    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
