"""Incremental ingest: record files dropped into a folder become tables.

Each micro-batch appends the new records and their references; resolution is global (a
new volume may hold the target of an old reference), so it is a batch step over the
tables, not part of the stream. Deliveries that come again are dropped by key within the
watermark, so a restarted or repeated drop adds no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def entries_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", fmt: str = "parquet") -> DataFrame:
    """Records of all files that arrive in ``folder``."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).format(fmt).load(folder)


def once(stream: DataFrame, keys: list[str], at: str = "loaded_at", late: str = "400 days") -> DataFrame:
    """Each delivery (key and load time) once, for deliveries up to ``late`` apart."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([*keys, at])


def counts(stream: DataFrame, at: str = "loaded_at", window: str = "30 days", late: str = "10 days") -> DataFrame:
    """Deliveries per volume and window of load time."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window), "volume").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "volume", "n")


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what is there now to a parquet table; exactly once per checkpoint."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
