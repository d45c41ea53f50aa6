"""Readers for the engine's tables.

Every reader returns a lazy frame; projections and filters applied to it reach the
parquet scan.
"""

from __future__ import annotations

import hashlib
import io
import os
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """The table ``name`` under ``root``, optionally only some columns."""
    frame = spark.read.parquet(f"{root}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def volumes(spark: SparkSession, pattern: str, only: str | None = None) -> DataFrame:
    """(volume, text) of tagged text files, each read whole; the volume is the file's name.

    ``pattern`` is a glob; ``only`` keeps the volumes whose name contains it, before any
    file is opened.
    """
    read = spark.read.option("wholetext", True)
    if only is not None:
        read = read.option("pathGlobFilter", f"*{only}*")
    # A folder that holds one volume (``file=NAME``) names it, else the file itself.
    path = F.url_decode(F.col("_metadata.file_path"))
    folder, file = F.regexp_extract(path, r"/file=([^/]*)/[^/]*$", 1), F.regexp_extract(path, r"([^/]*)$", 1)
    name = F.regexp_replace(F.when(folder != "", folder).otherwise(file), r"\.[A-Za-z0-9]+$", "")
    return read.text(pattern).select(name.alias("volume"), F.col("value").alias("text"))


def spread(frame: DataFrame, spark: SparkSession, key: str | None = None) -> DataFrame:
    """Give CPU-heavy Python stages enough tasks when few, small files were read.

    Files are split by size; compressed text unpacks to far more work than its bytes
    suggest. A round-robin exchange is made only if the scan has fewer partitions than
    the cluster has cores.
    """
    cores = spark.sparkContext.defaultParallelism
    if frame.rdd.getNumPartitions() >= cores:
        return frame
    return frame.repartition(cores, key) if key else frame.repartition(cores)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach; a cluster must name it, one machine may leave it open."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        folder = os.path.join(os.getcwd(), "spark-warehouse", "checkpoints")
        spark.sparkContext.setCheckpointDir(folder)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(frame: DataFrame, spark: SparkSession) -> DataFrame:
    """Materialise ``frame`` once in the shared folder and cut its lineage."""
    shared_folder(spark)
    return frame.checkpoint(eager=True)


def stored(frame: DataFrame, spark: SparkSession) -> DataFrame:
    """``frame`` as a table in the shared folder, read back: for loops, since a checkpoint
    hands on what the optimizer infers of its rows, which grows with every round. The
    table goes when the session ends.
    """
    assert spark._jvm is not None
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/table-{uuid.uuid4().hex}")
    frame.write.parquet(path.toString())
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(frame.schema).parquet(path.toString())


def ship(spark: SparkSession) -> None:
    """Make this package importable by all Python workers of the session, once.

    The package is written as an archive into the shared folder and added to the session,
    so it need not be installed or on the workers' path. Nothing is done if it runs from
    an archive already.
    """
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    files = sorted(package.rglob("*.py"))
    if context.applicationId in _SHIPPED or not files:
        return
    _SHIPPED.add(context.applicationId)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in files:
            archive.writestr(zipfile.ZipInfo(str(file.relative_to(package.parent))), file.read_bytes())
    digest = hashlib.sha256(data.getvalue()).hexdigest()[:16]
    context.addPyFile(shared_file(spark, f"{package.name}-{digest}.zip", data.getvalue()))


def shared_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Write ``data`` as a file of the shared folder; returns its address."""
    assert spark._jvm is not None
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    out.write(data)
    out.close()
    return path.toUri().toString()
