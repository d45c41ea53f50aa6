"""Writers: records, tables, exports and the manifest.

All writers are ordinary distributed writes; ordered single-file exports exist for small
results only and say so. Nothing is written to machine-local temporary folders.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaweave.functions import text as T
from lemmaweave.operators.skew import join_nullable


def jsonl(frame: DataFrame, path: str) -> None:
    """One object a line; null fields are kept."""
    frame.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def csv(frame: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Header, null as empty text; ranges of the order are files of their own, in order."""
    rows = frame.repartitionByRange(*order).sortWithinPartitions(*order) if order else frame
    rows.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").option("escape", "\"").csv(path)


def parquet(frame: DataFrame, path: str, part: str = "volume") -> None:
    """A table partitioned by volume; only the volumes present are replaced."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def shards(payloads: DataFrame, path: str, part: str = "volume") -> None:
    """One JSON folder per volume."""
    payloads.write.mode("overwrite").partitionBy(part).json(path)


def read_jsonl(spark: Any, path: str, schema: str) -> DataFrame:
    """Records by declared schema; missing fields are null."""
    return spark.read.schema(schema).json(path)


def prefer(clean: DataFrame | None, raw: DataFrame) -> DataFrame:
    """The clean records if there are any, else the raw ones with null clean columns."""
    return clean if clean is not None else raw


def edges_export(references: DataFrame, resolved: DataFrame, entries: DataFrame) -> DataFrame:
    """Every reference with source, target and how it was resolved; failures included."""
    source = entries.select(F.col("id").alias("entry_id"), F.col("headword").alias("source_headword"), F.col("volume").alias("source_volume"))
    target = entries.select(F.col("id").alias("resolved_entry_id"), F.col("headword").alias("target_headword"), F.col("volume").alias("target_volume"))
    keys = ["entry_id", "ordinal"]
    rows = join_nullable(resolved.join(references.select(*keys, "raw_context"), keys).join(source, "entry_id"), target, "resolved_entry_id")
    return rows.select(F.col("entry_id").alias("source_entry_id"), "source_headword", "source_volume", "ordinal", "raw_target", "raw_context", "status", F.col("resolved_entry_id").alias("target_entry_id"), "target_headword", "target_volume", "match_words", "redirect_hops", "suffix_stripped")


def ambiguous_export(references: DataFrame, candidates: DataFrame, entries: DataFrame) -> DataFrame:
    """Every candidate of every undecided reference."""
    named = entries.select(F.col("id").alias("candidate_entry_id"), F.col("headword").alias("candidate_headword"), F.col("volume").alias("candidate_volume"))
    rows = candidates.select("entry_id", "ordinal", "candidate_entry_id").distinct().join(references, ["entry_id", "ordinal"]).join(named, "candidate_entry_id")
    return rows.select(F.col("entry_id").alias("source_entry_id"), "ordinal", "raw_target", "raw_context", "candidate_entry_id", "candidate_headword", "candidate_volume")


def entries_export(entries: DataFrame, flags: DataFrame) -> DataFrame:
    """Entries with the list of their flags (empty if none)."""
    listed = flags.select(F.col("entry_id").alias("id"), "flag").distinct().groupBy("id").agg(F.array_sort(F.collect_list("flag")).alias("flags"))
    return entries.join(listed, "id", "left").withColumn("flags", F.coalesce("flags", F.array().cast("array<string>")))


def bibliography_shards(entries: DataFrame) -> DataFrame:
    """(shard, id, werke, literatur) of entries with a bibliography; the shard is the first
    letter of the folded headword, ``_`` if it has none."""
    letter = F.regexp_extract(T.key("headword"), "^([a-z])", 1)
    rows = entries.where(F.col("werke_raw").isNotNull() | F.col("literatur_raw").isNotNull())
    return rows.select(F.when(letter == "", "_").otherwise(letter).alias("shard"), "id", F.col("werke_raw").alias("werke"), F.col("literatur_raw").alias("literatur"))


def manifest(counts: DataFrame, parameters: dict[str, Any], path: str | None = None) -> dict[str, Any]:
    """Counts by measure and name (a bounded vocabulary) with the parameters of the run;
    ``path``: a folder that all executors reach, where it is written as one JSON line."""
    out: dict[str, Any] = {"parameters": parameters}
    for row in counts.collect():
        out.setdefault(row["measure"], {})[row["name"]] = row["n"]
    if path:
        line = json.dumps(out, ensure_ascii=False, sort_keys=True)
        counts.sparkSession.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return out
