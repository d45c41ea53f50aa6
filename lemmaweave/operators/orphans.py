"""Orphan references: keys that point to parents which are missing, deleted or late.

Both sides are reduced first (references to one row per table, key and month with the
earliest load; parents to one row per key with their validity interval), then
co-partitioned and sorted on the key and merged in one linear pass (a sort-merge join).
The reduction runs map-side, so a key that holds a third of all rows reaches the merge
as a handful of rows.

Defined results for odd input: null reference keys are no references; null load times
have a null period and are never late (nothing shows they came first); a parent without
any load time is not late; ids compare byte for byte (the empty string is an id);
repeated rows count once in ``found``; extra columns are ignored; an empty parent table
makes every reference ``missing``; an empty reference table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reduce_references(frame: DataFrame, name: str, key: str, loaded: str = "loaded_at") -> DataFrame:
    """One row per (key, month): earliest load and number of delivered rows."""
    return (
        frame.select(F.col(key).alias("orphan_id"), F.col(loaded).alias("at"))
        .where(F.col("orphan_id").isNotNull())
        .groupBy("orphan_id", F.date_format("at", "yyyy-MM").alias("period"))
        .agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n_rows"))
        .withColumn("ref_table", F.lit(name))
    )


def parent_intervals(frame: DataFrame, key: str = "id", loaded: str = "loaded_at", deleted: str = "deleted_at") -> DataFrame:
    """One row per parent key: when it first arrived, and whether it was ever deleted."""
    return (
        frame.select(F.col(key).alias("parent_id"), F.col(loaded).alias("at"), F.col(deleted).alias("gone"))
        .where(F.col("parent_id").isNotNull())
        .groupBy("parent_id")
        .agg(F.min("at").alias("valid_from"), F.max("gone").alias("valid_to"))
    )


def classify(references: DataFrame, parents: DataFrame) -> DataFrame:
    """Merge reduced references with parent intervals; keep the orphans with a reason."""
    merged = references.join(parents.hint("merge"), references["orphan_id"] == parents["parent_id"], "left")
    reason = (
        F.when(F.col("parent_id").isNull(), "missing")
        .when(F.col("valid_to").isNotNull(), "deleted")
        .when(F.col("valid_from") > F.col("first_at"), "late")
    )
    return merged.withColumn("reason", reason).where(F.col("reason").isNotNull())


def found(sources: list[tuple[DataFrame, str, str]], parents: DataFrame) -> DataFrame:
    """Distinct (ref_table, orphan_id, period, reason) over all reference tables.

    ``sources`` lists (frame, name, key column). The three reduced streams are united
    before the merge, so the parent side is exchanged and sorted once.
    """
    streams = [reduce_references(frame, name, key) for frame, name, key in sources]
    united = streams[0]
    for other in streams[1:]:
        united = united.unionByName(other)
    return classify(united, parent_intervals(parents)).select("ref_table", "orphan_id", "period", "reason")


def report(orphans: DataFrame) -> DataFrame:
    """Orphan keys per table, period and reason."""
    return orphans.groupBy("ref_table", "period", "reason").agg(F.count(F.lit(1)).alias("n_orphans"))
