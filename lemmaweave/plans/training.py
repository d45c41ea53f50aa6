"""Queries and SQL of the general training-data operators (problems 3 and 4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaweave.operators import orphans, packed
from lemmaweave.sources import spread, table


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    entries = spread(table(spark, root, "entries", "id", "werke_raw", "literatur_raw"), spark)
    rows = packed.split_rows(entries, ["id"], ["werke_raw", "literatur_raw"])
    return rows.select(F.col("id").alias("entry_id"), "field", "pos", "item").distinct()


def p3_flags(spark: SparkSession, root: str) -> DataFrame:
    """Values that could not be told for sure, with the reason: open_quote or no_tail."""
    entries = spread(table(spark, root, "entries", "id", "werke_raw", "literatur_raw"), spark)
    rows = packed.split_rows(entries, ["id"], ["werke_raw", "literatur_raw"], least=1, strict=False)
    return rows.where("error IS NOT NULL").select(F.col("id").alias("entry_id"), "field", "pos", "item", "error").distinct()


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    references = [("resolved_cross_references", "resolved_entry_id"), ("lemmas", "entry_id"), ("resolved_cross_reference_candidates", "candidate_entry_id")]
    sources = [(table(spark, root, name, key, "loaded_at"), name, key) for name, key in references]
    return orphans.found(sources, table(spark, root, "entries", "id", "loaded_at", "deleted_at"))


def p4_report(spark: SparkSession, root: str) -> DataFrame:
    return orphans.report(p4_found(spark, root))


P4_SQL = """
WITH refs AS (
  SELECT 'resolved_cross_references' AS ref_table, resolved_entry_id AS orphan_id, loaded_at FROM resolved_cross_references
  UNION ALL SELECT 'lemmas', entry_id, loaded_at FROM lemmas
  UNION ALL SELECT 'resolved_cross_reference_candidates', candidate_entry_id, loaded_at FROM resolved_cross_reference_candidates),
parents AS (SELECT id, min(loaded_at) AS valid_from, max(deleted_at) AS valid_to FROM entries WHERE id IS NOT NULL GROUP BY id),
found AS (
  SELECT DISTINCT ref_table, orphan_id, strftime(r.loaded_at, '%Y-%m') AS period,
    CASE WHEN p.id IS NULL THEN 'missing' WHEN valid_to IS NOT NULL THEN 'deleted' WHEN valid_from > r.loaded_at THEN 'late' END AS reason
  FROM refs r LEFT JOIN parents p ON p.id = r.orphan_id WHERE orphan_id IS NOT NULL)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p3_found": p3_found, "p3_flags": p3_flags, "p4_found": p4_found, "p4_report": p4_report}


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": P4_SQL + "SELECT ref_table, orphan_id, period, reason FROM found WHERE reason IS NOT NULL",
        "p4_report": P4_SQL
        + "SELECT ref_table, period, reason, count(*) AS n_orphans FROM found WHERE reason IS NOT NULL GROUP BY ref_table, period, reason",
    }
