"""Lemma search and neighbourhood filters.

Defined results: queries shorter than two characters find nothing; null keys never match;
an empty choice filters nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaweave.functions.text import fold_query


def index(lemmas: DataFrame, nodes: DataFrame) -> DataFrame:
    """Search rows (lemma_key, lemma, entry_id, variant_type, headword) of names on the map."""
    named = nodes.select(F.col("id").alias("entry_id"), "headword")
    return lemmas.select("lemma_key", "lemma", "entry_id", "variant_type").distinct().join(named, "entry_id").select("lemma_key", "lemma", "entry_id", "variant_type", "headword")


def matches(rows: DataFrame, text: str) -> DataFrame:
    """All entries whose key contains the query, without a limit."""
    q = fold_query(text)
    return rows.where(F.contains("lemma_key", F.lit(q)) if len(q) >= 2 else F.lit(False)).select("entry_id").distinct()


def query(rows: DataFrame, text: str, limit: int = 40) -> DataFrame:
    """Ranked hits: the key itself, then its beginning, then anywhere; short keys first."""
    q = fold_query(text)
    hit = rows.where(F.contains("lemma_key", F.lit(q)) if len(q) >= 2 else F.lit(False))
    rank = F.when(F.col("lemma_key") == q, 0).when(F.startswith("lemma_key", F.lit(q)), 1).otherwise(2)
    ranked = hit.withColumn("rank", rank)
    return ranked.orderBy("rank", F.length("lemma_key"), "lemma", "entry_id", "variant_type").limit(limit).select("lemma_key", "lemma", "entry_id", "variant_type", "rank")


def visible(communities: DataFrame, edges: DataFrame, chosen: list[str], hidden: list[int], incoming: bool = True, outgoing: bool = True) -> DataFrame:
    """Nodes that pass the filters: chosen ones and their neighbours, less hidden communities."""
    shown = communities.where(~F.col("community").isin(hidden)) if hidden else communities
    if not chosen:
        return shown.select("id")
    kept = communities.where(F.col("id").isin(chosen)).select("id")
    if incoming:
        kept = kept.unionByName(edges.where(F.col("target").isin(chosen)).select(F.col("source").alias("id")))
    if outgoing:
        kept = kept.unionByName(edges.where(F.col("source").isin(chosen)).select(F.col("target").alias("id")))
    return shown.select("id").join(kept.distinct(), "id", "left_semi")


def cited_by(edges: DataFrame, degrees: DataFrame, target: str) -> DataFrame:
    """Sources that cite a node, the most cited first."""
    sources = edges.where(F.col("target") == target).select(F.col("source").alias("id")).distinct()
    return sources.join(degrees.select("id", "in_degree"), "id").orderBy(F.desc("in_degree"), "id")


def menu(rows: DataFrame, degrees: DataFrame, text: str = "", chosen: list[str] | None = None, limit: int = 60) -> DataFrame:
    """Articles to choose from: chosen ones first, then the most cited that match."""
    q, pinned = fold_query(text), F.col("entry_id").isin(chosen or [])
    primary = rows.where("variant_type = 'primary'").join(degrees.select(F.col("id").alias("entry_id"), "in_degree"), "entry_id")
    kept = primary.where(F.contains("lemma_key", F.lit(q)) | pinned)
    return kept.select("entry_id", "lemma", "in_degree", pinned.alias("pinned")).distinct().orderBy(F.desc("pinned"), F.desc("in_degree"), "entry_id").limit(limit)
