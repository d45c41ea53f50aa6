"""Canonical name index of entries with their variants.

Variants: the lemma itself (primary), the halves of a compound with a slash, the inverted
form of ``a, b``, and the names of redirects under the entry they lead to. One row per
(key, entry, variant); of several spellings the one of the earliest (volume, ordinal).

Defined results: null or blank names give no row; entries count once per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaweave.functions import text as T


def variants(entries: DataFrame, resolved: DataFrame) -> DataFrame:
    """(lemma_key, lemma, entry_id, volume, variant_type) of current entries and their
    resolved references (entry_id, ordinal, resolved_entry_id)."""
    named = entries.select("id", "volume", "ordinal", "entry_type", T.clean("headword").alias("headword"))
    lemma = T.lemma("headword")
    primary = named.select("id", "volume", "ordinal", lemma.alias("lemma"), F.lit("primary").alias("variant_type"))
    halves = named.where(F.contains(T.core("headword"), F.lit("/"))).select("id", "volume", "ordinal", F.explode(F.transform(F.split(T.core("headword"), "/", -1), lambda h: T.strip(T.without_article(T.strip(h))))).alias("lemma"), F.lit("slash_half").alias("variant_type"))
    inverted = named.select("id", "volume", "ordinal", T.comma_inverted(lemma).alias("lemma"), F.lit("comma_inverted").alias("variant_type"))
    first = resolved.where("ordinal = 0 AND resolved_entry_id IS NOT NULL").select(F.col("entry_id").alias("id"), F.col("resolved_entry_id").alias("target"))
    alias = named.where("entry_type = 'redirect'").join(first, "id").select(F.col("target").alias("id"), "volume", "ordinal", lemma.alias("lemma"), F.lit("redirect_alias").alias("variant_type"))
    rows = primary.unionByName(halves).unionByName(inverted).unionByName(alias).withColumn("lemma_key", T.key("lemma")).where(F.col("lemma_key") != "")
    chosen = rows.groupBy("lemma_key", F.col("id").alias("entry_id"), "variant_type").agg(F.min(F.struct("volume", "ordinal", "lemma")).alias("r"))
    return chosen.select("lemma_key", F.col("r.lemma").alias("lemma"), "entry_id", F.col("r.volume").alias("volume"), "variant_type")


def conflicts(lemmas: DataFrame) -> DataFrame:
    """Keys that several entries claim as primary: (lemma_key, n, entry_ids)."""
    owners = lemmas.where("variant_type = 'primary'").select("lemma_key", "entry_id").distinct()
    return owners.groupBy("lemma_key").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("entry_id")), " | ").alias("entry_ids")).where("n > 1")
