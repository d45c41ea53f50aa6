"""Data-quality checks: each is a count of violations, 0 when all is well.

Defined results: null keys violate completeness, not referential integrity; empty tables
violate nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaweave.functions import text as T

# The closed vocabularies.
ENTRY_TYPES = ["biography", "subject_article", "redirect", "unknown"]
STATUSES = ["same_volume", "cross_volume", "deinflected", "slash_half", "ambiguous", "unresolved"]
VARIANTS = ["primary", "slash_half", "comma_inverted", "redirect_alias"]
FLAGS = ["split_headword_merged", "heading_promoted", "duplicate_heading_line_removed", "short_span_uncertain", "nonstandard_bibliography"]


def _named(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")


def missing_parents(children: DataFrame, key: str, parents: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Distinct child keys without a parent."""
    keys = children.where(F.col(key).isNotNull()).select(F.col(key).alias("_k")).distinct()
    return _named(name, keys.join(parents.select(F.col(parent_key).alias("_k")), "_k", "left_anti"))


def duplicates(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    return _named(name, rows.groupBy(*keys).count().where("count > 1"))


def outside(rows: DataFrame, column: str, allowed: list[str], name: str) -> DataFrame:
    return _named(name, rows.where(F.col(column).isNull() | ~F.col(column).isin(allowed)))


def dataset(entries: DataFrame, references: DataFrame, resolved: DataFrame, candidates: DataFrame, lemmas: DataFrame, flags: DataFrame) -> DataFrame:
    """(check, violations) over the relational tables, as delivered."""
    recount = reduce(lambda a, b: a + b, [T.count_sign(c) for c in ("body_text", "werke_raw", "literatur_raw")])
    rows = [
        missing_parents(resolved, "resolved_entry_id", entries, "id", "resolved target without entry"),
        missing_parents(candidates, "candidate_entry_id", entries, "id", "candidate without entry"),
        missing_parents(lemmas, "entry_id", entries, "id", "lemma without entry"),
        missing_parents(references, "entry_id", entries, "id", "reference without source"),
        missing_parents(entries, "id", lemmas.where("variant_type = 'primary'"), "entry_id", "entry without primary lemma"),
        duplicates(entries.select("id", "loaded_at"), ["id", "loaded_at"], "entry delivered twice at once"),
        outside(entries, "entry_type", ENTRY_TYPES, "entry type unknown"),
        outside(resolved, "status", STATUSES, "status unknown"),
        outside(lemmas, "variant_type", VARIANTS, "variant unknown"),
        outside(flags, "flag", FLAGS, "flag unknown"),
        _named("empty body", entries.where(F.col("body_text").isNull() | (T.strip("body_text") == ""))),
        _named("bold or superscript left", entries.where(F.col("body_text").rlike(r"(?s)\*\*.+?\*\*|<sup>"))),
        _named("unreadable count stale", entries.where(~F.col("unreadable_chars").eqNullSafe(recount))),
        _named("target missing or superfluous", resolved.where(F.col("resolved_entry_id").isNull() != F.col("status").isin("ambiguous", "unresolved"))),
        _named("id not of its volume", entries.where(T.volume_of("id") != F.col("volume"))),
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def structure(entries: DataFrame, references: DataFrame, resolved: DataFrame, edges: DataFrame, nodes: DataFrame, most_hops: int = 3, most_words: int = 6, most_pages: int = 60) -> DataFrame:
    """(check, violations): order, bounds, spans, reachability, exclusion and additivity.

    ``entries`` and ``references`` are the current ones, ``edges`` and ``nodes`` the graph.
    Neighbours in order meet by their numbers, so no volume is gathered for a window.
    """
    places = entries.select("volume", "ordinal", "pdf_page_start").where("ordinal IS NOT NULL AND pdf_page_start IS NOT NULL")
    before = places.select("volume", (F.col("ordinal") + 1).alias("ordinal"), F.col("pdf_page_start").alias("_b"))
    redirects = entries.where("entry_type = 'redirect'").select("id")
    led = resolved.where("ordinal = 0 AND resolved_entry_id IS NOT NULL").select(F.col("entry_id").alias("id"))
    ends = edges.select(F.col("source").alias("id")).unionByName(edges.select(F.col("target").alias("id"))).distinct()
    cited = resolved.where(F.col("resolved_entry_id").isNotNull()).select(F.col("resolved_entry_id").alias("id")).distinct()
    numbered = references.groupBy("entry_id").agg(F.count(F.lit(1)).alias("n"), F.max("ordinal").alias("top"))

    def adds_up(rows: DataFrame, by: str, name: str) -> DataFrame:
        parts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("parts"))
        whole = rows.agg(F.count(F.lit(1)).alias("whole"))
        return parts.crossJoin(whole).select(F.lit(name).alias("check"), F.abs(F.col("parts") - F.col("whole")).alias("violations"))

    found = [
        _named("page before that of the entry before", places.join(before, ["volume", "ordinal"]).where("pdf_page_start < _b")),
        _named("page span reversed", entries.where("pdf_page_end < pdf_page_start")),
        _named("page span too long", entries.where(F.col("pdf_page_end") - F.col("pdf_page_start") > most_pages)),
        _named("ordinal below 1", entries.where("ordinal < 1 OR ordinal IS NULL")),
        _named("hops out of bounds", resolved.where(~F.col("redirect_hops").between(0, most_hops))),
        _named("match words out of bounds", resolved.where(~F.col("match_words").between(1, most_words))),
        _named("redirect leads nowhere", redirects.join(led, "id", "left_anti")),
        _named("reference ends at a redirect", cited.join(redirects, "id", "left_semi")),
        _named("node without an edge", nodes.select("id").join(ends, "id", "left_anti")),
        _named("edge end is no node", ends.join(nodes.select("id"), "id", "left_anti")),
        _named("edge to itself", edges.where("source = target")),
        _named("references not numbered through", numbered.where(F.col("n") != F.col("top") + 1)),
        duplicates(entries, ["volume", "ordinal"], "place taken twice"),
        adds_up(entries, "volume", "volumes do not add up"),
        adds_up(resolved, "status", "statuses do not add up"),
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


def compared(before: DataFrame, now: DataFrame, by: list[str]) -> DataFrame:
    """(by, n_before, n_now) of the counts (by, n) that differ between two manifests."""
    a, b = before.select(*by, F.col("n").alias("n_before")), now.select(*by, F.col("n").alias("n_now"))
    joined = a.join(b, by, "full").select(*by, F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_now", F.lit(0)).alias("n_now"))
    return joined.where("n_before <> n_now")


def unpaired(references: DataFrame, resolved: DataFrame) -> DataFrame:
    """References without a resolution and resolutions without a reference."""
    keys = ["entry_id", "ordinal"]
    a, b = references.select(*keys).distinct(), resolved.select(*keys).distinct()
    return _named("reference not resolved", a.join(b, keys, "left_anti")).unionByName(_named("resolution without reference", b.join(a, keys, "left_anti")))


def recomputed(stored: DataFrame, again: DataFrame) -> DataFrame:
    """Stored resolutions by status, and how many of them resolving ``again`` does not give."""
    keys = ["entry_id", "ordinal"]
    rows = stored.select(*keys, "status", "resolved_entry_id").distinct().join(again.select(*keys, F.col("status").alias("_s"), F.col("resolved_entry_id").alias("_r")), keys)
    differs = (F.col("status") != F.col("_s")) | ~F.col("resolved_entry_id").eqNullSafe(F.col("_r"))
    return rows.groupBy(F.concat(F.lit("stored "), "status").alias("check")).agg(F.count_if(differs).alias("violations"))


def not_idempotent(texts: DataFrame, column: str) -> DataFrame:
    """Texts that cleaning once more would change."""
    once = texts.where(F.col(column).isNotNull()).select(T.clean(column).alias("_a"))
    return _named("cleaning not idempotent", once.where(F.col("_a") != T.clean("_a")))
