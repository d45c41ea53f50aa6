"""Analytics over the graph: counts, hubs, matrices, contingency, ambiguity, aliases.

Defined results: shares of empty totals are 0; nodes without a community are in none of
the matrix cells but in the buckets; every order ends in an id, so ranks are total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lemmaweave.functions import text as T
from lemmaweave.operators.skew import sized


def corpus_counts(entries: DataFrame, resolved: DataFrame) -> DataFrame:
    """(measure, name, n) of entries by type and references by status."""
    parts = [
        entries.groupBy(F.lit("entry_type").alias("measure"), F.col("entry_type").alias("name")).agg(F.count(F.lit(1)).alias("n")),
        resolved.groupBy(F.lit("status").alias("measure"), F.col("status").alias("name")).agg(F.count(F.lit(1)).alias("n")),
        entries.groupBy(F.lit("volume").alias("measure"), F.col("volume").alias("name")).agg(F.count(F.lit(1)).alias("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def resolved_share(resolved: DataFrame, statuses: list[str]) -> DataFrame:
    """One row: share of references with one of ``statuses`` (0 if there are none)."""
    share = F.count_if(F.col("status").isin(statuses)) / F.count(F.lit(1))
    return resolved.agg(F.count(F.lit(1)).alias("n_references"), F.round(F.coalesce(share, F.lit(0.0)), 4).alias("resolved_share"))


def hubs(degrees: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` most cited nodes."""
    return degrees.orderBy(F.desc("in_degree"), "id").limit(n).select("id", "in_degree")


def degree_summary(degrees: DataFrame) -> DataFrame:
    """One row: nodes, uncited nodes and the exact median in-degree."""
    return degrees.agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("in_degree") == 0).alias("n_uncited"), F.median("in_degree").cast("double").alias("median_in_degree"))


def group_matrix(edges: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """(from_group, to_group, weight): summed weights between groups of nodes.

    Groups of -1 (no community) come as the buckets 'in', 'out' and 'internal'.
    """
    a = groups.select(F.col("id").alias("source"), F.col(group).cast("string").alias("from_group"))
    b = groups.select(F.col("id").alias("target"), F.col(group).cast("string").alias("to_group"))
    met = edges.join(sized(a), "source").join(sized(b), "target")
    bucket = F.when((F.col("from_group") == "-1") & (F.col("to_group") == "-1"), "internal").when(F.col("from_group") == "-1", "out").when(F.col("to_group") == "-1", "in")
    named = met.select(F.coalesce(bucket, "from_group").alias("from_group"), F.coalesce(bucket, "to_group").alias("to_group"), "weight")
    return named.groupBy("from_group", "to_group").agg(F.sum("weight").alias("weight"))


def internal_share(matrix: DataFrame) -> DataFrame:
    """One row: share of the weight that stays in its group."""
    inner = F.sum(F.when(F.col("from_group") == F.col("to_group"), F.col("weight")).otherwise(0))
    return matrix.agg(F.round(F.coalesce(inner / F.sum("weight"), F.lit(0.0)), 6).alias("internal_share"))


def asymmetry(matrix: DataFrame, least: int = 60) -> DataFrame:
    """Pairs of groups by how much more one cites the other."""
    back = matrix.select(F.col("from_group").alias("to_group"), F.col("to_group").alias("from_group"), F.col("weight").alias("back"))
    pairs = matrix.where((F.col("from_group") != F.col("to_group")) & (F.col("weight") >= least)).join(back, ["from_group", "to_group"], "left").fillna(0, ["back"])
    return pairs.withColumn("ratio", F.round(F.col("weight") / F.greatest("back", F.lit(1)), 6)).select("from_group", "to_group", "weight", "back", "ratio")


def external_flows(matrix: DataFrame) -> DataFrame:
    """Per group: weight out, weight in, number of targets, share of the top three."""
    outer = matrix.where("from_group <> to_group")
    ranked = outer.withColumn("_r", F.row_number().over(Window.partitionBy("from_group").orderBy(F.desc("weight"), "to_group")))
    out = ranked.groupBy(F.col("from_group").alias("grp")).agg(F.sum("weight").alias("weight_out"), F.count(F.lit(1)).alias("n_targets"), F.round(F.sum(F.when(F.col("_r") <= 3, F.col("weight")).otherwise(0)) / F.sum("weight"), 6).alias("top3_share"))
    into = outer.groupBy(F.col("to_group").alias("grp")).agg(F.sum("weight").alias("weight_in"))
    return out.join(into, "grp", "full").select("grp", F.coalesce("weight_out", F.lit(0)).alias("weight_out"), F.coalesce("weight_in", F.lit(0)).alias("weight_in"), F.coalesce("n_targets", F.lit(0)).alias("n_targets"), F.coalesce("top3_share", F.lit(0.0)).alias("top3_share"))


def contingency(rows: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n, row_share) of the counts that occur."""
    counted = rows.where(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("row_share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(row)), 6))


def chi_square(rows: DataFrame, row: str, column: str) -> DataFrame:
    """One row: chi-square, degrees of freedom and Cramér's V of two columns.

    Cells that do not occur add their expected count; over all cells the expected counts
    sum to n, so the dense grid is never built.
    """
    cells = contingency(rows, row, column).drop("row_share")
    by_row = cells.groupBy(row).agg(F.sum("n").alias("_r"))
    by_column = cells.groupBy(column).agg(F.sum("n").alias("_c"))
    shape = by_row.agg(F.count(F.lit(1)).alias("_nr"), F.sum("_r").alias("_n")).crossJoin(by_column.agg(F.count(F.lit(1)).alias("_nc")))
    full = cells.join(by_row, row).join(by_column, column).crossJoin(F.broadcast(shape))
    # sum (o - e)^2 / e = sum o^2 / e - n
    parts = full.groupBy("_n", "_nr", "_nc").agg((F.sum(F.col("n") * F.col("n") * F.col("_n") / (F.col("_r") * F.col("_c"))) - F.first("_n")).alias("chi2"))
    v = F.sqrt(F.greatest(F.col("chi2"), F.lit(0.0)) / (F.col("_n") * F.nullif(F.least("_nr", "_nc") - 1, F.lit(0))))
    return parts.select(F.round("chi2", 4).alias("chi2"), ((F.col("_nr") - 1) * (F.col("_nc") - 1)).alias("dof"), F.round(v, 6).alias("cramers_v"))


def eras(dates: DataFrame) -> DataFrame:
    """(era, n) of signed birth years, every era with its count, none left out."""
    names = [name for name, _, _ in T.ERAS]
    counted = dates.where(F.col("birth").isNotNull()).groupBy(T.era("birth").alias("era")).agg(F.count(F.lit(1)).alias("n"))
    every = counted.sparkSession.createDataFrame([(n,) for n in names], "era string")
    return every.join(counted, "era", "left").select("era", F.coalesce("n", F.lit(0)).alias("n"))


def graph_counts(entries: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(measure, n): entries, nodes, directed edges and their summed weight."""
    one = lambda frame, name, value: frame.agg(value.alias("n")).select(F.lit(name).alias("measure"), "n")
    rows = F.count(F.lit(1))
    parts = [one(entries, "entries", rows), one(nodes, "nodes", rows), one(edges, "edges", rows), one(edges, "weight", F.coalesce(F.sum("weight"), F.lit(0)))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def homonyms(conflicts: DataFrame, entries: DataFrame) -> DataFrame:
    """(lemma_key, entry_id, name): what tells the entries of one name apart."""
    each = conflicts.select("lemma_key", F.explode(F.split("entry_ids", " \\| ")).alias("id"))
    named = entries.select("id", T.display_name("headword", F.coalesce("body_text", F.lit(""))).alias("name"))
    return each.join(named, "id").select("lemma_key", F.col("id").alias("entry_id"), "name")


def alias_ranking(named: DataFrame, nodes: DataFrame, top: int = 20) -> DataFrame:
    """Of the ``top`` entries with most aliases (entry_id, n, names) those on the map."""
    ranked = named.orderBy(F.desc("n"), "entry_id").limit(top)
    return ranked.join(nodes.select(F.col("id").alias("entry_id")), "entry_id", "left_semi")


def coverage(dates: DataFrame, group: str) -> DataFrame:
    """(group, n, n_dated, share): how many of each group are dated."""
    return dates.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("dated").cast("long")).alias("n_dated"), F.round(F.avg("dated"), 6).alias("share"))


def _signed(dates: DataFrame) -> DataFrame:
    sign = lambda who: F.when(F.col(f"{who}_bc") == 1, -F.col(f"{who}_year")).otherwise(F.col(f"{who}_year")).alias(who)
    return dates.where("dated = 1").select("id", sign("birth"), sign("death"))


def longest_life(dates: DataFrame) -> DataFrame:
    """One row: the longest of the dated lives (ties by id)."""
    return _signed(dates).withColumn("years", F.col("death") - F.col("birth")).orderBy(F.desc("years"), "id").limit(1)


def era_regions(dates: DataFrame, regions: DataFrame) -> DataFrame:
    """(era, region, n): dated lives by era and the region (id, region) of their entry."""
    met = _signed(dates).join(regions, "id")
    return met.groupBy(T.era("birth").alias("era"), "region").agg(F.count(F.lit(1)).alias("n"))


def ambiguity(resolved: DataFrame, candidates: DataFrame) -> DataFrame:
    """(match_key, n, display, n_forms, n_candidates) of the terms left undecided."""
    open_ = resolved.where("status = 'ambiguous'")
    forms = open_.groupBy("match_key", "raw_target").agg(F.count(F.lit(1)).alias("k"))
    shown = forms.groupBy("match_key").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("n_forms"), F.min(F.struct((-F.col("k")).alias("k"), "raw_target")).alias("d"))
    met = candidates.join(open_.select("entry_id", "ordinal", "match_key").distinct(), ["entry_id", "ordinal"]).select("match_key", "candidate_entry_id").distinct()
    meant = met.groupBy("match_key").agg(F.count(F.lit(1)).alias("n_candidates"))
    return shown.join(meant, "match_key", "left").select("match_key", "n", F.col("d.raw_target").alias("display"), "n_forms", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"))


def aliases(lemmas: DataFrame) -> DataFrame:
    """(entry_id, n, names): entries by the names that redirect to them."""
    named = lemmas.where("variant_type = 'redirect_alias'").select("entry_id", "lemma").distinct()
    return named.groupBy("entry_id").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("lemma")), " | ").alias("names"))


def persons(entries: DataFrame, dates: DataFrame) -> DataFrame:
    """(id): dated lives, and biographies with the death sign in their head."""
    signed = entries.where("entry_type = 'biography'").where(F.contains(F.left("body_text", F.lit(500)), F.lit("†"))).select("id")
    return dates.where("dated = 1").select("id").unionByName(signed).distinct()


def bridges(degrees: DataFrame, centrality: DataFrame, top: int = 40, from_rank: int = 30) -> DataFrame:
    """The first 8 nodes high in betweenness but not in degree, with both ranks (from 0)."""
    high = centrality.orderBy(F.desc("betweenness"), "id").limit(top).withColumn("b_rank", F.row_number().over(Window.orderBy(F.desc("betweenness"), "id")) - 1)
    # Rank of a node = nodes before it; counted for the few high ones only.
    few = high.join(degrees.select("id", "in_degree"), "id")
    other = degrees.select(F.col("id").alias("_o"), F.col("in_degree").alias("_d"))
    before = other.join(F.broadcast(few), (F.col("_d") > F.col("in_degree")) | ((F.col("_d") == F.col("in_degree")) & (F.col("_o") < F.col("id")))).groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    return few.join(before, "id", "left").withColumn("d_rank", F.coalesce("_n", F.lit(0))).where(F.col("d_rank") >= from_rank).select("id", "betweenness", "b_rank", "in_degree", "d_rank").orderBy("b_rank").limit(8)


def label_check(labels: DataFrame, described: DataFrame) -> DataFrame:
    """(community, verdict): hand-made labels against the anchors found now."""
    joined = described.select("community", "anchor").join(labels.select("community", F.col("anchor").alias("_a")), "community", "full")
    verdict = F.when(F.col("_a").isNull(), "missing").when(F.col("anchor").isNull() | (F.col("anchor") != F.col("_a")), "stale").otherwise("ok")
    return joined.select("community", verdict.alias("verdict"))
