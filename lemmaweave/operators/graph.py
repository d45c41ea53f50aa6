"""The citation graph: nodes, weighted edges, degrees, communities, layout, centrality.

Edges are frames (source, target, weight). Iterative algorithms (components,
communities) are DataFrame loops whose state is checkpointed each round, with messages
combined map-side, so a hub's neighbours are never gathered in one task. Betweenness
spreads its sources over the cluster, each task holding the whole edge list as numbers; the
force layout is for graphs of display size and checks that before it collects.

Defined results: edges with an end that is no node are dropped, self loops too; nodes
without edges have degree 0 and are components of their own; empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lemmaweave.operators.paths import between
from lemmaweave.operators.skew import heavy_values, join_by_value, sized
from lemmaweave.sources import cut, stored

RESOLVED = ["same_volume", "cross_volume", "deinflected", "slash_half"]
#: Edges that the layout may hold in one process (16 bytes each, and as many for a step).
DISPLAY_EDGES = 20_000_000


def nodes(entries: DataFrame) -> DataFrame:
    """Current entries but redirects: (id, volume, ordinal, headword, entry_type)."""
    return entries.where("entry_type <> 'redirect'").select("id", "volume", "ordinal", "headword", "entry_type")


def numbered(nodes_: DataFrame) -> DataFrame:
    """Node numbers from 0 in (volume, ordinal, id) order, without one global sort task.

    Ranges are sorted side by side; a range's offset is the count of those before it.
    """
    return _placed_in_order(nodes_, ["volume", "ordinal", "id"]).withColumnRenamed("_at", "node")


def _placed_in_order(rows: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``_at``: the place of each row, from 0, in the order of ``by``."""
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_m", F.monotonically_increasing_id())
    # Made once: the ranges must be the same for the counts and for the rows.
    local = cut(ordered.withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m") % F.lit(1 << 33)), rows.sparkSession)
    sizes = local.groupBy("_p").agg((F.max("_i") + 1).alias("_n"))
    # One row per range, so this window is over few rows.
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return local.join(F.broadcast(offsets.select("_p", "_before")), "_p").withColumn("_at", F.col("_before") + F.col("_i")).drop("_m", "_p", "_i", "_before")


def edges(resolved: DataFrame, nodes_: DataFrame, statuses: list[str] = RESOLVED) -> DataFrame:
    """Directed edges between nodes, weight = number of references, no self loops.

    References are summed before they meet the nodes, so hot targets shrink first.
    """
    named = resolved.where(F.col("status").isin(statuses)).select(F.col("entry_id").alias("source"), F.col("resolved_entry_id").alias("target"))
    summed = named.where("source <> target").groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))
    ids = nodes_.select("id")
    return summed.join(ids, summed["source"] == ids["id"], "left_semi").join(ids, summed["target"] == ids["id"], "left_semi")


def undirected(edges_: DataFrame) -> DataFrame:
    """(a, b, weight) with a < b, both directions summed."""
    return edges_.groupBy(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")).agg(F.sum("weight").alias("weight"))


def adjacency(edges_: DataFrame, chunk: int = 1000) -> DataFrame:
    """(id, direction, part, neighbours): sorted neighbour lists, ``out`` and ``in``.

    The list of a hub comes in parts of about ``chunk`` neighbours, so none is gathered whole.
    """
    ends = edges_.select(F.col("source").alias("id"), F.lit("out").alias("direction"), F.col("target").alias("n")).unionByName(edges_.select(F.col("target").alias("id"), F.lit("in").alias("direction"), F.col("source").alias("n")))
    counts = ends.groupBy("id", "direction").agg(F.count(F.lit(1)).alias("k"))
    crowded = counts.where(F.col("k") > chunk).select("id", "direction", F.ceil(F.col("k") / chunk).alias("parts"))
    # Crowded ends are at most one in ``chunk`` of the rows; if they are few they are broadcast.
    parted = ends.join(sized(crowded), ["id", "direction"], "left")
    part = F.pmod(F.xxhash64("n"), F.coalesce("parts", F.lit(1)))
    return parted.groupBy("id", "direction", part.alias("part")).agg(F.array_sort(F.collect_list("n")).alias("neighbours"))


def nearest(points: DataFrame, x: float, y: float, radius: float) -> DataFrame:
    """The point (id, x, y) nearest to a place, within ``radius`` (ties by id): one row or none.

    The square around the place is a filter that reaches the scan; of what is left one
    aggregate keeps the nearest.
    """
    square = F.col("x").between(x - radius, x + radius) & F.col("y").between(y - radius, y + radius)
    away = F.pow(F.col("x") - x, 2) + F.pow(F.col("y") - y, 2)
    near = points.where(square).withColumn("d", away).where(F.col("d") <= radius * radius)
    return near.agg(F.min(F.struct("d", "id")).alias("m")).where(F.col("m").isNotNull()).select("m.id", F.round(F.sqrt("m.d"), 6).alias("distance"))


def degrees(edges_: DataFrame, nodes_: DataFrame) -> DataFrame:
    """(id, in_degree, out_degree) of all nodes, weighted and filled with 0."""
    ends = edges_.select(F.col("target").alias("id"), F.col("weight").alias("i"), F.lit(0).cast("long").alias("o")).unionByName(edges_.select(F.col("source").alias("id"), F.lit(0).cast("long").alias("i"), F.col("weight").alias("o")))
    summed = ends.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    return nodes_.select("id").join(summed, "id", "left").fillna(0, ["in_degree", "out_degree"])


def radii(in_degrees: DataFrame, least: float = 1.6, most: float = 11.0) -> DataFrame:
    """Adds ``radius``: grows with the root of the share of the largest in-degree."""
    top = in_degrees.agg(F.greatest(F.max("in_degree"), F.lit(1)).alias("_top"))
    return in_degrees.crossJoin(F.broadcast(top)).withColumn("radius", F.lit(least) + (most - least) * F.sqrt(F.col("in_degree") / F.col("_top"))).drop("_top")


def _ends(pairs: DataFrame, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """((a, b, weight) in both directions, (a) of the hubs), materialised."""
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")), spark)
    return both, stored(heavy_values(both.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "a", "n"), spark)


def _told(both: DataFrame, labels: DataFrame, hubs_: DataFrame, small: bool) -> DataFrame:
    """``both`` with what ``labels`` (id, ...) say of the end ``a``; hubs meet by broadcast."""
    said = labels.withColumnRenamed("id", "a")
    return both.join(F.broadcast(said), "a") if small else join_by_value(both, said, "a", hubs_)


def components(edges_: DataFrame, nodes_: DataFrame, spark: SparkSession, rounds: int = 64) -> DataFrame:
    """(id, component): the least id that each node is connected with.

    Labels spread along edges and are then shortened by pointer jumping (a label takes
    its own label), so the rounds grow with the logarithm of the longest path. The label
    of a giant component is that of nearly all nodes: pointers are jumped once per
    distinct label, and go back to the nodes by broadcast where a label is heavy.
    """
    both, hubs_ = _ends(undirected(edges_), spark)
    labels = stored(nodes_.select("id", F.col("id").alias("component")), spark)
    small = labels.count() <= 100_000
    for _ in range(rounds):
        said = _told(both, labels, hubs_, small).groupBy(F.col("b").alias("id")).agg(F.min("component").alias("_m"))
        spread_ = stored(labels.join(said, "id", "left").select("id", F.col("component").alias("_old"), F.least("component", F.coalesce("_m", "component")).alias("component")), spark)
        counts = spread_.groupBy("component").agg(F.count(F.lit(1)).alias("_n"))
        own = spread_.select(F.col("id").alias("component"), F.col("component").alias("_j"))
        jump = counts.select("component").join(own, "component").where("_j < component")
        after = join_by_value(spread_, jump, "component", heavy_values(counts, "component", "_n"), "left")
        after = stored(after.select("id", "_old", F.coalesce("_j", "component").alias("component")), spark)
        changed = after.where("component <> _old").limit(1).count()
        labels = after.drop("_old")
        if not changed:
            break
    return labels


def communities(edges_: DataFrame, nodes_: DataFrame, spark: SparkSession, resolution: float = 2.0, rounds: int = 6, levels: int = 5) -> DataFrame:
    """(id, label): communities of high modularity at ``resolution``, each connected.

    Local moving and aggregation (Louvain), in rounds over frames: every node sees the
    weight it has to each community beside it and moves to the one with most gain. Half of
    the nodes move in a round, and of two that stand alone only the one with the larger
    label, so no pair swaps for ever; a level ends when fewer than one node in fifty
    moves. Communities become nodes of the next level until none moves. At the end each
    is split into its connected parts, as Leiden's refinement promises. Ties go to the
    smaller label, so the result is the same for every partitioning.
    """
    pairs = stored(undirected(edges_), spark)
    total = 2.0 * (pairs.agg(F.sum("weight").alias("m")).first()["m"] or 0)
    member = stored(nodes_.select("id", F.col("id").alias("label")), spark)
    if not total:
        return member
    level = pairs.select("a", "b", F.col("weight").cast("double").alias("weight"))
    for _ in range(levels):
        both, hubs_ = _ends(level, spark)
        sizes = stored(both.groupBy(F.col("a").alias("id")).agg(F.sum("weight").alias("_w")), spark)
        if _ == 0:
            degree = sizes.withColumnRenamed("_w", "k")
        labels, moved_any = stored(degree.select("id", "k", F.col("id").alias("label")), spark), False
        n = labels.count()
        small, calm = n <= 100_000, 0
        for turn in range(rounds):
            groups = labels.groupBy("label").agg(F.sum("k").alias("tot"), F.count(F.lit(1)).alias("size"))
            known = labels.join(F.broadcast(groups) if small else groups, "label").select("id", "label", "k", "tot", "size")
            heard = _told(both, known, hubs_, small).groupBy(F.col("b").alias("id"), "label").agg(F.sum("weight").alias("w"), F.first("tot").alias("tot"), F.first("size").alias("size"))
            mine = known.select("id", F.col("label").alias("own"), F.col("k").alias("own_k"), F.col("tot").alias("own_tot"), F.col("size").alias("own_size"))
            met = heard.join(F.broadcast(mine) if small else mine, "id")
            here = F.col("label") == F.col("own")
            gain = F.round(F.col("w") - resolution * F.col("own_k") * (F.col("tot") - F.when(here, F.col("own_k")).otherwise(0.0)) / total, 9)
            # Ties go to the smaller label.
            option = F.struct((-gain).alias("g"), "label", "size")
            lone = F.round(-resolution * F.col("own_k") * (F.col("own_tot") - F.col("own_k")) / total, 9)
            best = met.groupBy("id").agg(F.min(F.when(~here, option)).alias("to"), F.coalesce(F.max(F.when(here, gain)), F.first(lone)).alias("stay"), F.first("own").alias("own"), F.first("own_size").alias("own_size"))
            alone = (F.col("own_size") == 1) & (F.col("to.size") == 1)
            mover = F.pmod(F.xxhash64("id", F.lit(turn // 2)), F.lit(2)) == turn % 2
            goes = best.where(mover & (-F.col("to.g") > F.col("stay")) & (~alone | (F.col("to.label") < F.col("own")))).select("id", F.col("to.label").alias("_to"))
            after = stored(labels.join(goes, "id", "left").select("id", "k", F.coalesce("_to", "label").alias("label"), F.col("_to").isNotNull().alias("_go")), spark)
            moved = after.where("_go").count()
            moved_any |= moved > 0
            labels, calm = after.drop("_go"), calm + 1 if moved * 50 <= n else 0
            if calm >= 2:
                break
        if not moved_any:
            break
        to = stored(labels.select(F.col("id").alias("label"), F.col("label").alias("_to")), spark)
        to = F.broadcast(to) if small else to
        member = stored(member.join(to, "label", "left").select("id", F.coalesce("_to", "label").alias("label")), spark)
        a, b = to.select(F.col("label").alias("a"), F.col("_to").alias("_a")), to.select(F.col("label").alias("b"), F.col("_to").alias("_b"))
        level = level.join(F.broadcast(a) if small else a, "a").join(F.broadcast(b) if small else b, "b").where("_a <> _b")
        level = stored(level.groupBy(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).agg(F.sum("weight").alias("weight")), spark)
        degree = stored(labels.groupBy(F.col("label").alias("id")).agg(F.sum("k").alias("k")), spark)
    inner = pairs.join(sized(member.select(F.col("id").alias("a"), F.col("label").alias("_a"))), "a").join(sized(member.select(F.col("id").alias("b"), F.col("label").alias("_b"))), "b").where("_a = _b")
    parts = components(inner.select(F.col("a").alias("source"), F.col("b").alias("target"), "weight"), member.select("id"), spark)
    return parts.select("id", F.col("component").alias("label"))


def ranked_communities(labels: DataFrame, least: int = 12) -> DataFrame:
    """(id, community): numbered by size from 0, -1 below the size floor; ties by label."""
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= least)
    # One row per community above the floor, so the ranking is over few rows.
    ranks = sizes.withColumn("community", F.row_number().over(Window.orderBy(F.desc("size"), "label")) - 1)
    return labels.join(ranks.select("label", "community"), "label", "left").select("id", F.coalesce("community", F.lit(-1)).alias("community"))


def modularity(edges_: DataFrame, assignment: DataFrame, label: str = "community", resolution: float = 1.0) -> DataFrame:
    """One row: modularity of an assignment on the undirected projection."""
    pairs = undirected(edges_)
    a, b = assignment.select(F.col("id").alias("a"), F.col(label).alias("ca")), assignment.select(F.col("id").alias("b"), F.col(label).alias("cb"))
    met = pairs.join(sized(a), "a").join(sized(b), "b")
    inside = met.groupBy(F.col("ca").alias("c")).agg(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("weight")).otherwise(0)).alias("inner"))
    ends = met.select(F.col("ca").alias("c"), "weight").unionByName(met.select(F.col("cb").alias("c"), "weight")).groupBy("c").agg(F.sum("weight").alias("deg"))
    total = pairs.agg(F.sum("weight").alias("m"))
    parts = ends.join(inside, "c", "left").fillna(0).crossJoin(F.broadcast(total))
    return parts.agg(F.round(F.sum(F.col("inner") / F.col("m") - resolution * F.pow(F.col("deg") / (2 * F.col("m")), 2)), 6).alias("modularity"))


def described(communities: DataFrame, nodes_: DataFrame, in_degrees: DataFrame) -> DataFrame:
    """(community, size, label, anchor): named by the three most cited members."""
    full = communities.where("community >= 0").join(nodes_.select("id", "headword"), "id").join(in_degrees.select("id", "in_degree"), "id")
    ranked = full.withColumn("_r", F.row_number().over(Window.partitionBy("community").orderBy(F.desc("in_degree"), "id")))
    named = ranked.where("_r <= 3").groupBy("community").agg(F.array_sort(F.collect_list(F.struct("_r", "headword", "id"))).alias("t"))
    sizes = communities.where("community >= 0").groupBy("community").agg(F.count(F.lit(1)).alias("size"))
    return sizes.join(named, "community").select("community", "size", F.array_join(F.transform("t", lambda x: x["headword"]), " · ").alias("label"), F.col("t")[0]["id"].alias("anchor"))


def boosted(edges_: DataFrame, communities: DataFrame, factor: float = 8.0) -> DataFrame:
    """Undirected edges whose weight is raised inside a community."""
    a = communities.select(F.col("id").alias("a"), F.col("community").alias("ca"))
    b = communities.select(F.col("id").alias("b"), F.col("community").alias("cb"))
    same = (F.col("ca") == F.col("cb")) & (F.col("ca") >= 0)
    return undirected(edges_).join(sized(a), "a").join(sized(b), "b").select("a", "b", (F.col("weight") * F.when(same, factor).otherwise(1.0)).alias("weight"))


class TooLarge(ValueError):
    """The graph is too large for a step that holds it in one process."""


def _arrays(edges_: DataFrame, spark: SparkSession, most: int) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """((id, node), edges (a, b, weight) as arrays of node numbers, in order); ids stay in Spark."""
    pairs = stored(edges_.select("a", "b", F.col("weight").cast("double").alias("weight")), spark)
    if pairs.count() > most:
        raise TooLarge(f"more than {most} edges: too large for one process")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    placed = stored(_placed_in_order(ids, ["id"]).select("id", F.col("_at").alias("node")), spark)
    a, b = placed.select(F.col("id").alias("a"), F.col("node").cast("int").alias("_a")), placed.select(F.col("id").alias("b"), F.col("node").cast("int").alias("_b"))
    found = pairs.join(sized(a), "a").join(sized(b), "b").select("_a", "_b", "weight").toArrow()
    left, right, weight = (found[name].to_numpy() for name in ("_a", "_b", "weight"))
    order = np.lexsort((right, left))
    return placed, left[order], right[order], weight[order]


def _pushed(at: np.ndarray, centre: np.ndarray, mass: np.ndarray, block: int = 65_536) -> np.ndarray:
    """What the cells (centre, mass) push each point by: mass over distance, summed.

    In blocks of points that stay in the processor's cache; distances and sums are products
    of matrices.
    """
    move, rows = np.empty_like(at), max(1, block // len(mass))
    sides, square, one = -2 * centre.T, (centre * centre).sum(1), np.column_stack([np.ones(len(mass)), centre])
    for i in range(0, len(at), rows):
        part = at[i : i + rows]
        away = part @ sides
        away += square
        away += (part * part).sum(1)[:, None]
        np.maximum(away, 0.01, out=away)
        np.divide(mass, away, out=away)
        sums = away @ one
        move[i : i + rows] = part * sums[:, :1] - sums[:, 1:]
    return move


def betweenness(edges_: DataFrame, spark: SparkSession) -> DataFrame:
    """(id, betweenness): directed, unweighted, over all shortest paths (Brandes 2001).

    Sources are spread over the cluster; each task walks its sources on the whole edge
    list, as numbers, and returns partial sums. Nothing is collected but that list.
    """
    pairs = stored(edges_.select("source", "target").distinct(), spark)
    ends = pairs.select(F.col("target").alias("id"), F.lit(-1).alias("_d")).unionByName(pairs.select(F.col("source").alias("id"), F.lit(0).alias("_d")))
    placed = stored(_placed_in_order(ends.groupBy("id").agg(F.sum("_d").alias("_d")), ["_d", "id"]).select("id", F.col("_at").alias("node")), spark)
    n = placed.count()
    a, b = placed.select(F.col("id").alias("source"), F.col("node").alias("_a")), placed.select(F.col("id").alias("target"), F.col("node").alias("_b"))
    numbers = pairs.join(sized(a), "source").join(sized(b), "target").select((F.shiftleft("_a", 32) + F.col("_b")).alias("e"))
    shared = numbers.agg(F.collect_list("e").alias("edges"))
    tasks = max(1, min(n, spark.sparkContext.defaultParallelism * 4))
    turns = spark.range(0, tasks, 1, tasks).select(F.col("id").alias("first"), F.lit(tasks).alias("step"), F.lit(n).alias("n"))
    sums = turns.crossJoin(F.broadcast(shared)).select(F.posexplode(between(spark, "edges", "n", "first", "step")).alias("node", "part"))
    total = sums.groupBy("node").agg(F.round(F.sum("part"), 3).alias("betweenness"))
    return placed.join(total, "node").select("id", "betweenness")


def layout(edges_: DataFrame, spark: SparkSession, iterations: int = 100, seed: int = 7, most: int = DISPLAY_EDGES) -> DataFrame:
    """(id, x, y): force-directed layout (Fruchterman and Reingold 1991), seeded.

    Repulsion is taken from the centres of the cells of a grid, so a step costs about n
    times the number of cells, which is n / 64. Edges come in order, so the places are the
    same for every partitioning.
    """
    placed, a, b, w = _arrays(edges_, spark, most)
    n = placed.count()
    if not n:
        return spark.createDataFrame([], "id string, x double, y double")
    random = np.random.default_rng(seed)
    at = random.uniform(-1, 1, (n, 2)) * math.sqrt(n)
    side = max(1, int(math.sqrt(n) / 8))
    for step in range(iterations):
        heat = math.sqrt(n) * 0.1 * (1 - step / iterations) + 1e-3
        low, high = at.min(0), at.max(0)
        cell = np.minimum(((at - low) / np.maximum(high - low, 1e-9) * side).astype(int), side - 1)
        flat = cell[:, 0] * side + cell[:, 1]
        mass = np.bincount(flat, minlength=side * side).astype(float)
        centre = np.stack([np.bincount(flat, at[:, k], side * side) for k in (0, 1)], 1) / np.maximum(mass, 1)[:, None]
        full = np.flatnonzero(mass)
        move = _pushed(at, centre[full], mass[full])
        d = at[a] - at[b]
        pull = d * (np.sqrt((d * d).sum(1)) * np.log1p(w))[:, None] * 0.1
        for k in (0, 1):
            move[:, k] += np.bincount(b, pull[:, k], n) - np.bincount(a, pull[:, k], n)
        length = np.sqrt((move * move).sum(1))
        at += move / np.maximum(length, 1e-9)[:, None] * np.minimum(length, heat)[:, None]
    points = spark.createDataFrame(pa.table({"node": np.arange(n), "x": at[:, 0], "y": at[:, 1]}))
    return placed.join(points, "node").select("id", "x", "y")


def normalised(points: DataFrame, extent: float = 1000.0) -> DataFrame:
    """Points centred on their bounding box, the larger half side scaled to ``extent``."""
    box = points.agg(*[f(c).alias(f"_{n}{c}") for c in ("x", "y") for n, f in (("lo", F.min), ("hi", F.max))])
    half = F.greatest((F.col("_hix") - F.col("_lox")) / 2, (F.col("_hiy") - F.col("_loy")) / 2)
    scale = F.lit(extent) / F.when(half == 0, 1.0).otherwise(half)
    placed = points.crossJoin(F.broadcast(box))
    return placed.select("id", *[((F.col(c) - (F.col(f"_lo{c}") + F.col(f"_hi{c}")) / 2) * scale).alias(c) for c in ("x", "y")])


def outsider_ring(outside: DataFrame, radius: float = 1280.0) -> DataFrame:
    """Nodes off the giant component, evenly on a ring by (component, id)."""
    total = outside.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("_n"))
    turned = _placed_in_order(outside, ["component", "id"]).withColumnRenamed("_at", "_i").crossJoin(F.broadcast(total))
    angle = F.col("_i") * (2 * math.pi) / F.col("_n")
    return turned.select("id", (F.cos(angle) * radius).alias("x"), (F.sin(angle) * radius).alias("y"))
