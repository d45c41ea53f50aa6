"""The pipeline as named stages, each a table of its own that later stages read.

A run writes every stage as parquet under one folder (shared by the cluster) and can start
again from any of them: earlier stages are then read, not made. All settings are in one
frozen record, which the manifest repeats.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaweave.operators import dates, display, graph, lemmas, resolve, search, story
from lemmaweave.sources import sinks, table


@dataclass(frozen=True)
class Config:
    """Settings of a run; every value is written to the manifest."""

    statuses: tuple[str, ...] = ("same_volume", "cross_volume", "deinflected", "slash_half")
    least_community: int = 12
    palette: int = 20
    boost: float = 8.0
    extent: float = 1000.0
    ring: float = 1.28
    least_radius: float = 1.6
    most_radius: float = 11.0
    iterations: int = 100
    seed: int = 7
    top_hubs: int = 30
    most_hops: int = 3
    only: str | None = None


Stage = Callable[["Run"], DataFrame]


class Run:
    """Stages over the tables in ``root``, kept under ``folder``."""

    def __init__(self, spark: SparkSession, root: str, folder: str, config: Config = Config()) -> None:
        self.spark, self.root, self.folder, self.config = spark, root, folder, config

    def read(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{stage}")

    def make(self, start_from: str | None = None) -> list[str]:
        """Make all stages, or those from ``start_from`` on; returns the names made.

        A graph beyond display size gets no places; nothing else depends on them.
        """
        names = list(STAGES)
        made = names[names.index(start_from) :] if start_from else names
        skipped = []
        for name in made:
            try:
                STAGES[name](self).write.mode("overwrite").parquet(f"{self.folder}/{name}")
            except graph.TooLarge:
                skipped.append(name)
        return [n for n in made if n not in skipped]

    def export(self) -> dict:
        """Sinks for readers of files: records, graph, search rows, shards, manifest."""
        out = f"{self.folder}/export"
        sinks.csv(sinks.edges_export(self.read("references"), self.read("resolved"), self.read("entries")), f"{out}/edges", ["source_entry_id", "ordinal"])
        sinks.csv(self.read("lemmas"), f"{out}/lemmas", ["lemma_key", "entry_id"])
        sinks.csv(sinks.ambiguous_export(self.read("references"), self.read("candidates"), self.read("entries")), f"{out}/ambiguous", ["source_entry_id", "ordinal"])
        flags = table(self.spark, self.root, "entry_flags")
        sinks.jsonl(sinks.entries_export(self.read("entries"), flags), f"{out}/entries")
        try:
            nodes = self.read("placed").withColumn("x", F.round("x", 2)).withColumn("y", F.round("y", 2))
        except AnalysisException:  # beyond display size
            nodes = self.read("nodes").join(self.read("communities"), "id")
        sinks.jsonl(nodes, f"{out}/graph_nodes")
        sinks.jsonl(self.read("edges"), f"{out}/graph_edges")
        sinks.jsonl(self.read("search"), f"{out}/search")
        sinks.shards(self.read("payloads"), f"{out}/shards")
        return sinks.manifest(story.corpus_counts(self.read("entries"), self.read("resolved")), asdict(self.config))


def _entries(run: Run) -> DataFrame:
    return resolve.latest(table(run.spark, run.root, "entries"))


def _resolved(run: Run) -> DataFrame:
    return resolve.run(table(run.spark, run.root, "entries"), table(run.spark, run.root, "cross_references"), run.config.only, run.config.most_hops)


def _placed(run: Run) -> DataFrame:
    """Nodes with place, radius, community and in-degree; outsiders on a ring."""
    c, edges, nodes, groups = run.config, run.read("edges"), run.read("nodes"), run.read("communities")
    parts = graph.components(edges, nodes, run.spark)
    giant = parts.groupBy("component").count().orderBy(F.desc("count"), "component").limit(1).select("component")
    inside = parts.join(F.broadcast(giant), "component", "left_semi").select("id")
    inner = graph.normalised(graph.layout(graph.boosted(edges, groups, c.boost), run.spark, c.iterations, c.seed), c.extent)
    ring = graph.outsider_ring(parts.join(F.broadcast(giant), "component", "left_anti"), c.extent * c.ring)
    points = inner.join(inside, "id", "left_semi").unionByName(ring)
    sized = graph.radii(graph.degrees(edges, nodes), c.least_radius, c.most_radius)
    return nodes.join(points, "id").join(sized.select("id", "in_degree", "radius"), "id").join(groups, "id")


STAGES: dict[str, Stage] = {
    "entries": _entries,
    "references": lambda r: resolve.delivered(table(r.spark, r.root, "cross_references")),
    "resolved": _resolved,
    "candidates": lambda r: resolve.candidates(r.read("resolved"), resolve.index(r.read("entries"))),
    "lemmas": lambda r: lemmas.variants(r.read("entries"), r.read("resolved")),
    "dates": lambda r: dates.extract(r.read("entries")),
    "nodes": lambda r: graph.nodes(r.read("entries")),
    "edges": lambda r: graph.edges(r.read("resolved"), r.read("nodes"), list(r.config.statuses)),
    "communities": lambda r: graph.ranked_communities(graph.communities(r.read("edges"), r.read("nodes"), r.spark), r.config.least_community),
    "named": lambda r: graph.described(r.read("communities"), r.read("nodes"), graph.degrees(r.read("edges"), r.read("nodes"))),
    "placed": _placed,
    "search": lambda r: search.index(r.read("lemmas"), r.read("nodes")),
    "payloads": lambda r: display.payloads(r.read("entries"), r.read("resolved"), r.read("nodes")),
}
