"""The staged pipeline: every stage, resuming, exports."""

from __future__ import annotations

import os

from lemmaweave.plans.stages import STAGES, Config, Run


def test_stages(spark, small, tmp_path):
    run = Run(spark, small, str(tmp_path), Config(iterations=3, least_community=3))
    assert run.make() == list(STAGES)
    assert run.make("search") == ["search", "payloads"]
    nodes, placed = run.read("nodes"), run.read("placed")
    assert nodes.count() == placed.count() == placed.select("id").distinct().count()
    assert run.read("resolved").count() == run.read("references").count()
    manifest = run.export()
    assert manifest["parameters"]["least_community"] == 3 and sum(manifest["entry_type"].values()) == run.read("entries").count()
    assert {"edges", "lemmas", "ambiguous", "entries", "graph_nodes", "graph_edges", "search", "shards"} <= set(os.listdir(tmp_path / "export"))
    assert spark.read.option("header", True).option("multiLine", True).option("escape", "\"").csv(str(tmp_path / "export" / "edges")).count() == run.read("resolved").count()
