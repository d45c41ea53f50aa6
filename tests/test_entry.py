"""The driver contract: queries run, names of columns match the SQL, results agree."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

CHECKED = ["entries_by_volume_and_type", "headword_forms", "context_phrases", "graph_degrees", "type_chi_square", "ambiguous_terms", "export_edges", "dataset_checks", "pages_as_of", "letter_votes", "unreadable_letters", "life_dates", "references_in_texts", "reflowed_texts", "cleaned_entries", "healed_hyphens", "entry_payloads", "structure_checks", "name_index", "p4_found", "streamed_deliveries"]


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    return value if isinstance(value, (str, bool, int)) else float(f"{float(value):.9g}")


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["ref_table", "orphan_id", "period", "reason"]


@pytest.mark.parametrize("name", CHECKED)
def test_agrees_with_sql(spark, small, name):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    said = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in said.description]
    frame = entry.queries()[name](spark, small)
    assert sorted(frame.columns) == sorted(columns)
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    theirs = sorted(([plain(r[i]) for i in at] for r in said.fetchall()), key=repr)
    ours = sorted(([plain(r[c]) for c in order] for r in frame.collect()), key=repr)
    assert ours == theirs


def test_package_is_shipped_once(spark):
    from lemmaweave.sources import _SHIPPED, ship

    ship(spark)
    ship(spark)
    assert spark.sparkContext.applicationId in _SHIPPED


def test_runs_without_the_llm_package(tmp_path):
    """The rest must import and list its queries when the llm folder is gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/lemmaweave", tmp_path / "lemmaweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print('p3_found' in q, 'p1_found' in q, len(e.oracle_sql()) > 50)"], cwd=tmp_path, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert said.stdout.split() == ["True", "False", "True"], said.stderr
