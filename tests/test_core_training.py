"""Packed fields and orphan references: grammar cases, odd input, brute force."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from lemmaweave.operators import orphans, packed
from lemmaweave.operators.skew import heavy_values, join_by_value

PARSER = packed.Parser(packed.Grammar())


def items(text):
    return [i for i, e in PARSER.values(text) if e != "no_tail"]


def test_delimiters_marks_and_quotes():
    a, b, c = "A. Berg, Versuch des Zwecks, Altau 1701", "Kritik / Lehre. Studien der Norm, Sandau 1802, 12–40", "„Titel der Norm“, Nordau 1903 (repr. 1950)"
    for glue in ("; ", ";", " / ", " // ", "|", " • ", " · ", " — ", "\n", "\t"):
        assert items(glue.join([a, b, c])) == [a, b, c], glue
    assert items(f"1) {a} 2) {b} 3) {c}") == [a, b, c]
    assert items(f"(1) {a}\n(2) {b}") == [a, b]
    assert items(f"[1] {a}; [2] {b};") == [a, b]
    assert items(f"a) {a} b) {b}") == [a, b]
    assert items(f'"{a}", "{b}"') == [a, b]
    assert items(f"»{a}«, »{b}«") == [a, b]


def test_quoted_values_may_hold_delimiters_and_quotes():
    text = '"Lehre; der Norm, Altau 1701","B. Berg, ""Versuch"" des Zwecks, Sandau 1802"'
    assert items(text) == ["Lehre; der Norm, Altau 1701", 'B. Berg, "Versuch" des Zwecks, Sandau 1802']


def test_malformed_quotes_fall_back_and_are_flagged():
    got = list(PARSER.values('"Lehre der Norm, Altau 1701; Kritik der Norm, Sandau 1802'))
    assert len(got) == 2 and got[0][1] == "open_quote"


def test_empty_slots_take_no_position():
    assert items("; A, Altau 1701 ; ; B, Altau 1702;") == ["A, Altau 1701", "B, Altau 1702"]
    assert items("") == items("   ") == list(PARSER.values(None)) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["Lehre", "Kritik der Norm", "Versuch / Zweck. Studien"]), st.integers(1500, 2020)), min_size=1, max_size=9), st.sampled_from([";", " • ", "\n", " | "]))
def test_round_trip(works, glue):
    values = [f"{t}, Altau {y}" for t, y in works]
    assert items(glue.join(values)) == values


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet='ab1. ;"()„“[]/\n1990', max_size=60))
def test_any_text_ends(text):
    assert sum(len(i) for i, _ in PARSER.values(text)) <= len(text)


def test_split_rows(spark):
    rows = [("1", "A, Altau 1701; B, Altau 1702", None, 5), ("1", "A, Altau 1701; B, Altau 1702", None, 6), ("2", "A, Altau 1701", "", 7), (None, "A, Altau 1701; A, Altau 1701", None, 8), ("4", "A, Altau 1701; " * 3000, None, 9)]
    frame = spark.createDataFrame(rows, "id string, werke string, literatur string, pos int")  # pos clashes with a result column
    got = packed.split_rows(frame.select("id", "werke", "literatur"), ["id"], ["werke", "literatur"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append((r.pos, r["item"]))
    assert sorted(by["1"]) == [(1, "A, Altau 1701"), (2, "B, Altau 1702")]
    assert "2" not in by and sorted(by[None]) == [(1, "A, Altau 1701"), (2, "A, Altau 1701")] and len(by["4"]) == 3000
    assert packed.split_rows(frame.limit(0), ["id"], ["werke"]).count() == 0


def test_split_rows_keeps_items_without_a_year(spark):
    rows = [("1", "A. Berg, Lehre, Altau 1701; Kant, Kritik, Riga o. J."), ("2", "A, o. J.; B, Ort 1812"), ("3", "Kant, Kritik, Riga o.J.; Berg, Lehre, Altau s. a."), ("4", "A. Berg, Lehre, Altau 1701; Kant, Kritik, Riga"), ("5", "Kant, Kritik, Riga 1781; Nachweise"), ("6", "Kant, Kritik, Riga 1781; Berg, „Lehre“, <i")]
    got = packed.split_rows(spark.createDataFrame(rows, "id string, werke string"), ["id"], ["werke"]).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.id, r.pos)):
        by.setdefault(r.id, []).append((r["item"], r.error))
    assert by == {"1": [("A. Berg, Lehre, Altau 1701", None), ("Kant, Kritik, Riga o. J.", None)], "2": [("A, o. J.", None), ("B, Ort 1812", None)], "3": [("Kant, Kritik, Riga o.J.", None), ("Berg, Lehre, Altau s. a.", None)], "4": [("A. Berg, Lehre, Altau 1701", None), ("Kant, Kritik, Riga", "no_tail")]}


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_orphans_against_brute_force(spark):
    parents = [("a", day(0), None), ("a", day(40), None), ("b", day(5), day(9)), ("c", day(50), None), (None, day(1), None), ("d", None, None)]
    refs = [(k, day(n)) for k in ("a", "b", "c", "d", "x", "", None) for n in (0, 3, 33, 60, 60)] + [("c", None), ("x", None)]
    p = spark.createDataFrame(parents, "id string, loaded_at timestamp, deleted_at timestamp")
    r = spark.createDataFrame(refs, "k string, loaded_at timestamp")
    expected = set()
    for k, at in refs:
        if k is None:
            continue
        own = [x for x in parents if x[0] == k]
        first = min((x[1] for x in own if x[1]), default=None)
        reason = "missing" if not own else "deleted" if any(x[2] for x in own) else "late" if first and at and first > at else None
        if reason:
            expected.add(("t", k, at.strftime("%Y-%m") if at else None, reason))
    got = orphans.found([(r, "t", "k")], p)
    assert {tuple(x) for x in got.collect()} == expected and got.count() == len(expected)
    assert orphans.found([(r, "t", "k")], p.limit(0)).where("reason <> 'missing'").count() == 0
    assert orphans.found([(r.limit(0), "t", "k")], p).count() == 0
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_join_by_value_keeps_every_row(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(900)] + [(f"v{i}", i) for i in range(100)] + [(None, 1)], "v string, i int")
    mapping = spark.createDataFrame([("hot", 1), ("v3", 2)], "v string, m int")
    counts = rows.groupBy("v").count().withColumnRenamed("count", "n")
    heavy = heavy_values(counts, "v", "n", 0.3)
    assert [r.v for r in heavy.collect()] == ["hot"]
    assert join_by_value(rows, mapping, "v", heavy).count() == 901
    assert join_by_value(rows, mapping, "v", heavy, "left").count() == 1001
