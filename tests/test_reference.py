"""Rules of the reference operators on small fixtures and against brute force."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from lemmaweave.functions import text as T
from lemmaweave.operators import dates, display, graph, layout, lemmas, parse, resolve, search, story, votes

NOW = dt.datetime(2024, 1, 1)


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    ("value", "function", "expected"),
    [
        ("Größe (logisch)", T.key, "grosse logisch"), ("É Ä", T.key, "é a"), ("ens, ›Seiende,", T.lemma, "ens"), ("Logik, algebraische", T.lemma, "Logik, algebraische"), ("Summe (logisch)", T.core, "Summe"),
        ("Logik, algebraische", T.comma_inverted, "algebraische Logik"), ("Kant, Immanuel", T.comma_inverted, None), ("a, b, c", T.comma_inverted, None), ("das Absurde", T.without_article, "Absurde"),
        ("a_b_c __ _x_", T.strip_italics, "abc __ x"), ("a_b c", T.strip_italics, "a_b c"), ("x<sup>2</sup> **f**  \n\n\n y*", T.clean, "x^2 f\n\ny"), ("S´ a<sup>¯</sup>", T.clean, "Ś ā"), ("↦ → ⇋ ⇋", T.clean, "↦ ⇋"), (None, T.clean, None),
        ("ver- deckt Vor- und Nachteil", T.heal_hyphens, "verdeckt Vor- und Nachteil"), ("<a href=\"b\">&'", T.escape_html, "&lt;a href=&quot;b&quot;&gt;&amp;&#39;"), ("Bd01_A-B:0001:0002", T.volume_of, "Bd01_A-B"),
    ],
)
def test_text_functions(spark, value, function, expected):
    assert one(spark, value, function("x")) == expected


def test_phrases_and_names(spark):
    assert one(spark, "Philosophie, praktische) und so weiter und mehr", T.phrases("x"))[-1] == "Philosophie, praktische"
    assert len(one(spark, "eins zwei drei vier fünf sechs sieben", T.phrases("x"))) == 5
    row = spark.createDataFrame([("Ariston", "Ariston von Chios, Stoiker"), ("Bernoulli", "Bernoulli, Daniel, Groningen")], "h string, b string").select(T.display_name("h", "b").alias("n")).collect()
    assert [r.n for r in row] == ["Ariston von Chios", "Bernoulli, Daniel"]
    assert [r.c for r in spark.range(21).select(T.palette_color("id").alias("c")).collect()][::20] == ["#ed8989", "#6b7280"]


def entry(i, volume, headword, kind="subject_article"):
    return (f"{volume}:0001:{i:04d}", volume, i, headword, kind, NOW, "")


ENTRIES = [
    entry(1, "V1", "Logik"), entry(2, "V1", "Logik, algebraische"), entry(3, "V2", "Logik, mehrwertige"), entry(4, "V2", "objektiv/Objektivität"), entry(5, "V2", "Seiende"),
    entry(6, "V1", "ens, ↑Seiende", "redirect"), entry(7, "V1", "Ariston"), entry(8, "V2", "Ariston"), entry(9, "V1", "a priori, fundamentaler Terminus"), entry(10, "V3", "das Absurde"), entry(11, "V3", "entia, ↑ens", "redirect"),
]


def frames(spark, refs):
    e = spark.createDataFrame(ENTRIES, "id string, volume string, ordinal int, headword string, entry_type string, loaded_at timestamp, body_text string")
    base = [("V1:0001:0006", 0, "Seiende", "Seiende", NOW), ("V3:0001:0011", 0, "ens", "ens", NOW)]
    x = spark.createDataFrame([*base, *[(a, b, c, d, NOW) for a, b, c, d in refs]], "entry_id string, ordinal int, raw_target string, raw_context string, loaded_at timestamp")
    return e, x


def test_resolver_branches(spark):
    cases = {
        ("Logik", "Logik"): ("cross_volume", "V1:0001:0001", 0, 1), ("Logik", "Logik, mehrwertige) und"): ("same_volume", "V2:0001:0003", 0, 2), ("Absurden", "Absurden"): ("deinflected", "V3:0001:0010", 0, 1),
        ("Objektivität", "Objektivität"): ("slash_half", "V2:0001:0004", 0, 1), ("objektiv/Objektivität", "objektiv/Objektivität"): ("slash_half", "V2:0001:0004", 0, 1), ("ens", "ens"): ("cross_volume", "V2:0001:0005", 1, 1),
        ("entia", "entia"): ("cross_volume", "V2:0001:0005", 2, 1), ("a", "a priori ist"): ("cross_volume", "V1:0001:0009", 0, 2), ("a", "a"): ("unresolved", None, 0, 1), ("nichts", None): ("unresolved", None, 0, 1), (None, None): ("unresolved", None, 0, 1),
        ("Ariston", "Ariston"): ("same_volume", "V2:0001:0008", 0, 1),
    }
    refs = [("V2:0001:0004", i, t, c) for i, (t, c) in enumerate(cases)] + [("V3:0001:0010", 0, "Ariston", "Ariston")]
    e, x = frames(spark, refs)
    got = resolve.run(e, x)
    rows = {(r.entry_id, r.ordinal): r for r in got.collect()}
    assert len(rows) == len(refs) + 2
    for i, (case, (status, target, hops, n)) in enumerate(cases.items()):
        r = rows["V2:0001:0004", i]
        assert (r.status, r.resolved_entry_id, r.redirect_hops, r.match_words) == (status, target, hops, n), case
    assert rows["V3:0001:0010", 0].status == "ambiguous"
    candidates = {r.candidate_entry_id for r in resolve.candidates(got, resolve.index(resolve.latest(e))).where("entry_id = 'V3:0001:0010'").collect()}
    assert candidates == {"V1:0001:0007", "V2:0001:0008"}
    assert resolve.run(e, x, only="V3").where("entry_id LIKE 'V2%'").count() == 0
    assert resolve.run(e, x.limit(0)).count() == 0 and resolve.run(e.limit(0), x).where("status <> 'unresolved'").count() == 0
    names = {(r.lemma_key, r.entry_id, r.variant_type) for r in lemmas.variants(resolve.latest(e), got).collect()}
    assert ("algebraische logik", "V1:0001:0002", "comma_inverted") in names and ("ens", "V2:0001:0005", "redirect_alias") in names and ("objektivitat", "V2:0001:0004", "slash_half") in names


LIVES = [
        ("*Altau 1701, †Sandau 1777, Gelehrte", (1701, 0, 1777, 0, "")), ("*428/427 v. Chr., †348/347 v. Chr.", (428, 1, 348, 1, "")), ("*Altau 384 v. Chr., †322", (384, 1, 322, 1, "")), ("*Altau 106 v. Chr., †43", (None,) * 4 + ("no death year after dagger",)), ("*63 v. Chr., †14 n. Chr.", (63, 1, 14, 0, "")), ("Ohne Jahre", (None, None, None, None, "no dagger in head")),
        ("*3. Jan. 1701, †7. Dez. 1777", (1701, 0, 1777, 0, "")), ("(*1701 †1777)", (None,) * 4 + ("dagger inside parentheses",)), ("*1701/1705, †1777", (None,) * 4 + ("birth: alternative wider than one year",)), ("*zwischen 1701, †1777", (None,) * 4 + ("birth: part of a range",)),
        ("Ein kurzer Satz. Dann *1701, †1777", (None,) * 4 + ("sentence ends before dagger",)), ("*1777, †1701", (None,) * 4 + ("birth not before death (era marker missing?)",)), ("*1501, †1777", (None,) * 4 + ("implausible lifespan",)), (None, (None,) * 4 + ("no dagger in head",)),
    ("um 560, †ebendort um 480 v. Chr.", (560, 1, 480, 1, "")), ("1265 oder 1266, †Köln 8. Nov. 1308", (1265, 0, 1308, 0, "")), ("um 1214 oder 1219, †1292", (None,) * 4 + ("birth: alternative wider than one year",)), ("*1701, †zwischen 1747 und 1749", (None,) * 4 + ("death: part of a range",)),
    ("*1889, †" + "x" * 117 + " 1941 in", (1889, 0, 1941, 0, "")), ("*1701, †" + "x" * 130 + "1777", (None,) * 4 + ("no death year after dagger",)), ("", (None,) * 4 + ("no dagger in head",)), ("x" * 600 + "*1701 †1777", (None,) * 4 + ("no dagger in head",)),
    ("Prof. Abel, *1701/02/03, †9. 1777.", (None,) * 4 + ("no birth year before dagger",)), ("*1701–1705, †1777", (None,) * 4 + ("birth: part of a range",)),
]


def test_life_dates(spark):
    frame = spark.createDataFrame([(i, body) for i, (body, _) in enumerate(LIVES)], "i int, body string")
    got = {r.i: (*(r[c] for c in dates.DATES), r.reason) for r in dates.lives(frame, "body").collect()}
    assert got == {i: expected for i, (_, expected) in enumerate(LIVES)}


def test_life_dates_frame(spark):
    rows = spark.createDataFrame([("1", "biography", "*Altau 1701, †Sandau 1777"), ("2", "redirect", "*1701 †1777"), ("3", "unknown", None)], "id string, entry_type string, body_text string")
    hand = spark.createDataFrame([("3", 384, 1, 322, 1)], "id string, birth_year int, birth_bc int, death_year int, death_bc int")
    got = {r.id: (r.birth_year, r.dated) for r in dates.extract(rows, hand).collect()}
    assert got == {"1": (1701, 1), "3": (384, 1)}


TAGGED = """<!-- page:1 printed:9 -->
# **A**
<!-- entry:Abel -->
Abel, Körper und Geist (↑Logik) ver-
<!-- page:2 printed:10 -->
bunden mit ↑Philo- sophie und ↑Vor- und Nachteil. Werke: Lehre, Altau 1701. Literatur: Kritik, Sandau 1802. A. B.

## <!-- entry:Babel, -->
**Babel,**
<!-- entry:Turm -->
Text ohne Apparat.

<!-- entry:ens -->
ens, ↑Seiende.
"""


def test_parser(spark):
    got = {r.headword: r for r in parse.records(spark.createDataFrame([("V1", TAGGED), ("V2", None), ("V3", "kein Eintrag")], "volume string, text string")).collect()}
    abel = got["Abel"]
    assert (abel.entry_type, abel.author_sigil, abel.werke_raw, abel.literatur_raw) == ("biography", "A. B.", "Lehre, Altau 1701.", "Kritik, Sandau 1802.")
    assert (abel.pdf_page_start, abel.pdf_page_end, abel.printed_page_start, abel.id) == (1, 2, 9, "V1:0001:0001")
    assert "verbunden" in abel.body_text and [r.word for r in abel.cross_references] == ["Logik", "Philosophie", "Vor-"]
    assert set(got["Babel, Turm"].flags) == {"split_headword_merged", "heading_promoted"} and got["Babel, Turm"].entry_type == "unknown"
    assert got["ens"].entry_type == "redirect" and len(got) == 3


def test_reflow_and_marks(spark):
    source = "Der Mensch ver-\nlangt nach\nSinn. Leib-\nSeele, Vor-\nund Nachteil.\nNeu hier ↑Logik."
    cases = [(source, ["Logik"]), ("Neu\nhier ↑Logik.", ["Logik", "x"]), ("Neu ↑Logik.", ["Ethik"]), (None, ["x"]), ("", ["x"]), ("Siehe ↑Philo-\nsophie und ↑Vor-\nund ↑Ende-\n", ["Philosophie", "Vor-", "Ende-"]), ("Ein „Wort.“\n(Neu)\n\nund so", [])]
    frame = spark.createDataFrame([(i, t, w) for i, (t, w) in enumerate(cases)], "i int, t string, w array<string>")
    got = {r.i: (r.body, r.marks) for r in display.with_marks(frame, "t", "w").collect()}
    assert got[0][0] == "Der Mensch verlangt nach Sinn. Leib-Seele, Vor- und Nachteil.\n\nNeu hier ↑Logik." and got[0][0][got[0][1][0][0] : got[0][1][0][1]] == "↑Logik"
    assert got[1] == ("Neu hier ↑Logik.", [[9, 15, 0]]) and got[2] == ("Neu ↑Logik.", None) and got[3] == (None, None) and got[4] == ("", None)
    body, marks = got[5]
    assert body == "Siehe ↑Philosophie und ↑Vor- und ↑Ende-\n\n" and [body[a:b] for a, b, _ in marks] == ["↑Philosophie", "↑Vor-", "↑Ende-"]
    assert got[6] == ("Ein „Wort.“ (Neu) und so", [])


def test_graph_against_brute_force(spark):
    random.seed(3)
    ids = [f"n{i:02d}" for i in range(30)]
    pairs = [(a, b) for a, b in itertools.permutations(ids[:25], 2) if random.random() < 0.06]
    nodes = spark.createDataFrame([(i, i) for i in ids], "id string, headword string")
    edges = spark.createDataFrame([(a, b, 2) for a, b in pairs], "source string, target string, weight long")
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {r.id: r.component for r in graph.components(edges, nodes, spark).collect()} == {i: root(i) for i in ids}
    out = {i: [b for a, b in pairs if a == i] for i in ids}
    score = dict.fromkeys(ids, 0.0)
    for s, t in itertools.permutations(ids, 2):
        paths, level = [[s]], []
        seen = {s}
        while paths and not level:
            paths = [[*p, n] for p in paths for n in out[p[-1]] if n not in seen]
            seen |= {p[-1] for p in paths}
            level = [p for p in paths if p[-1] == t]
        for p in level:
            for v in p[1:-1]:
                score[v] += 1 / len(level)
    got = {r.id: r.betweenness for r in graph.betweenness(edges, spark).collect()}
    assert all(abs(got.get(i, 0) - score[i]) < 2e-3 for i in ids)
    assert graph.layout(graph.undirected(edges), spark, 5).count() == len({x for p in pairs for x in p})
    box = graph.normalised(graph.layout(graph.undirected(edges), spark, 5)).agg(F.max(F.abs("x")), F.max(F.abs("y"))).first()
    assert abs(max(box) - 1000) < 1e-6
    assert graph.components(edges.limit(0), nodes, spark).where("id <> component").count() == 0


def test_communities_of_a_planted_partition(spark):
    random.seed(5)
    ids = [f"n{i:02d}" for i in range(36)]
    pairs = [(a, b, 3) for i, a in enumerate(ids) for j, b in enumerate(ids) if i < j and random.random() < (0.8 if i // 12 == j // 12 else 0.03)]
    nodes = spark.createDataFrame([(i, i) for i in [*ids, "lone"]], "id string, headword string")
    edges = spark.createDataFrame(pairs, "source string, target string, weight long")
    got = graph.communities(edges, nodes, spark, 1.0)
    found = {r.id: r.label for r in got.collect()}
    assert len(found) == 37 and len({found[i] for i in ids}) == 3
    assert all(len({found[i] for i in ids[k * 12 : k * 12 + 12]}) == 1 for k in range(3))
    planted = nodes.where("id <> 'lone'").select("id", F.floor(F.substr("id", F.lit(2)).cast("int") / 12).alias("label"))
    q = lambda f: graph.modularity(edges, f, "label").first().modularity
    assert q(got) == q(planted) > 0.4
    # Ranked by size, ties by label; below the floor there is none.
    assert {r.community for r in graph.ranked_communities(got).collect()} == {0, 1, 2, -1}
    assert graph.communities(edges.limit(0), nodes, spark).where("id <> label").count() == 0


def test_components_with_a_hub_and_a_giant(spark):
    pairs = [("hub", f"a{i:03d}") for i in range(300)] + [(f"b{i:03d}", f"b{i + 1:03d}") for i in range(60)]
    edges = spark.createDataFrame([(a, b, 1) for a, b in pairs], "source string, target string, weight long")
    nodes = spark.createDataFrame([(i,) for i in sorted({x for p in pairs for x in p})], "id string")
    found = {r.id: r.component for r in graph.components(edges, nodes, spark).collect()}
    assert set(found.values()) == {"a000", "b000"} and all((found[i] == "b000") == (i[0] == "b" ) for i in found)


def test_numbering_is_dense(spark):
    nodes = spark.range(0, 500, 1, 7).select(F.concat(F.lit("x"), F.lpad("id", 4, "0")).alias("id"), F.lit("V").alias("volume"), (F.col("id") % 10).cast("int").alias("ordinal"))
    got = graph.numbered(nodes).orderBy("node").collect()
    assert [r.node for r in got] == list(range(500)) and [(r.ordinal, r.id) for r in got] == sorted((r.ordinal, r.id) for r in got)


def test_votes_layers_islands(spark):
    unknown = spark.createDataFrame([("1", "K", "nnen"), ("1", "L", "we"), ("2", "M", "l")], "code string, prefix string, suffix string")
    known = spark.createDataFrame([("Können", 9), ("Kannen", 1), ("Löwe", 3), ("Mal", 2), (None, 1)], "word string, n long")
    assert [(r.code, r.letter, r.votes) for r in votes.vote(unknown, known).collect()] == [("1", "ö", 12)]
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "a")], "i int, v string").withColumn("p", F.lit(1))
    assert [r.n for r in votes.islands(rows, ["p"], ["i"], "v").orderBy("first").collect()] == [2, 2, 1]


def test_search_and_story(spark):
    rows = spark.createDataFrame([("logik", "Logik", "1", "primary", "Logik"), ("logik algebraische", "Logik, algebraische", "2", "primary", "L"), ("modallogik", "Modallogik", "3", "primary", "M"), (None, "x", "4", "primary", "x")], "lemma_key string, lemma string, entry_id string, variant_type string, headword string")
    assert [r.entry_id for r in search.query(rows, "Logik").collect()] == ["1", "2", "3"]
    assert search.query(rows, "L").count() == 0 and search.matches(rows, "logik").count() == 3
    labels = spark.createDataFrame([(0, "a"), (1, "b")], "community int, anchor string")
    now = spark.createDataFrame([(0, "a"), (1, "c"), (2, "d")], "community int, anchor string")
    assert {r.community: r.verdict for r in story.label_check(labels, now).collect()} == {0: "ok", 1: "stale", 2: "missing"}
    assert {r.era: r.n for r in story.eras(spark.createDataFrame([(-428,), (500,), (1900,), (None,)], "birth int")).collect()} == {"antiquity": 1, "middle_ages": 1, "early_modern": 0, "nineteenth": 0, "modern": 1}


def test_layout(spark):
    spans = [("V", 1, 0, 0, 0, "Hegelsche Logik", "Bold", True)] + [("V", 1, b, 0, s, t, f, False) for b, s, t, f in ((1, 0, "Hegelsche", "Bold"), (2, 0, "Logik", "Bold"), (2, 1, ", Lehre von, etwas", "Roman"), (3, 0, "kein Kopf", "Roman"), (4, 0, "Abel", "Bold"))]
    frame = spark.createDataFrame(spans, "volume string, page int, block int, line int, span int, text string, font string, full_width boolean")
    found = layout.lines(frame, "Bold")
    heads, wanted = layout.running_heads(found), layout.candidates(found)
    assert [r["head"] for r in heads.collect()] == ["Hegelsche Logik"]
    assert {r.lemma: r.anchor for r in wanted.collect()} == {"Hegelsche": "Hegelsche", "Logik": "Logik, Lehre von,", "Abel": "Abel"}
    pages = spark.createDataFrame([("V", 1, "Hegelsche Logik\n\n17\n\nText vorher.\n\n**Hegelsche** _Logik_, Lehre von, etwas\n\nAbel und Abel"), ("V", 2, None)], "volume string, page int, text string")
    got = {r.page: r for r in layout.tagged(pages, wanted, heads).collect()}
    assert got[1].printed_page == 17 and "<!-- entry:Hegelsche Logik -->**Hegelsche**" in got[1].text and got[2].text is None
    assert "\n\n<!-- entry:Abel -->Abel und Abel" in got[1].text and not got[1].text.startswith("Hegelsche Logik")
    assert {r.verdict: r.n for r in layout.diagnosis(layout.tagged(pages, wanted, heads)).collect()} == {"tagged": 2}
    starts = spark.createDataFrame([("V", 2)], "volume string, first_page int")
    assert [r.page for r in layout.in_body(pages, starts).collect()] == [2]
    assert layout.place("Abel\nAbel", "Abel") == ("ambiguous", None) and layout.place("x", " ") == ("empty_anchor", None)


def test_as_of_over_stretches(spark):
    random.seed(2)
    events = [(v, i) for v in "ab" for i in range(0, 400, 3)]
    marks = {(v, i): random.randint(1, 9) for v in "ab" for i in random.sample(range(5, 400), 25)}
    rows = spark.createDataFrame(events, "v string, at int")
    known = spark.createDataFrame([(v, i, x) for (v, i), x in marks.items()], "v string, at int, page int")
    expected = {(v, i): next((marks[v, j] for j in range(i, -1, -1) if (v, j) in marks), None) for v, i in events}
    for width in (7, 50, 10_000):
        assert {(r.v, r["at"]): r.page for r in votes.as_of(rows, known, ["v"], "at", "page", width).collect()} == expected


def test_joins_with_null_and_hot_keys(spark):
    from lemmaweave.operators.skew import join_nullable, sized

    rows = spark.createDataFrame([(i, None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{i}") for i in range(900)], "i int, k string")
    other = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(0, 900, 2)]], "k string, v int")
    expected = {i: {0: None, 1: 1}.get(i % 3, i if i % 2 == 0 else None) for i in range(900)}
    got = join_nullable(rows, other, "k")
    assert got.count() == 900 and {r.i: r.v for r in got.collect()} == expected
    assert sized(other, 10).join(rows, "k").count() == sized(other).join(rows, "k").count() == 450


def test_structure_checks(spark):
    from lemmaweave.operators import checks

    e = spark.createDataFrame([("a", "V", 1, 5, 6, "unknown"), ("b", "V", 2, 4, 3, "redirect"), ("c", "V", 2, 80, 180, "unknown"), ("d", None, None, None, None, "unknown")], "id string, volume string, ordinal int, pdf_page_start int, pdf_page_end int, entry_type string")
    r = spark.createDataFrame([("a", 0, "b", "same_volume", 4, 1), ("c", 1, None, "unresolved", 0, 9)], "entry_id string, ordinal int, resolved_entry_id string, status string, redirect_hops int, match_words int")
    x = r.select("entry_id", "ordinal")
    nodes = e.where("entry_type <> 'redirect'").select("id")
    edges = spark.createDataFrame([("a", "a"), ("a", "z")], "source string, target string")
    got = {c.check: c.violations for c in checks.structure(e, x, r, edges, nodes).collect()}
    assert got == {
        "page before that of the entry before": 1, "page span reversed": 1, "page span too long": 1, "ordinal below 1": 1, "hops out of bounds": 1, "match words out of bounds": 1, "redirect leads nowhere": 1, "reference ends at a redirect": 1,
        "node without an edge": 2, "edge end is no node": 1, "edge to itself": 1, "references not numbered through": 1, "place taken twice": 1, "volumes do not add up": 0, "statuses do not add up": 0,
    }
    a = spark.createDataFrame([("V", 3), ("W", 1)], "volume string, n long")
    b = spark.createDataFrame([("V", 3), ("X", 2)], "volume string, n long")
    assert {tuple(c) for c in checks.compared(a, b, ["volume"]).collect()} == {("W", 1, 0), ("X", 0, 2)}


def test_no_row_limits_in_layout(spark):
    volumes = spark.range(3).select(F.concat(F.lit("V"), "id").alias("volume"), F.lit(2).alias("first_page"))
    pages = volumes.select("volume", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("page"), F.lit("x").alias("text"))
    assert layout.in_body(pages, volumes).count() == 6
    codes = spark.range(400).select(F.concat(F.lit("/C"), "id").alias("name"))
    table_ = spark.range(400).select(F.col("id").cast("int").alias("code"), F.lit("x").alias("letter"))
    assert layout.decoded_names(codes, table_).where("letter IS NULL").count() == 0


def test_a_cluster_must_name_its_folder(monkeypatch):
    from lemmaweave import sources

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError):
        sources.shared_folder(Session())


def test_betweenness_leaves_no_walk_to_python(spark):
    """Half of 400 leaves lead to a hub, over two ways to a second one, to the other half."""
    pairs = [(f"in{i}", "a") for i in range(200)] + [("a", "up"), ("a", "low"), ("up", "b"), ("low", "b")] + [("b", f"out{i}") for i in range(200)]
    edges = spark.createDataFrame([(*p, 1) for p in pairs], "source string, target string, weight long")
    found = graph.betweenness(edges, spark)
    assert "InPandas" not in found._jdf.queryExecution().toString()
    got = {r.id: r.betweenness for r in found.collect()}
    assert len(got) == 404 and {i: v for i, v in got.items() if v} == {"a": 200 * 203.0, "b": 203 * 200.0, "up": 201 * 201 / 2, "low": 201 * 201 / 2}
    degrees = graph.degrees(edges, spark.createDataFrame([(i,) for i in got], "id string"))
    bridges = [(r.id, r.betweenness, r.b_rank) for r in story.bridges(degrees, found, 4, 2).collect()]
    assert bridges == [("low", 20200.5, 2), ("up", 20200.5, 3)]


def test_layout_of_more_edges_than_before(spark):
    """Beyond 200,000 edges there are places too, the same for every partitioning."""
    import numpy as np

    ids = spark.range(650).select(F.format_string("n%03d", "id").alias("a"))
    pairs = ids.crossJoin(ids.withColumnRenamed("a", "b")).where("a < b").withColumn("weight", F.lit(1))
    one = {r.id: (r.x, r.y) for r in graph.layout(pairs, spark, 2).collect()}
    assert len(one) == 650 and pairs.count() > 200_000
    assert one == {r.id: (r.x, r.y) for r in graph.layout(pairs.repartition(3, "b"), spark, 2).collect()}
    rng = np.random.default_rng(1)
    at, centre, mass = rng.normal(size=(300, 2)) * 20, rng.normal(size=(40, 2)) * 20, rng.integers(1, 9, 40).astype(float)
    d = at[:, None] - centre[None]
    assert np.allclose(graph._pushed(at, centre, mass, 1000), (d * (mass / np.maximum((d * d).sum(2), 0.01))[:, :, None]).sum(1))


def test_betweenness_is_the_same_for_every_partitioning(spark):
    """Of a long way with no branches, walked both ways, by more tasks than it has hubs."""
    n = 300
    ring = spark.range(n - 1).select(F.col("id").cast("string").alias("source"), (F.col("id") + 1).cast("string").alias("target"), F.lit(1).alias("weight"))
    both = ring.unionByName(ring.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight"))
    got = {int(r.id): r.betweenness for r in graph.betweenness(both.repartition(7), spark).collect()}
    assert got == {i: 2.0 * i * (n - 1 - i) for i in range(n)}
    with pytest.raises(TypeError):
        graph.betweenness(both, spark, most=1)  # there is no size it refuses
