"""SQL fragments that state the column functions again, for comparison."""

from __future__ import annotations

from lemmaweave.functions import text as T

WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WS = WS.replace("[", "[^", 1)


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def fold(x: str) -> str:
    return f"replace(translate({x}, '{T.FOLDED_FROM}', '{T.FOLDED_TO}'), 'ß', 'ss')"


def key(x: str) -> str:
    spaced = f"translate({fold(x)}, '()', '  ')"
    return f"replace(lower(trim(regexp_replace({spaced}, '{WS}+', ' ', 'g'))), 'ς', 'σ')"


def lemma(x: str) -> str:
    return f"regexp_replace({strip(f"regexp_replace({x}, '(?s)[›↑].*$', '')")}, '[,.;: ]+$', '')"


def core(x: str) -> str:
    return strip(f"regexp_extract({x}, '^([^,(]*)', 1)")


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def without_article(x: str) -> str:
    articles = ", ".join(f"'{a}'" for a in T.ARTICLES)
    return f"CASE WHEN lower(regexp_extract({x}, '^({NOT_WS}+)', 1)) IN ({articles}) THEN regexp_replace({x}, '^{NOT_WS}+{WS}*', '') ELSE {x} END"


def inverted(x: str) -> str:
    a, b = strip(f"string_split({x}, ',')[1]"), strip(f"string_split({x}, ',')[2]")
    fits = f"len(string_split({x}, ',')) = 2 AND {a} <> '' AND regexp_matches({b}, '^\\p{{Ll}}{NOT_WS}*$')"
    return f"CASE WHEN {fits} THEN {b} || ' ' || {a} END"


def count_sign(x: str) -> str:
    return f"coalesce(length({x}) - length(replace({x}, '�', '')), 0)"


def composed(x: str) -> str:
    """Letters composed with a spacing accent behind them."""
    steps = x
    for sign, mark in T.MARKS.items():
        for form in (f"<sup>{sign}</sup>", sign):
            steps = f"regexp_replace(regexp_replace({steps}, 'ı{form}', 'i{mark}', 'g'), '(\\p{{L}}){form}', '\\1{mark}', 'g')"
    return f"CASE WHEN regexp_matches({x}, '[{''.join(T.MARKS)}]') THEN nfc_normalize({steps}) ELSE {x} END"


def without_italics(x: str) -> str:
    """Single underscores taken out of lines that hold an even number of them."""
    runs = "regexp_extract_all(z, '_+|[^_]+')"
    line = f"CASE WHEN len(list_filter({runs}, lambda q: q = '_')) % 2 = 0 THEN array_to_string(list_transform({runs}, lambda q: CASE WHEN q = '_' THEN '\ue003' ELSE q END), '') ELSE z END"
    paired = f"replace(regexp_replace({line}, '\ue003([^\ue003]{{1,200}})\ue003', '\\1', 'g'), '\ue003', '_')"
    return f"array_to_string(list_transform(string_split({x}, chr(10)), lambda z: {paired}), chr(10))"


def tidy(x: str) -> str:
    out = f"regexp_replace(regexp_replace({x}, '(?s)<sup>(.*?)</sup>', '^\\1', 'g'), '(?s)\\*\\*(.+?)\\*\\*', '\\1', 'g')"
    out = f"regexp_replace({without_italics(out)}, '\\*{{1,2}}', '', 'g')"
    out = f"regexp_replace(regexp_replace({out}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    blank = WS.replace("\\s", "\\t\\r\\x{0C} ") + "*"
    return strip(f"regexp_replace({out}, '{blank}\\n{blank}', chr(10), 'g')")


def clean(x: str) -> str:
    joined = f"regexp_replace(regexp_replace({composed(x)}, '↦{WS}*→', '↦', 'g'), '⇋{WS}*⇋', '⇋', 'g')"
    moved = f"regexp_replace(regexp_replace({joined}, '^̸{WS}*({NOT_WS})', '\\1̸'), '({WS})̸{WS}*({NOT_WS})', '\\1\\2̸', 'g')"
    return tidy(moved)


def healed(x: str) -> str:
    """Broken words joined; suspended hyphens are kept by a sign of their own meanwhile."""
    kept = f"regexp_replace({x}, '(\\p{{L}})-({WS}+)({'|'.join(T.SUSPENDED)})([^\\p{{L}}\\p{{N}}_]|$)', '\\1\ue004\\2\\3\\4', 'g')"
    return f"replace(regexp_replace(replace({kept}, '\ue004-', '\ue004'), '(\\p{{L}})-{WS}+(\\p{{Ll}})', '\\1\\2', 'g'), '\ue004', '-')"


#: Current entries: the latest delivery of each id.
ENTRIES = """e AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id
  ORDER BY coalesce(loaded_at, TIMESTAMP '1970-01-01') DESC, coalesce(headword, '') DESC) AS rn FROM entries) WHERE rn = 1)"""
#: References: the earliest delivery of each key.
REFERENCES = """x AS (SELECT * EXCLUDE (rn) FROM (SELECT entry_id, ordinal, raw_target, raw_context, row_number() OVER (PARTITION BY entry_id, ordinal
  ORDER BY loaded_at, raw_target NULLS FIRST, raw_context NULLS FIRST) AS rn FROM cross_references) WHERE rn = 1)"""
#: Resolutions, repeated deliveries once.
RESOLVED = """r AS (SELECT DISTINCT entry_id, ordinal, raw_target, status, resolved_entry_id, match_key, suffix_stripped, redirect_hops, match_words FROM resolved_cross_references)"""
NODES = "n AS (SELECT id, volume, ordinal, headword, entry_type FROM e WHERE entry_type <> 'redirect')"
EDGES = """g AS (SELECT entry_id AS source, resolved_entry_id AS target, count(*) AS weight FROM r
  WHERE status IN ('same_volume', 'cross_volume', 'deinflected', 'slash_half') AND entry_id <> resolved_entry_id
  AND entry_id IN (SELECT id FROM n) AND resolved_entry_id IN (SELECT id FROM n) GROUP BY 1, 2)"""
UNDIRECTED = "u AS (SELECT least(source, target) AS a, greatest(source, target) AS b, sum(weight)::BIGINT AS weight FROM g GROUP BY 1, 2)"
DEGREES = """d AS (SELECT id, coalesce((SELECT sum(weight) FROM g WHERE target = id), 0)::BIGINT AS in_degree,
  coalesce((SELECT sum(weight) FROM g WHERE source = id), 0)::BIGINT AS out_degree FROM n)"""
GRAPH = f"WITH {ENTRIES}, {RESOLVED}, {NODES}, {EDGES}, {UNDIRECTED}, {DEGREES} "
