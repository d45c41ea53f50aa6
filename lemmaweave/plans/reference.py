"""Queries over the encyclopedia tables, each with SQL that says the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaweave.functions import text as T
from lemmaweave.operators import checks, dates, display, graph, layout, lemmas, parse, resolve, search, story, votes
from lemmaweave.operators import dates as D
from lemmaweave.operators.skew import join_nullable
from lemmaweave.plans import sql as S
from lemmaweave.sources import cut, shared_folder, sinks, stored, table, volumes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _entries(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """Current entries."""
    needed = ["id", "headword", "loaded_at", *[c for c in columns if c not in ("id", "headword", "loaded_at")]]
    return resolve.latest(table(spark, root, "entries", *needed))


def _resolved(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "resolved_cross_references").drop("loaded_at").distinct()


def _references(spark: SparkSession, root: str) -> DataFrame:
    return resolve.delivered(table(spark, root, "cross_references"))


def _nodes(spark: SparkSession, root: str) -> DataFrame:
    return graph.nodes(_entries(spark, root, "volume", "ordinal", "entry_type"))


def _graph(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    nodes = _nodes(spark, root)
    return nodes, graph.edges(_resolved(spark, root), nodes)


_MADE: dict[tuple[object, ...], DataFrame] = {}


def _once(spark: SparkSession, root: str, name: str, tables: list[str], make: Callable[[], DataFrame]) -> DataFrame:
    """What several queries read, made once per session and state of its tables."""
    assert spark._jvm is not None
    state = []
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{t}.parquet")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        state += [files.getFileStatus(path).getModificationTime(), files.getContentSummary(path).getLength()]
    key = (spark.sparkContext.applicationId, root, name, *state)
    if key not in _MADE:
        _MADE[key] = stored(make(), spark)
    return _MADE[key]


# --- the documented questions ---------------------------------------------------------


@query(f"WITH {S.ENTRIES} SELECT volume, entry_type, count(*) AS n FROM e GROUP BY volume, entry_type")
def entries_by_volume_and_type(spark: SparkSession, root: str) -> DataFrame:
    return _entries(spark, root, "volume", "entry_type").groupBy("volume", "entry_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {S.REFERENCES} SELECT raw_target, count(*) AS n FROM x GROUP BY raw_target ORDER BY n DESC, raw_target LIMIT 20")
def top_targets(spark: SparkSession, root: str) -> DataFrame:
    return _references(spark, root).groupBy("raw_target").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "raw_target").limit(20)


@query(f"WITH {S.ENTRIES} SELECT id, headword FROM e WHERE headword ILIKE 'wesens%'")
def headword_prefix(spark: SparkSession, root: str) -> DataFrame:
    return _entries(spark, root).where(F.ilike("headword", F.lit("wesens%"))).select("id", "headword")


@query(f"WITH {S.RESOLVED} SELECT status, count(*) AS n FROM r GROUP BY status")
def references_by_status(spark: SparkSession, root: str) -> DataFrame:
    return _resolved(spark, root).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {S.ENTRIES}, {S.RESOLVED} SELECT e.id, any_value(e.headword) AS headword, count(*) AS n FROM r JOIN e ON e.id = r.resolved_entry_id GROUP BY e.id ORDER BY n DESC, e.id LIMIT 20")
def cited_entries(spark: SparkSession, root: str) -> DataFrame:
    cited = _resolved(spark, root).where(F.col("resolved_entry_id").isNotNull()).groupBy(F.col("resolved_entry_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return cited.join(_entries(spark, root), "id").orderBy(F.desc("n"), "id").limit(20).select("id", "headword", "n")


@query(f"WITH {S.ENTRIES}, {S.RESOLVED} SELECT r.entry_id, r.ordinal, r.raw_target, r.status, e.headword AS target FROM r LEFT JOIN e ON e.id = r.resolved_entry_id")
def outgoing_references(spark: SparkSession, root: str) -> DataFrame:
    targets = _entries(spark, root).select(F.col("id").alias("resolved_entry_id"), F.col("headword").alias("target"))
    return join_nullable(_resolved(spark, root), targets, "resolved_entry_id").select("entry_id", "ordinal", "raw_target", "status", "target")


@query(f"WITH {S.RESOLVED} SELECT match_key, count(*) AS n FROM r WHERE status = 'ambiguous' GROUP BY match_key ORDER BY n DESC, match_key LIMIT 20")
def top_ambiguous(spark: SparkSession, root: str) -> DataFrame:
    return _resolved(spark, root).where("status = 'ambiguous'").groupBy("match_key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "match_key").limit(20)


# --- text functions -------------------------------------------------------------------


@query(
    f"WITH {S.ENTRIES} SELECT id, {S.fold('headword')} AS folded, {S.key('headword')} AS key, {S.lemma('headword')} AS lemma, {S.core('headword')} AS core, "
    f"{S.inverted(S.lemma('headword'))} AS inverted, string_split(id, ':')[1] AS volume FROM e"
)
def headword_forms(spark: SparkSession, root: str) -> DataFrame:
    return _entries(spark, root).select("id", T.fold_diacritics("headword").alias("folded"), T.key("headword").alias("key"), T.lemma("headword").alias("lemma"), T.core("headword").alias("core"), T.comma_inverted(T.lemma("headword")).alias("inverted"), T.volume_of("id").alias("volume"))


@query(
    f"""WITH {S.REFERENCES}, c AS (SELECT DISTINCT raw_context, {S.words('raw_context')}[1:6] AS w FROM x WHERE raw_context IS NOT NULL),
p AS (SELECT raw_context, regexp_replace(array_to_string(w[1:n], ' '), '[,.;:) ]+$', '') AS phrase, n FROM c, generate_series(2, 6) AS s(n) WHERE n <= len(w))
SELECT raw_context, phrase, n FROM p WHERE contains(phrase, ' ')"""
)
def context_phrases(spark: SparkSession, root: str) -> DataFrame:
    contexts = _references(spark, root).where(F.col("raw_context").isNotNull()).select("raw_context").distinct()
    taken = F.size(F.slice(T.words("raw_context"), 1, 6))
    spelled = contexts.select("raw_context", F.explode(T.phrases("raw_context")).alias("phrase"), taken.alias("t"))
    # A phrase may lose signs at its end, not words, so its length tells its number.
    return spelled.select("raw_context", "phrase", F.size(T.words("phrase")).cast("long").alias("n"))


@query(
    f"WITH {S.ENTRIES} SELECT id, regexp_replace(regexp_replace(regexp_replace(body_text, '(?s)<sup>(.*?)</sup>', '^\\1', 'g'), '(?s)\\*\\*(.+?)\\*\\*', '\\1', 'g'), '[ \\t]+', ' ', 'g') AS text, "
    f"{S.count_sign('body_text')} + {S.count_sign('werke_raw')} + {S.count_sign('literatur_raw')} AS unreadable FROM e"
)
def plain_markup(spark: SparkSession, root: str) -> DataFrame:
    bold = F.regexp_replace(F.regexp_replace("body_text", r"(?s)<sup>(.*?)</sup>", "^$1"), r"(?s)\*\*(.+?)\*\*", "$1")
    signs = reduce(lambda a, b: a + b, [T.count_sign(c) for c in ("body_text", "werke_raw", "literatur_raw")])
    return _entries(spark, root, "body_text", "werke_raw", "literatur_raw").select("id", F.regexp_replace(bold, r"[ \t]+", " ").alias("text"), signs.cast("long").alias("unreadable"))


@query(
    f"WITH {S.ENTRIES} SELECT id, {S.clean('headword')} AS headword_clean, {S.clean('body_text')} AS body_clean, {S.clean('werke_raw')} AS werke_clean, {S.clean('literatur_raw')} AS literatur_clean, {S.key('(' + S.clean('headword') + ')')} AS lemma_key FROM e"
)
def cleaned_entries(spark: SparkSession, root: str) -> DataFrame:
    rows = _entries(spark, root, "body_text", "werke_raw", "literatur_raw")
    return rows.select("id", T.clean("headword").alias("headword_clean"), *[T.clean(c).alias(n) for c, n in (("body_text", "body_clean"), ("werke_raw", "werke_clean"), ("literatur_raw", "literatur_clean"))], T.key(T.clean("headword")).alias("lemma_key"))


@query(f"WITH {S.ENTRIES} SELECT id, {S.healed('body_text')} AS text FROM e")
def healed_hyphens(spark: SparkSession, root: str) -> DataFrame:
    return _entries(spark, root, "body_text").select("id", T.heal_hyphens("body_text").alias("text"))


@query(
    f"""WITH {S.ENTRIES}, a AS (SELECT id, headword AS h, body_text AS b, substr(body_text, length(headword) + 1) AS rest FROM e WHERE headword IS NOT NULL AND body_text IS NOT NULL),
c AS (SELECT *, {S.strip("split_part(split_part(split_part(split_part(split_part(regexp_replace(rest, '^[, ]+', ''), ',', 1), '†', 1), '(', 1), ';', 1), '.', 1)")} AS gloss FROM a)
SELECT id, CASE WHEN starts_with(b, h) AND gloss <> '' AND length(gloss) <= 40 THEN h || CASE WHEN starts_with(rest, ',') THEN ', ' ELSE ' ' END || gloss ELSE h END AS name FROM c"""
)
def display_names(spark: SparkSession, root: str) -> DataFrame:
    rows = _entries(spark, root, "body_text").where(F.col("headword").isNotNull() & F.col("body_text").isNotNull())
    return rows.select("id", T.display_name("headword", "body_text").alias("name"))


@query(f"WITH {S.ENTRIES} SELECT id, replace(replace(replace(replace(replace(body_text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS html FROM e")
def escaped_texts(spark: SparkSession, root: str) -> DataFrame:
    return _entries(spark, root, "body_text").select("id", T.escape_html("body_text").alias("html"))


# --- parsing --------------------------------------------------------------------------


_T = parse.TARGET
_SUSPENDED = ", ".join(f"'{w}'" for w in T.SUSPENDED)


def _references_sql(text: str) -> str:
    """List of (w, c) of the references of a text: each stretch between arrows is read alone."""
    whole = f"{_T}+(?:[/,]{_T}+)?"
    first, more = f"regexp_extract(p, '^({whole})', 1)", f"regexp_extract(p, '^{whole}{S.WS}+({whole})', 1)"
    joined = f"suffix({first}, '-') AND regexp_matches({more}, '^\\p{{Ll}}') AND regexp_extract({more}, '^({_T}+)', 1) NOT IN ({_SUSPENDED})"
    word = f"CASE WHEN {joined} THEN left({first}, length({first}) - 1) || {more} ELSE {first} END"
    rest = f"CASE WHEN {joined} THEN regexp_extract(p, '^{whole}{S.WS}+{whole}({parse.REST})', 1) ELSE regexp_extract(p, '^{whole}({parse.REST})', 1) END"
    pieces = f"list_filter(regexp_extract_all({text}, '↑›?([^↑]*)', 1), lambda p: {first} <> '')"
    return f"list_transform({pieces}, lambda p: {{'w': {word}, 'c': {S.strip(f'({word}) || ({rest})')}}})"


@query(
    f"WITH {S.ENTRIES}, l AS (SELECT id, {_references_sql('body_text')} AS refs FROM e WHERE body_text IS NOT NULL) "
    "SELECT id AS entry_id, i - 1 AS ordinal, refs[i].w AS raw_target, refs[i].c AS raw_context FROM (SELECT *, unnest(range(1, len(refs) + 1)) AS i FROM l)"
)
def references_in_texts(spark: SparkSession, root: str) -> DataFrame:
    return parse.text_references(_entries(spark, root, "body_text"))


@query(f"WITH {S.ENTRIES} SELECT id, len(regexp_extract_all(body_text, '↑›?({parse.TARGET}+)', 1)) AS n FROM e WHERE body_text IS NOT NULL")
def references_per_text(spark: SparkSession, root: str) -> DataFrame:
    found = F.size(F.regexp_extract_all("body_text", F.lit(f"↑›?({parse.TARGET}+)"), F.lit(1)))
    return _entries(spark, root, "body_text").where(F.col("body_text").isNotNull()).select("id", found.cast("long").alias("n"))


def _tagged(spark: SparkSession, root: str) -> DataFrame:
    """Volumes as tagged text, put together from the entries."""
    rows = _entries(spark, root, "volume", "ordinal", "body_text", "werke_raw", "literatur_raw", "author_sigil", "pdf_page_start", "printed_page_start").where(F.col("headword").isNotNull())
    page = F.concat(F.lit("<!-- page:"), F.coalesce("pdf_page_start", F.lit(0)), F.coalesce(F.concat(F.lit(" printed:"), F.col("printed_page_start")), F.lit("")), F.lit(" -->\n"))
    body = F.concat_ws("\n\n", "body_text", F.concat(F.lit("Werke: "), "werke_raw"), F.concat(F.lit("Literatur: "), "literatur_raw"), "author_sigil")
    marked = F.concat(page, F.lit("<!-- entry:"), "headword", F.lit(" -->\n"), body, F.lit("\n\n"))
    # A stretch of pages is a unit of its own: no volume is gathered whole.
    stretch = F.concat_ws("#", "volume", F.floor(F.col("ordinal") / 200))
    grouped = rows.groupBy(stretch.alias("volume")).agg(F.array_sort(F.collect_list(F.struct("ordinal", marked.alias("t")))).alias("p"))
    return grouped.select("volume", F.array_join(F.transform("p", lambda x: x["t"]), "").alias("text"))


@query()
def parsed_records(spark: SparkSession, root: str) -> DataFrame:
    return parse.records(_tagged(spark, root)).drop("cross_references", "flags")


@query()
def parsed_references(spark: SparkSession, root: str) -> DataFrame:
    return parse.exploded_references(parse.records(_tagged(spark, root)))


@query()
def parsed_flags(spark: SparkSession, root: str) -> DataFrame:
    return parse.exploded_flags(parse.records(_tagged(spark, root)))


# --- resolution -----------------------------------------------------------------------

_INDEX = f"""i0 AS (SELECT id, volume, headword, {S.key(S.lemma('headword'))} AS exact, {S.lemma('headword')} AS lem, {S.core('headword')} AS cor FROM e WHERE headword IS NOT NULL),
il0 AS (SELECT id, volume, exact, regexp_replace({S.strip("array_to_string(list_transform(string_split(lem, ',')[1:k], lambda c: " + S.strip('c') + "), ', ')")}, '[,.;: ]+$', '') AS p FROM i0, generate_series(1, 12) AS s(k) WHERE k <= len(string_split(lem, ','))),
il AS (SELECT DISTINCT 'L' AS ix, {S.key('p')} AS key, id AS entry_id, volume, exact = {S.key('p')} AS is_exact, false AS via_slash FROM il0 WHERE contains(p, ' ')),
iw0 AS (SELECT id, volume, exact, contains(cor, '/') AS slashed, {S.strip('part')} AS part FROM (SELECT *, unnest(string_split(cor, '/')) AS part FROM i0)),
iw1 AS (SELECT *, {S.words(S.without_article('part'))}[1] AS word FROM iw0),
iw AS (SELECT 'W' AS ix, {S.key('word')} AS key, id AS entry_id, volume, exact = {S.key('word')} AS is_exact, slashed AS via_slash FROM iw1 WHERE length(word) > 1),
idx AS (SELECT * FROM il UNION ALL SELECT * FROM iw)"""
_SAID = """ga AS (SELECT ix, key, count(*) AS n, count(*) FILTER (is_exact) AS nx, max({'e': entry_id, 'v': volume, 's': via_slash}) AS any1, max({'e': entry_id, 'v': volume, 's': via_slash}) FILTER (is_exact) AS ex1 FROM idx GROUP BY ix, key),
va AS (SELECT ix, key, volume, count(*) AS n, count(*) FILTER (is_exact) AS nx, max({'e': entry_id, 'v': volume, 's': via_slash}) AS any1, max({'e': entry_id, 'v': volume, 's': via_slash}) FILTER (is_exact) AS ex1 FROM idx GROUP BY ix, key, volume)"""


def _funnel_sql(name: str, source: str, phrases: bool) -> str:
    """Steps that resolve the rows of ``source`` (entry_id, ordinal, raw_target, raw_context)."""
    ends = ", ".join(f"({300 + i}, '{s}')" for i, s in enumerate(T.SUFFIXES))
    phrase = f"""UNION ALL SELECT entry_id, ordinal, vol, 6 - k, 'L', {S.key('p')}, NULL, len({S.words('p')}) FROM (SELECT *, regexp_replace(array_to_string(({S.words('raw_context')})[1:k], ' '), '[,.;:) ]+$', '') AS p
  FROM {name}s, generate_series(2, 6) AS g(k) WHERE raw_context IS NOT NULL AND k <= len(({S.words('raw_context')})[1:6])) WHERE contains(p, ' ')""" if phrases else ""
    return f"""{name}s AS (SELECT *, string_split(entry_id, ':')[1] AS vol FROM ({source})),
{name}p AS (SELECT entry_id, ordinal, vol, 100 AS pr, 'W' AS ix, {S.key("coalesce(raw_target, '')")} AS key, NULL::VARCHAR AS suf, 1 AS nw FROM {name}s
UNION ALL SELECT entry_id, ordinal, vol, 199 + row_number() OVER (PARTITION BY entry_id, ordinal ORDER BY length(h) DESC, i), 'W', {S.key('h')}, NULL, 1 FROM (SELECT *, unnest(string_split(raw_target, '/')) AS h, generate_subscripts(string_split(raw_target, '/'), 1) AS i FROM {name}s WHERE contains(raw_target, '/')) WHERE {S.strip('h')} <> ''
UNION ALL SELECT entry_id, ordinal, vol, pr, 'W', {S.key('left(raw_target, length(raw_target) - length(suf))')}, suf, 1 FROM {name}s, (VALUES {ends}) AS v(pr, suf) WHERE suffix(raw_target, suf) AND length(raw_target) - length(suf) >= 3
{phrase}),
{name}m AS (SELECT p.*, CASE WHEN ga.nx = 1 THEN ga.ex1 WHEN va.n IS NOT NULL AND va.nx = 1 THEN va.ex1 WHEN va.n IS NOT NULL AND va.n = 1 THEN va.any1 WHEN va.n IS NULL AND ga.n = 1 THEN ga.any1 END AS win,
  CASE WHEN ga.nx = 1 OR va.n IS NULL THEN '*' ELSE p.vol END AS scope FROM {name}p p JOIN ga ON ga.ix = p.ix AND ga.key = p.key LEFT JOIN va ON va.ix = p.ix AND va.key = p.key AND va.volume = p.vol),
{name}b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entry_id, ordinal ORDER BY pr) AS rn FROM {name}m WHERE ix = 'W' OR win IS NOT NULL) WHERE rn = 1),
{name} AS (SELECT s.entry_id, s.ordinal, s.raw_target, CASE WHEN b.pr IS NULL THEN 'unresolved' WHEN b.win IS NULL THEN 'ambiguous' WHEN b.suf IS NOT NULL THEN 'deinflected' WHEN b.ix = 'W' AND b.win.s THEN 'slash_half' WHEN b.win.v = s.vol THEN 'same_volume' ELSE 'cross_volume' END AS status,
  b.win.e AS rid, coalesce(b.key, {S.key("coalesce(s.raw_target, '')")}) AS match_key, b.suf AS suffix_stripped, coalesce(b.nw, 1) AS match_words, b.scope FROM {name}s s LEFT JOIN {name}b b USING (entry_id, ordinal))"""


_RESOLVE = f"""WITH {S.ENTRIES}, {S.REFERENCES}, {_INDEX}, {_SAID}, {_funnel_sql('f', 'SELECT * FROM x', True)},
{_funnel_sql('h', "SELECT x.* FROM x JOIN e ON e.id = x.entry_id WHERE x.ordinal = 0 AND e.entry_type = 'redirect'", False)},
hop AS (SELECT entry_id AS id, rid AS nx FROM h WHERE rid IS NOT NULL),
w1 AS (SELECT id, nx AS at1, [id, nx] AS seen, 1 AS n FROM hop),
w2 AS (SELECT w1.id, CASE WHEN h.nx IS NOT NULL AND NOT list_contains(seen, h.nx) THEN h.nx ELSE at1 END AS at1, CASE WHEN h.nx IS NOT NULL AND NOT list_contains(seen, h.nx) THEN list_append(seen, h.nx) ELSE seen END AS seen, n + (h.nx IS NOT NULL AND NOT list_contains(seen, h.nx))::INT AS n FROM w1 LEFT JOIN hop h ON h.id = w1.at1),
w3 AS (SELECT w2.id, CASE WHEN h.nx IS NOT NULL AND NOT list_contains(seen, h.nx) THEN h.nx ELSE at1 END AS at1, n + (h.nx IS NOT NULL AND NOT list_contains(seen, h.nx))::INT AS n FROM w2 LEFT JOIN hop h ON h.id = w2.at1),
done AS (SELECT f.entry_id, f.ordinal, f.raw_target, f.status, coalesce(w.at1, f.rid) AS resolved_entry_id, f.match_key, f.suffix_stripped, coalesce(w.n, 0) AS redirect_hops, f.match_words, f.scope FROM f LEFT JOIN (SELECT * FROM w3 WHERE at1 <> id) w ON w.id = f.rid)
"""


def _run(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    entries = table(spark, root, "entries", "id", "headword", "volume", "entry_type", "loaded_at")
    references = table(spark, root, "cross_references", "entry_id", "ordinal", "raw_target", "raw_context", "loaded_at")
    resolved = _once(spark, root, "resolved", ["entries", "cross_references"], lambda: resolve.run(entries, references))
    return resolved, resolve.index(resolve.latest(entries))


@query(_RESOLVE + "SELECT entry_id, ordinal, raw_target, status, resolved_entry_id, match_key, suffix_stripped, redirect_hops, match_words FROM done")
def resolve_references(spark: SparkSession, root: str) -> DataFrame:
    return _run(spark, root)[0].drop("scope")


@query(_RESOLVE + "SELECT DISTINCT d.entry_id, d.ordinal, i.entry_id AS candidate_entry_id FROM done d JOIN iw i ON i.key = d.match_key WHERE d.status = 'ambiguous' AND (d.scope = '*' OR d.scope = i.volume)")
def resolve_candidates(spark: SparkSession, root: str) -> DataFrame:
    return resolve.candidates(*_run(spark, root))


@query(_RESOLVE + "SELECT status, count(*) AS n, count(*) FILTER (redirect_hops > 0) AS n_chased, count(*) FILTER (match_words > 1) AS n_by_phrase, round(count(*) / sum(count(*)) OVER (), 6)::DOUBLE AS share FROM done GROUP BY status")
def resolve_report(spark: SparkSession, root: str) -> DataFrame:
    return resolve.status_report(_run(spark, root)[0])


# --- names ----------------------------------------------------------------------------

_LEMMAS = f"""WITH {S.ENTRIES}, {S.RESOLVED}, b0 AS (SELECT id, volume, ordinal, entry_type, {S.clean('headword')} AS headword FROM e), b AS (SELECT id, volume, ordinal, entry_type, {S.lemma('headword')} AS l, {S.core('headword')} AS c FROM b0),
v AS (SELECT id, volume, ordinal, l AS lemma, 'primary' AS variant_type FROM b
UNION ALL SELECT id, volume, ordinal, {S.strip(S.without_article('h'))}, 'slash_half' FROM (SELECT *, {S.strip('part')} AS h FROM (SELECT *, unnest(string_split(c, '/')) AS part FROM b WHERE contains(c, '/')))
UNION ALL SELECT id, volume, ordinal, {S.inverted('l')}, 'comma_inverted' FROM b
UNION ALL SELECT r.resolved_entry_id, b.volume, b.ordinal, l, 'redirect_alias' FROM b JOIN r ON r.entry_id = b.id AND r.ordinal = 0 WHERE b.entry_type = 'redirect' AND r.resolved_entry_id IS NOT NULL),
k AS (SELECT *, {S.key('lemma')} AS lemma_key FROM v),
lem AS (SELECT lemma_key, lemma, id AS entry_id, volume, variant_type FROM (SELECT *, row_number() OVER (PARTITION BY lemma_key, id, variant_type ORDER BY volume, ordinal, lemma) AS rn FROM k WHERE lemma_key <> '') WHERE rn = 1)
"""


def _lemmas(spark: SparkSession, root: str) -> DataFrame:
    return lemmas.variants(_entries(spark, root, "volume", "ordinal", "entry_type"), _resolved(spark, root))


@query(_LEMMAS + "SELECT * FROM lem")
def name_index(spark: SparkSession, root: str) -> DataFrame:
    return _lemmas(spark, root)


@query(_LEMMAS + "SELECT lemma_key, count(DISTINCT entry_id) AS n, array_to_string(list_sort(list(DISTINCT entry_id)), ' | ') AS entry_ids FROM lem WHERE variant_type = 'primary' GROUP BY lemma_key HAVING count(DISTINCT entry_id) > 1")
def name_conflicts(spark: SparkSession, root: str) -> DataFrame:
    return lemmas.conflicts(_lemmas(spark, root))


# --- life dates -----------------------------------------------------------------------


def _years_sql(name: str, source: str) -> str:
    """Years of ``source`` (id, t): rows (id, i, year, bc, refusal), stated over rows."""
    return f"""{name}0 AS (SELECT id, regexp_extract_all(t, '{D.DIGITS}') AS d, string_split_regex(t, '{D.DIGITS}') AS g FROM ({source})),
{name}1 AS (SELECT id, i, d[i] AS y, d[i + 1] AS alt, g[i] AS before, g[i + 1] AS g1, g[i + 2] AS g2, d[i + 2] AS d2, coalesce(length(d[i]) <= 4 AND regexp_matches(g[i + 1], '{D.EITHER}') AND length(d[i + 1]) <= 4 AND NOT starts_with(g[i + 2], '/'), false) AS paired
  FROM (SELECT *, unnest(range(1, len(d) + 1)) AS i FROM {name}0)),
{name}2 AS (SELECT *, coalesce(lag(paired) OVER w AND NOT coalesce(lag(paired, 2) OVER w, false), false) AS taken, CASE WHEN paired THEN g2 ELSE g1 END AS behind, CASE WHEN paired THEN d2 ELSE alt END AS follows FROM {name}1 WINDOW w AS (PARTITION BY id ORDER BY i)),
{name}3 AS (SELECT *, paired AND abs(alt::INT - y::INT) <> 1 AS wide, regexp_extract(behind, '{D.ERA}', 1) AS era, regexp_matches(before, '{D.RANGE_BEFORE}') OR (regexp_matches(regexp_replace(behind, '{D.ERA}', ''), '{D.RANGE_AFTER}') AND follows IS NOT NULL) AS ranged FROM {name}2 WHERE length(y) <= 4 AND NOT taken AND NOT ends_with(before, '/') AND NOT starts_with(behind, '/') AND NOT (starts_with(behind, '.') AND length(y) < 3)),
{name} AS (SELECT id, i, y::INT AS year, era = 'v' AND NOT wide AS bc, CASE WHEN wide THEN 'alternative wider than one year' WHEN ranged THEN 'part of a range' ELSE '' END AS refusal FROM {name}3 WHERE wide OR ranged OR y::INT >= 100 OR era <> '')"""


_ABBREVIATED = ", ".join(f"'{a}'" for a in D.ABBREVIATIONS)
_DATES = f"""WITH {S.ENTRIES}, h AS (SELECT id, entry_type, body_text, instr(left(coalesce(body_text, ''), {D.HEAD}), '{D.SIGN}') AS pos FROM e WHERE entry_type <> 'redirect'),
l AS (SELECT *, left(body_text, pos - 1) AS lead, substr(body_text, pos + 1, {D.SPAN}) AS w, substr(body_text, pos + 1 + {D.SPAN}) AS more FROM h WHERE pos > 0),
{_years_sql('yb', 'SELECT id, lead AS t FROM l')},
{_years_sql('yd', f"SELECT id, w || CASE WHEN regexp_matches(w, '{D.DIGITS}$') THEN regexp_extract(more, '^({D.DIGITS})', 1) ELSE '' END AS t FROM l")},
b AS (SELECT id, arg_max(year, i) AS year, arg_max(bc, i) AS bc, arg_max(refusal, i) AS refusal FROM yb GROUP BY id), ds AS (SELECT id, arg_min(year, i) AS year, arg_min(bc, i) AS bc, arg_min(refusal, i) AS refusal FROM yd GROUP BY id),
j AS (SELECT h.id, h.entry_type, h.pos, l.lead, b.year AS y1, ds.year AS y2, b.refusal AS br, ds.refusal AS dr, b.bc OR ds.bc AS bbc, ds.bc OR ((b.bc OR ds.bc) AND b.year + ds.year > {D.LONGEST}) AS dbc FROM h LEFT JOIN l USING (id) LEFT JOIN b USING (id) LEFT JOIN ds USING (id)),
s AS (SELECT *, CASE WHEN bbc THEN -y1 ELSE y1 END AS f, CASE WHEN dbc THEN -y2 ELSE y2 END AS t FROM j),
q AS (SELECT *, CASE WHEN pos = 0 THEN 'no dagger in head' WHEN length(replace(lead, ')', '')) > length(replace(lead, '(', '')) THEN 'dagger inside parentheses'
  WHEN len(list_filter(regexp_extract_all(lead, '{D.SENTENCE}', 1), lambda x: x NOT IN ({_ABBREVIATED}))) > 0 THEN 'sentence ends before dagger' WHEN y1 IS NULL THEN 'no birth year before dagger' WHEN y2 IS NULL THEN 'no death year after dagger'
  WHEN br <> '' THEN 'birth: ' || br WHEN dr <> '' THEN 'death: ' || dr WHEN f >= t THEN 'birth not before death (era marker missing?)' WHEN t - f > {D.LONGEST} THEN 'implausible lifespan' ELSE '' END AS reason FROM s),
ld AS (SELECT id, entry_type, CASE WHEN reason = '' THEN y1 END AS birth_year, CASE WHEN reason = '' THEN bbc::INT END AS birth_bc, CASE WHEN reason = '' THEN y2 END AS death_year, CASE WHEN reason = '' THEN dbc::INT END AS death_bc, reason, (reason = '')::INT AS dated FROM q)
"""


def _dates(spark: SparkSession, root: str) -> DataFrame:
    """The dates as a table: a few columns, read by what follows without the texts."""
    return cut(life_dates(spark, root), spark)


@query(_DATES + "SELECT * FROM ld")
def life_dates(spark: SparkSession, root: str) -> DataFrame:
    return dates.extract(_entries(spark, root, "entry_type", "body_text"))


@query(_DATES + "SELECT entry_type, reason, count(*) AS n FROM ld GROUP BY entry_type, reason")
def life_date_reasons(spark: SparkSession, root: str) -> DataFrame:
    return _dates(spark, root).groupBy("entry_type", "reason").agg(F.count(F.lit(1)).alias("n"))


_BORN = "CASE WHEN birth_bc = 1 THEN -birth_year ELSE birth_year END"
_ERA = f"CASE WHEN {_BORN} < 500 THEN 'antiquity' WHEN {_BORN} < 1450 THEN 'middle_ages' WHEN {_BORN} < 1800 THEN 'early_modern' WHEN {_BORN} < 1900 THEN 'nineteenth' ELSE 'modern' END"


@query(f"{_DATES}, c AS (SELECT {_ERA} AS era FROM ld WHERE dated = 1) SELECT v.era, (SELECT count(*) FROM c WHERE c.era = v.era) AS n FROM (VALUES ('antiquity'), ('middle_ages'), ('early_modern'), ('nineteenth'), ('modern')) AS v(era)")
def life_eras(spark: SparkSession, root: str) -> DataFrame:
    return story.eras(_dates(spark, root).where("dated = 1").select(dates.signed(F.col("birth_year"), F.col("birth_bc")).alias("birth")))


@query(_DATES + "SELECT entry_type, count(*) AS n, sum(dated)::BIGINT AS n_dated, round(avg(dated), 6)::DOUBLE AS share FROM ld GROUP BY entry_type")
def life_coverage(spark: SparkSession, root: str) -> DataFrame:
    """How many entries of each type are dated."""
    return story.coverage(_dates(spark, root), "entry_type")


@query(f"{_DATES} SELECT id, {_BORN} AS birth, CASE WHEN death_bc = 1 THEN -death_year ELSE death_year END AS death, CASE WHEN death_bc = 1 THEN -death_year ELSE death_year END - {_BORN} AS years FROM ld WHERE dated = 1 ORDER BY years DESC, id LIMIT 1")
def longest_life(spark: SparkSession, root: str) -> DataFrame:
    return story.longest_life(_dates(spark, root))


@query(f"{_DATES}, v AS (SELECT id, volume FROM e) SELECT {_ERA} AS era, volume AS region, count(*) AS n FROM ld JOIN v USING (id) WHERE dated = 1 GROUP BY 1, 2")
def lives_by_era_and_volume(spark: SparkSession, root: str) -> DataFrame:
    """Dated lives by era and region of the map, here the volume."""
    return story.era_regions(_dates(spark, root), _entries(spark, root, "volume").select("id", F.col("volume").alias("region")))


@query(_DATES + "SELECT DISTINCT id FROM (SELECT id FROM ld WHERE dated = 1 UNION ALL SELECT id FROM e WHERE entry_type = 'biography' AND contains(left(body_text, 500), '†'))")
def persons(spark: SparkSession, root: str) -> DataFrame:
    return story.persons(_entries(spark, root, "entry_type", "body_text"), _dates(spark, root))


# --- graph ----------------------------------------------------------------------------


@query(f"{S.GRAPH} SELECT id, row_number() OVER (ORDER BY volume, ordinal, id) - 1 AS node FROM n")
def graph_nodes(spark: SparkSession, root: str) -> DataFrame:
    return graph.numbered(_nodes(spark, root)).select("id", "node")


@query(f"{S.GRAPH} SELECT source, target, weight FROM g")
def graph_edges(spark: SparkSession, root: str) -> DataFrame:
    return _graph(spark, root)[1]


@query(f"{S.GRAPH} SELECT a, b, weight FROM u")
def graph_undirected(spark: SparkSession, root: str) -> DataFrame:
    return graph.undirected(_graph(spark, root)[1])


@query(f"{S.GRAPH} SELECT id, in_degree, out_degree, round(1.6 + 9.4 * sqrt(in_degree / greatest((SELECT max(in_degree) FROM d), 1)), 6) AS radius FROM d")
def graph_degrees(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    return graph.radii(graph.degrees(edges, nodes)).withColumn("radius", F.round("radius", 6))


@query(f"{S.GRAPH} SELECT id, in_degree FROM d ORDER BY in_degree DESC, id LIMIT 30")
def graph_hubs(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    return story.hubs(graph.degrees(edges, nodes))


@query(f"{S.GRAPH} SELECT count(*) AS n_nodes, count(*) FILTER (in_degree = 0) AS n_uncited, median(in_degree)::DOUBLE AS median_in_degree FROM d")
def graph_summary(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    return story.degree_summary(graph.degrees(edges, nodes))


@query(f"{S.GRAPH} SELECT id, in_degree, volume FROM (SELECT d.id, in_degree, volume, row_number() OVER (PARTITION BY volume ORDER BY in_degree DESC, d.id) AS rn FROM d JOIN n ON n.id = d.id) WHERE rn <= 3")
def graph_hubs_per_volume(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    from pyspark.sql import Window

    ranked = graph.degrees(edges, nodes).join(nodes.select("id", "volume"), "id")
    return ranked.withColumn("rn", F.row_number().over(Window.partitionBy("volume").orderBy(F.desc("in_degree"), "id"))).where("rn <= 3").select("id", "in_degree", "volume")


_COMPONENTS = S.GRAPH.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ", both2 AS (SELECT a, b FROM u UNION SELECT b, a FROM u), reach(id, c) AS (SELECT id, id FROM n UNION SELECT both2.b, reach.c FROM reach JOIN both2 ON both2.a = reach.id WHERE reach.c < both2.b) "


@query(f"{_COMPONENTS} SELECT id, min(c) AS component FROM reach GROUP BY id")
def graph_components(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    return graph.components(cut(edges, spark), cut(nodes, spark), spark)


def _communities(spark: SparkSession, root: str) -> DataFrame:
    """(id, community) of all nodes."""

    def make() -> DataFrame:
        nodes, edges = (stored(f, spark) for f in _graph(spark, root))
        return graph.ranked_communities(graph.communities(edges, nodes, spark))

    return _once(spark, root, "communities", ["entries", "resolved_cross_references"], make)


@query()
def graph_communities(spark: SparkSession, root: str) -> DataFrame:
    return _communities(spark, root)


@query()
def graph_community_names(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = (cut(f, spark) for f in _graph(spark, root))
    return graph.described(_communities(spark, root), nodes, graph.degrees(edges, nodes)).withColumn("color", T.palette_color("community"))


@query()
def community_matrix(spark: SparkSession, root: str) -> DataFrame:
    """Weights between communities; what has none comes in the buckets in, out, internal."""
    return story.group_matrix(_graph(spark, root)[1], _communities(spark, root), "community")


@query(f"{S.GRAPH} SELECT (SELECT count(*) FROM n) AS n_nodes, (SELECT sum(weight) FROM g)::BIGINT AS weight, (SELECT sum(weight) FROM g)::BIGINT AS matrix_weight")
def community_conservation(spark: SparkSession, root: str) -> DataFrame:
    """Nodes with a community and the weight of edges and of the matrix: nothing is lost."""
    one = lambda frame, value, name: frame.agg(value.alias(name))
    counted = one(_communities(spark, root), F.countDistinct("id"), "n_nodes")
    return counted.crossJoin(one(_graph(spark, root)[1], F.sum("weight"), "weight")).crossJoin(one(community_matrix(spark, root), F.sum("weight"), "matrix_weight"))


@query()
def volume_communities(spark: SparkSession, root: str) -> DataFrame:
    """(volume, community, n, row_share): how the communities lie over the volumes."""
    joined = _nodes(spark, root).select("id", "volume").join(_communities(spark, root), "id")
    return story.contingency(joined.where("community >= 0"), "volume", "community")


@query()
def volume_community_association(spark: SparkSession, root: str) -> DataFrame:
    joined = _nodes(spark, root).select("id", "volume").join(_communities(spark, root), "id")
    return story.chi_square(joined.where("community >= 0"), "volume", "community")


_BUCKETS = f"""{S.GRAPH}, k AS (SELECT id, CASE WHEN entry_type = 'unknown' THEN '-1' ELSE entry_type END AS c FROM n)
SELECT CASE WHEN a.c = '-1' AND b.c = '-1' THEN 'internal' WHEN a.c = '-1' THEN 'out' WHEN b.c = '-1' THEN 'in' ELSE a.c END AS from_group, CASE WHEN a.c = '-1' AND b.c = '-1' THEN 'internal' WHEN a.c = '-1' THEN 'out' WHEN b.c = '-1' THEN 'in' ELSE b.c END AS to_group, sum(weight)::BIGINT AS weight
FROM g JOIN k a ON a.id = g.source JOIN k b ON b.id = g.target GROUP BY 1, 2"""


@query(_BUCKETS)
def type_matrix(spark: SparkSession, root: str) -> DataFrame:
    """The matrix of groups with buckets, over entry types, 'unknown' being no group."""
    nodes, edges = _graph(spark, root)
    return story.group_matrix(edges, nodes.select("id", F.when(F.col("entry_type") == "unknown", "-1").otherwise(F.col("entry_type")).alias("grp")), "grp")


@query(
    f"""{S.GRAPH}, m AS (SELECT na.volume AS ca, nb.volume AS cb, u.weight FROM u JOIN n na ON na.id = u.a JOIN n nb ON nb.id = u.b), t AS (SELECT sum(weight) AS m FROM u),
ends AS (SELECT c, sum(weight) AS deg FROM (SELECT ca AS c, weight FROM m UNION ALL SELECT cb, weight FROM m) GROUP BY c), ins AS (SELECT ca AS c, sum(weight) FILTER (ca = cb) AS w FROM m GROUP BY ca)
SELECT round(sum(coalesce(w, 0) / t.m - power(deg / (2 * t.m), 2)), 6)::DOUBLE AS modularity FROM ends LEFT JOIN ins USING (c), t"""
)
def volume_modularity(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    return graph.modularity(edges, nodes.select("id", "volume"), "volume")


@query()
def graph_betweenness(spark: SparkSession, root: str) -> DataFrame:
    return graph.betweenness(cut(_graph(spark, root)[1], spark), spark)


@query()
def graph_bridges(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = (cut(f, spark) for f in _graph(spark, root))
    return story.bridges(graph.degrees(edges, nodes), graph.betweenness(edges, spark))


@query()
def graph_layout(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = (cut(f, spark) for f in _graph(spark, root))
    return graph.normalised(graph.layout(graph.boosted(edges, _communities(spark, root)), spark))


# --- analytics ------------------------------------------------------------------------

_MATRIX = f"{S.GRAPH}, mx AS (SELECT a.volume AS from_group, b.volume AS to_group, sum(weight)::BIGINT AS weight FROM g JOIN n a ON a.id = g.source JOIN n b ON b.id = g.target GROUP BY 1, 2)"


def _matrix(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    return story.group_matrix(edges, nodes, "volume")


@query(f"{_MATRIX} SELECT from_group, to_group, weight FROM mx")
def volume_matrix(spark: SparkSession, root: str) -> DataFrame:
    return _matrix(spark, root)


@query(f"{_MATRIX} SELECT round(sum(CASE WHEN from_group = to_group THEN weight ELSE 0 END) / sum(weight), 6)::DOUBLE AS internal_share FROM mx")
def volume_internal_share(spark: SparkSession, root: str) -> DataFrame:
    return story.internal_share(_matrix(spark, root))


@query(f"{_MATRIX} SELECT x.from_group, x.to_group, x.weight, coalesce(y.weight, 0) AS back, round(x.weight / greatest(coalesce(y.weight, 0), 1), 6)::DOUBLE AS ratio FROM mx x LEFT JOIN mx y ON y.from_group = x.to_group AND y.to_group = x.from_group WHERE x.from_group <> x.to_group AND x.weight >= 20")
def volume_asymmetry(spark: SparkSession, root: str) -> DataFrame:
    return story.asymmetry(_matrix(spark, root), 20)


@query(
    f"""{_MATRIX}, o AS (SELECT *, row_number() OVER (PARTITION BY from_group ORDER BY weight DESC, to_group) AS rn FROM mx WHERE from_group <> to_group),
a AS (SELECT from_group AS grp, sum(weight)::BIGINT AS weight_out, count(*) AS n_targets, round(sum(weight) FILTER (rn <= 3) / sum(weight), 6)::DOUBLE AS top3_share FROM o GROUP BY 1), b AS (SELECT to_group AS grp, sum(weight)::BIGINT AS weight_in FROM o GROUP BY 1)
SELECT grp, coalesce(weight_out, 0) AS weight_out, coalesce(weight_in, 0) AS weight_in, coalesce(n_targets, 0) AS n_targets, coalesce(top3_share, 0) AS top3_share FROM a FULL JOIN b USING (grp)"""
)
def volume_flows(spark: SparkSession, root: str) -> DataFrame:
    return story.external_flows(_matrix(spark, root))


@query(f"WITH {S.ENTRIES} SELECT volume, entry_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY volume), 6)::DOUBLE AS row_share FROM e WHERE volume IS NOT NULL AND entry_type IS NOT NULL GROUP BY volume, entry_type")
def type_shares(spark: SparkSession, root: str) -> DataFrame:
    return story.contingency(_entries(spark, root, "volume", "entry_type"), "volume", "entry_type")


@query(
    f"""WITH {S.ENTRIES}, o AS (SELECT volume, entry_type, count(*) AS n FROM e WHERE volume IS NOT NULL AND entry_type IS NOT NULL GROUP BY 1, 2), a AS (SELECT volume, sum(n) AS x FROM o GROUP BY 1), b AS (SELECT entry_type, sum(n) AS y FROM o GROUP BY 1), t AS (SELECT sum(n) AS t FROM o),
f AS (SELECT coalesce(o.n, 0) AS n, x * y / t AS ex FROM a CROSS JOIN b CROSS JOIN t LEFT JOIN o ON o.volume = a.volume AND o.entry_type = b.entry_type), c AS (SELECT sum((n - ex) * (n - ex) / ex) AS chi FROM f WHERE ex > 0), k AS (SELECT (SELECT count(*) FROM a) AS p, (SELECT count(*) FROM b) AS q)
SELECT round(chi, 4) AS chi2, (p - 1) * (q - 1) AS dof, round(sqrt(chi / (t.t * (least(p, q) - 1))), 6) AS cramers_v FROM c, k, t"""
)
def type_chi_square(spark: SparkSession, root: str) -> DataFrame:
    return story.chi_square(_entries(spark, root, "volume", "entry_type"), "volume", "entry_type")


@query(
    f"""WITH {S.RESOLVED}, c AS (SELECT DISTINCT entry_id, ordinal, candidate_entry_id FROM resolved_cross_reference_candidates), o AS (SELECT * FROM r WHERE status = 'ambiguous'),
fm AS (SELECT match_key, raw_target, count(*) AS k FROM o GROUP BY 1, 2), s AS (SELECT match_key, sum(k)::BIGINT AS n, count(*) AS n_forms, arg_min(raw_target, (-k, raw_target)) AS display FROM fm GROUP BY 1),
m AS (SELECT match_key, count(DISTINCT candidate_entry_id) AS n_candidates FROM c JOIN o USING (entry_id, ordinal) GROUP BY 1) SELECT match_key, n, display, n_forms, coalesce(n_candidates, 0) AS n_candidates FROM s LEFT JOIN m USING (match_key)"""
)
def ambiguous_terms(spark: SparkSession, root: str) -> DataFrame:
    candidates = table(spark, root, "resolved_cross_reference_candidates", "entry_id", "ordinal", "candidate_entry_id").distinct()
    return story.ambiguity(_resolved(spark, root), candidates)


@query("SELECT entry_id, count(DISTINCT lemma) AS n, array_to_string(list_sort(list(DISTINCT lemma)), ' | ') AS names FROM lemmas WHERE variant_type = 'redirect_alias' GROUP BY entry_id")
def alias_names(spark: SparkSession, root: str) -> DataFrame:
    return story.aliases(table(spark, root, "lemmas", "entry_id", "lemma", "variant_type"))


@query(f"WITH {S.RESOLVED} SELECT count(*) AS n_references, round(count(*) FILTER (status IN ('same_volume', 'cross_volume', 'deinflected', 'slash_half')) / count(*), 4)::DOUBLE AS resolved_share FROM r")
def resolved_share(spark: SparkSession, root: str) -> DataFrame:
    return story.resolved_share(_resolved(spark, root), resolve.RESOLVED)


@query(f"WITH {S.ENTRIES}, {S.RESOLVED} SELECT 'entry_type' AS measure, entry_type AS name, count(*) AS n FROM e GROUP BY entry_type UNION ALL SELECT 'status', status, count(*) FROM r GROUP BY status UNION ALL SELECT 'volume', volume, count(*) FROM e GROUP BY volume")
def manifest_counts(spark: SparkSession, root: str) -> DataFrame:
    return story.corpus_counts(_entries(spark, root, "volume", "entry_type"), _resolved(spark, root))


@query(f"{S.GRAPH} SELECT 'entries' AS measure, (SELECT count(*) FROM e) AS n UNION ALL SELECT 'nodes', (SELECT count(*) FROM n) UNION ALL SELECT 'edges', (SELECT count(*) FROM g) UNION ALL SELECT 'weight', (SELECT sum(weight) FROM g)::BIGINT")
def graph_counts(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    return story.graph_counts(_entries(spark, root), nodes, stored(edges, spark))


@query(
    f"""{_LEMMAS}, cf AS (SELECT lemma_key, unnest(list(DISTINCT entry_id)) AS id FROM lem WHERE variant_type = 'primary' GROUP BY 1 HAVING count(DISTINCT entry_id) > 1),
da AS (SELECT id, headword AS h, coalesce(body_text, '') AS bt, substr(coalesce(body_text, ''), length(headword) + 1) AS rest FROM e),
dg AS (SELECT *, {S.strip("split_part(split_part(split_part(split_part(split_part(regexp_replace(rest, '^[, ]+', ''), ',', 1), '†', 1), '(', 1), ';', 1), '.', 1)")} AS gloss FROM da)
SELECT lemma_key, id AS entry_id, CASE WHEN starts_with(bt, h) AND gloss <> '' AND length(gloss) <= 40 THEN h || CASE WHEN starts_with(rest, ',') THEN ', ' ELSE ' ' END || gloss ELSE h END AS name FROM cf JOIN dg USING (id)"""
)
def homonyms(spark: SparkSession, root: str) -> DataFrame:
    return story.homonyms(name_conflicts(spark, root), _entries(spark, root, "body_text"))


@query(f"{S.GRAPH}, al AS (SELECT entry_id, count(DISTINCT lemma) AS n, array_to_string(list_sort(list(DISTINCT lemma)), ' | ') AS names FROM lemmas WHERE variant_type = 'redirect_alias' GROUP BY 1 ORDER BY n DESC, entry_id LIMIT 20) SELECT * FROM al WHERE entry_id IN (SELECT id FROM n)")
def alias_ranking(spark: SparkSession, root: str) -> DataFrame:
    return story.alias_ranking(alias_names(spark, root), _nodes(spark, root))


@query(f"{_DATES}, {S.GRAPH.replace('WITH ', '', 1).split('WHERE rn = 1),', 1)[1]}, pe AS (SELECT id FROM ld WHERE dated = 1 UNION SELECT id FROM e WHERE entry_type = 'biography' AND contains(left(body_text, 500), '†')) SELECT d.id, in_degree FROM d JOIN pe ON pe.id = d.id ORDER BY in_degree DESC, d.id LIMIT 12")
def hub_persons(spark: SparkSession, root: str) -> DataFrame:
    """The most cited persons."""
    nodes, edges = _graph(spark, root)
    return story.hubs(graph.degrees(edges, nodes).join(persons(spark, root), "id", "left_semi"), 12)


@query(f"{S.GRAPH} SELECT source AS id, 'out' AS direction, 0::BIGINT AS part, list(target ORDER BY target) AS neighbours FROM g GROUP BY 1 UNION ALL SELECT target, 'in', 0, list(source ORDER BY source) FROM g GROUP BY 1")
def graph_adjacency(spark: SparkSession, root: str) -> DataFrame:
    return graph.adjacency(stored(_graph(spark, root)[1], spark))


@query(f"WITH {S.ENTRIES} SELECT id, round(sqrt(d), 6)::DOUBLE AS distance FROM (SELECT id, power(pdf_page_start - 12, 2) + power(ordinal - 40, 2) AS d FROM e) WHERE d <= 400 ORDER BY d, id LIMIT 1")
def nearest_entry(spark: SparkSession, root: str) -> DataFrame:
    """The entry nearest to a place of the plane of pages and ordinals."""
    points = _entries(spark, root, "pdf_page_start", "ordinal").select("id", F.col("pdf_page_start").cast("double").alias("x"), F.col("ordinal").cast("double").alias("y"))
    return graph.nearest(points, 12.0, 40.0, 20.0)


_SIGNED = "CASE WHEN {0}_bc = 1 THEN -{0}_year ELSE {0}_year END"


@query(
    f"""{_DATES}, sg AS (SELECT id, {_SIGNED.format('birth')} AS b, {_SIGNED.format('death')} AS d FROM ld WHERE dated = 1)
SELECT id, CASE WHEN b < 0 AND d < 0 THEN -b || '–' || -d || ' v. Chr.' WHEN b < 0 THEN -b || ' v. Chr.–' || d ELSE b || '–' || d END AS life FROM sg"""
)
def life_texts(spark: SparkSession, root: str) -> DataFrame:
    rows = _dates(spark, root).where("dated = 1")
    return rows.select("id", T.life_text(dates.signed(F.col("birth_year"), F.col("birth_bc")), dates.signed(F.col("death_year"), F.col("death_bc"))).alias("life"))


@query(f"WITH {S.ENTRIES}, c AS (SELECT entry_type, count(*) AS n, sum(length(body_text)) AS chars FROM e GROUP BY 1) SELECT entry_type, replace(format('{{:,}}', chars::BIGINT), ',', '.') AS chars, replace(printf('%.1f', 100.0 * n / sum(n) OVER ()), '.', ',') || ' %' AS share FROM c")
def formatted_counts(spark: SparkSession, root: str) -> DataFrame:
    """Characters and share of each entry type, written as German text does."""
    counted = _entries(spark, root, "entry_type", "body_text").groupBy("entry_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("body_text")).alias("chars"))
    whole = counted.agg(F.sum("n").alias("all"))
    return counted.crossJoin(F.broadcast(whole)).select("entry_type", T.german_number("chars").alias("chars"), T.percent(F.col("n") / F.col("all")).alias("share"))


# --- sources and sinks ----------------------------------------------------------------


@query(f"WITH {S.ENTRIES} SELECT id, headword, volume, printed_page_start, NULL::VARCHAR AS body_clean FROM e")
def records_read_back(spark: SparkSession, root: str) -> DataFrame:
    """Records written as JSON lines and read by declared schema; there are no clean ones,
    so the raw ones are taken and the clean column is null."""
    path = f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    sinks.jsonl(_entries(spark, root, "volume", "printed_page_start").drop("loaded_at"), path)
    raw = sinks.read_jsonl(spark, path, "id string, headword string, volume string, printed_page_start int, body_clean string")
    return sinks.prefer(None, raw)


@query(f"WITH {S.ENTRIES} SELECT volume, count(*) AS n_marks FROM e WHERE headword IS NOT NULL AND contains(volume, 'Bd0') GROUP BY volume")
def volumes_read_back(spark: SparkSession, root: str) -> DataFrame:
    """Tagged volumes written as text files and read whole by a glob; their entry marks."""
    path = f"{shared_folder(spark)}/volumes-{uuid.uuid4().hex}"
    _tagged(spark, root).select(F.concat(F.translate("volume", "#", "~"), F.lit(".md")).alias("file"), F.col("text").alias("value")).write.partitionBy("file").text(path)
    marks = F.size(F.regexp_extract_all("text", F.lit("(<!-- entry:)"), F.lit(1)))
    read = volumes(spark, f"{path}/file=Bd0*/*.txt")
    return read.select(F.substring_index("volume", "~", 1).alias("volume"), marks.cast("long").alias("n")).groupBy("volume").agg(F.sum("n").alias("n_marks"))


# --- search and filters ---------------------------------------------------------------

_SEARCH = f"{S.GRAPH}, sr AS (SELECT DISTINCT l.lemma_key, l.lemma, l.entry_id, l.variant_type, n.headword FROM lemmas l JOIN n ON n.id = l.entry_id)"


def _rows(spark: SparkSession, root: str) -> DataFrame:
    return search.index(table(spark, root, "lemmas", "lemma_key", "lemma", "entry_id", "variant_type"), _nodes(spark, root))


@query(f"{_SEARCH} SELECT lemma_key, lemma, entry_id, variant_type, headword FROM sr")
def search_rows(spark: SparkSession, root: str) -> DataFrame:
    return _rows(spark, root)


@query(f"{_SEARCH} SELECT lemma_key, lemma, entry_id, variant_type, CASE WHEN lemma_key = 'brauch' THEN 0 WHEN starts_with(lemma_key, 'brauch') THEN 1 ELSE 2 END AS rank FROM sr WHERE contains(lemma_key, 'brauch') ORDER BY rank, length(lemma_key), lemma, entry_id, variant_type LIMIT 40")
def search_query(spark: SparkSession, root: str) -> DataFrame:
    return search.query(_rows(spark, root), "Brauch")


@query(f"{_SEARCH} SELECT DISTINCT entry_id FROM sr WHERE contains(lemma_key, 'brauch')")
def search_matches(spark: SparkSession, root: str) -> DataFrame:
    return search.matches(_rows(spark, root), "Brauch")


def _most_cited(spark: SparkSession, root: str, n: int) -> list[str]:
    nodes, edges = _graph(spark, root)
    return [r.id for r in story.hubs(graph.degrees(edges, nodes), n).collect()]


_TOP = "top AS (SELECT id FROM d ORDER BY in_degree DESC, id LIMIT 2)"


@query(f"{S.GRAPH}, {_TOP}, kept AS (SELECT id FROM top UNION SELECT source FROM g WHERE target IN (SELECT id FROM top) UNION SELECT target FROM g WHERE source IN (SELECT id FROM top)) SELECT n.id FROM n JOIN kept ON kept.id = n.id WHERE n.volume <> 'Bd01_A-B'")
def visible_nodes(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    groups = nodes.select("id", F.when(F.col("volume") == "Bd01_A-B", 0).otherwise(1).alias("community"))
    return search.visible(groups, edges, _most_cited(spark, root, 2), [0])


@query(f"{S.GRAPH}, top AS (SELECT id FROM d ORDER BY in_degree DESC, id LIMIT 1) SELECT d.id, d.in_degree FROM d WHERE d.id IN (SELECT source FROM g WHERE target IN (SELECT id FROM top))")
def citing_nodes(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    return search.cited_by(edges, graph.degrees(edges, nodes), _most_cited(spark, root, 1)[0])


@query(f"{_SEARCH}, mn AS (SELECT DISTINCT entry_id, lemma, in_degree, false AS pinned FROM sr JOIN d ON d.id = sr.entry_id WHERE variant_type = 'primary' AND contains(lemma_key, 'wesen')) SELECT * FROM mn ORDER BY in_degree DESC, entry_id, lemma LIMIT 60")
def article_menu(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    return search.menu(_rows(spark, root), graph.degrees(edges, nodes), "Wesen")


# --- display --------------------------------------------------------------------------

# The next sign is taken into the match and put back, since this engine looks not ahead.
_LINE = S.WS.replace("\\s", "\\t\\r\\x{0C} ") + "*\\n" + S.WS + "*"
_FLOW = [
    (f"^{_LINE}", "¶"), (f"{_LINE}$", "¶"), (f"-{_LINE}(\\p{{Lu}})", "-\\1"), (f"-{_LINE}({'|'.join(T.SUSPENDED)})([^\\p{{L}}]|$)", "- \\1\\2"), (f"-{_LINE}({S.NOT_WS})", "\\1"),
    (f"([.!?:;][»«\"''›‹)\\]}}]*){_LINE}([\\p{{Lu}}\\p{{Nd}}(\\[])", "\\1¶\\2"), (_LINE, " "),
]
_REFLOW = reduce(lambda x, p: f"regexp_replace({x}, '{p[0]}', '{p[1]}', 'g')", _FLOW, "replace(body_text, '¶', chr(57346))")


@query(f"WITH {S.ENTRIES} SELECT id, replace(replace({_REFLOW}, '¶', chr(10) || chr(10)), chr(57346), '¶') AS text FROM e")
def reflowed_texts(spark: SparkSession, root: str) -> DataFrame:
    rows = _entries(spark, root, "body_text")
    return rows.select("id", display.reflowed(F.col("body_text")).alias("text"))


@query(
    f"""{S.GRAPH}, rf AS (SELECT entry_id AS id, list(raw_target ORDER BY ordinal, raw_target, status) AS ws, count(*) AS n FROM r GROUP BY 1), fd AS (SELECT id, body_text, list_transform({_references_sql('body_text')}, lambda x: x.w) AS found FROM e),
mk AS (SELECT fd.id, found, coalesce(length(body_text) > 0 AND n IS NOT NULL AND list_transform(found, lambda w: {S.key('w')}) = list_transform(ws[1:len(found)], lambda w: {S.key('w')}), false) AS ok, n FROM fd LEFT JOIN rf USING (id))
SELECT e.id, headword, volume, entry_type, werke_raw IS NOT NULL OR literatur_raw IS NOT NULL AS has_bib, replace(replace({_REFLOW}, '¶', chr(10) || chr(10)), chr(57346), '¶') AS body, coalesce(n, 0)::INT AS n_refs, CASE WHEN ok THEN len(found) ELSE 0 END::INT AS n_marks, NOT ok AS plain FROM e JOIN mk USING (id)"""
)
def entry_payloads(spark: SparkSession, root: str) -> DataFrame:
    entries = _entries(spark, root, "volume", "ordinal", "entry_type", "author_sigil", "printed_page_start", "body_text", "werke_raw", "literatur_raw")
    out = display.payloads(entries, _resolved(spark, root), graph.nodes(entries))
    return out.select("id", "headword", "volume", "entry_type", "has_bib", "body", F.size(F.coalesce("refs", F.array())).alias("n_refs"), F.size(F.coalesce("marks", F.array())).alias("n_marks"), F.col("marks").isNull().alias("plain"))


# --- evidence votes, islands, as-of ---------------------------------------------------


def _vote_parts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Words whose accented letter is the unknown place, and the words without one."""
    words = votes.word_counts(_entries(spark, root, "body_text"), "body_text")
    accent = words.where(F.col("word").rlike("^[A-Za-z]*[äöü][A-Za-z]*$") & (F.length("word") >= 4))
    unknown = accent.select(F.regexp_extract("word", "([äöü])", 1).alias("code"), F.regexp_extract("word", "^([A-Za-z]*)", 1).alias("prefix"), F.regexp_extract("word", "([A-Za-z]*)$", 1).alias("suffix"))
    return unknown, words


_VOTE = f"""WITH {S.ENTRIES}, w0 AS (SELECT unnest(regexp_extract_all(body_text, '(\\p{{L}}+)', 1)) AS word FROM e), w AS (SELECT word, count(*) AS n FROM w0 GROUP BY 1),
un AS (SELECT regexp_extract(word, '([äöü])', 1) AS code, regexp_extract(word, '^([A-Za-z]*)', 1) AS prefix, regexp_extract(word, '([A-Za-z]*)$', 1) AS suffix FROM w WHERE regexp_matches(word, '^[A-Za-z]*[äöü][A-Za-z]*$') AND length(word) >= 4),
pl AS (SELECT left(word, i - 1) AS prefix, substr(word, i, 1) AS letter, substr(word, i + 1) AS suffix, n FROM w, generate_series(1, 60) AS s(i) WHERE i <= length(word) AND length(word) >= 4),
ky AS (SELECT prefix, suffix, letter, sum(n) AS n FROM pl WHERE (prefix, suffix) IN (SELECT (prefix, suffix) FROM un) GROUP BY 1, 2, 3),
bad AS (SELECT DISTINCT prefix, suffix FROM (SELECT prefix, suffix, lower(letter) AS lo, count(DISTINCT letter) AS c FROM ky GROUP BY 1, 2, 3) WHERE c > 1),
vt AS (SELECT code, letter, sum(n) AS n FROM un JOIN ky USING (prefix, suffix) WHERE (prefix, suffix) NOT IN (SELECT (prefix, suffix) FROM bad) GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n DESC, letter) AS r, lead(n) OVER (PARTITION BY code ORDER BY n DESC, letter) AS nx, sum(n) OVER (PARTITION BY code) AS t FROM vt)
SELECT code, letter, n::BIGINT AS votes, round(n / t, 6)::DOUBLE AS share FROM rk WHERE r = 1 AND n >= 5 AND n >= 0.55 * t AND (nx IS NULL OR n >= 2 * nx)"""


@query(_VOTE)
def letter_votes(spark: SparkSession, root: str) -> DataFrame:
    return votes.vote(*_vote_parts(spark, root))


@query(
    "SELECT lemma_key AS code, arg_max(entry_id, (CASE variant_type WHEN 'redirect_alias' THEN 0 WHEN 'slash_half' THEN 1 ELSE 2 END, entry_id)) AS letter FROM lemmas WHERE variant_type <> 'comma_inverted' AND entry_id IS NOT NULL GROUP BY lemma_key"
)
def layered_names(spark: SparkSession, root: str) -> DataFrame:
    """What each name stands for, by layers of names of which later ones override earlier."""
    rows = table(spark, root, "lemmas", F.col("lemma_key").alias("code"), F.col("entry_id").alias("letter"), "variant_type").where("letter IS NOT NULL")
    return votes.layered([rows.where(F.col("variant_type") == v).select("code", "letter") for v in ("redirect_alias", "slash_half", "primary")])


@query(f"WITH {S.ENTRIES} SELECT CASE WHEN regexp_extract({S.key('headword')}, '^([a-z])', 1) = '' THEN '_' ELSE regexp_extract({S.key('headword')}, '^([a-z])', 1) END AS shard, id, werke_raw AS werke, literatur_raw AS literatur FROM e WHERE werke_raw IS NOT NULL OR literatur_raw IS NOT NULL")
def bibliography_shards(spark: SparkSession, root: str) -> DataFrame:
    return sinks.bibliography_shards(_entries(spark, root, "werke_raw", "literatur_raw"))


@query(
    f"""WITH {S.RESOLVED}, q AS (SELECT DISTINCT ON (entry_id, ordinal) entry_id, ordinal, status FROM r ORDER BY entry_id, ordinal, status), s AS (SELECT *, CASE WHEN lag(status) OVER w IS DISTINCT FROM status THEN 1 ELSE 0 END AS st FROM q WINDOW w AS (PARTITION BY entry_id ORDER BY ordinal)),
k AS (SELECT *, sum(st) OVER (PARTITION BY entry_id ORDER BY ordinal) AS run FROM s) SELECT entry_id, run::BIGINT AS run, any_value(status) AS status, count(*) AS n, min(ordinal) AS first, max(ordinal) AS last FROM k GROUP BY entry_id, run"""
)
def status_runs(spark: SparkSession, root: str) -> DataFrame:
    rows = _resolved(spark, root).groupBy("entry_id", "ordinal").agg(F.min("status").alias("status"))
    return votes.islands(rows, ["entry_id"], ["ordinal"], "status")


@query(
    f"""WITH {S.ENTRIES}, p AS (SELECT volume, ordinal, min(printed_page_start) AS page FROM e WHERE printed_page_start IS NOT NULL GROUP BY 1, 2)
SELECT e.id, (SELECT arg_max(p.page, p.ordinal) FROM p WHERE p.volume = e.volume AND p.ordinal <= e.ordinal) AS page FROM e"""
)
def pages_as_of(spark: SparkSession, root: str) -> DataFrame:
    rows = _entries(spark, root, "volume", "ordinal", "printed_page_start")
    # Entries with a printed page are marks; the others take the last one before them.
    marks = rows.where("printed_page_start IS NOT NULL").groupBy("volume", "ordinal").agg(F.min("printed_page_start").alias("page"))
    return votes.as_of(rows.select("id", "volume", "ordinal"), marks, ["volume"], "ordinal", "page").select("id", "page")


# --- layout and evidence ---------------------------------------------------------------


def _pages(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Pages and spans put together from the entries: one block per entry, its headword in
    bold, and the first headword of a page as its running head."""
    rows = _entries(spark, root, "volume", "ordinal", "pdf_page_start", "body_text").where("headword IS NOT NULL AND pdf_page_start IS NOT NULL")
    by = ["volume", F.col("pdf_page_start").alias("page")]
    text = F.concat_ws("\n\n", F.concat(F.lit("**"), "headword", F.lit("**")), "body_text")
    pages = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("ordinal", "headword", text.alias("t")))).alias("e"))
    whole = F.concat(F.col("e")[0]["headword"], F.lit("\n\n"), F.array_join(F.transform("e", lambda x: x["t"]), "\n\n"), F.lit("\n\n"), F.col("page").cast("string"))
    spans = rows.select(*by, F.col("ordinal").alias("block"), F.lit(0).alias("line"), F.lit(0).alias("span"), F.col("headword").alias("text"), F.lit("Bold").alias("font"), F.lit(False).alias("full_width"))
    bands = pages.select("volume", "page", F.lit(-1).alias("block"), F.lit(0).alias("line"), F.lit(0).alias("span"), F.col("e")[0]["headword"].alias("text"), F.lit("Bold").alias("font"), F.lit(True).alias("full_width"))
    return pages.select("volume", "page", whole.alias("text")), spans.unionByName(bands)


def _tagged_pages(spark: SparkSession, root: str) -> DataFrame:
    pages, spans = _pages(spark, root)
    found = layout.lines(spans, "Bold")
    return layout.tagged(pages, layout.candidates(found), layout.running_heads(found))


@query()
def tagged_pages(spark: SparkSession, root: str) -> DataFrame:
    return _tagged_pages(spark, root).drop("verdicts")


@query()
def tagging_diagnosis(spark: SparkSession, root: str) -> DataFrame:
    return layout.diagnosis(_tagged_pages(spark, root))


@query(
    f"""WITH {S.ENTRIES}, f AS (SELECT volume, pdf_page_start AS page, headword, row_number() OVER (PARTITION BY volume, pdf_page_start ORDER BY ordinal) AS rn FROM e WHERE headword IS NOT NULL AND pdf_page_start IS NOT NULL)
SELECT volume, page, {S.strip('headword')} AS head FROM f WHERE rn = 1 AND length({S.strip('headword')}) > 1"""
)
def running_heads(spark: SparkSession, root: str) -> DataFrame:
    return layout.running_heads(layout.lines(_pages(spark, root)[1], "Bold"))


@query(
    f"""WITH {S.ENTRIES}, w AS (SELECT unnest(regexp_extract_all(body_text, '([\\p{{L}}�]+)', 1)) AS word FROM e), u AS (SELECT split_part(word, '�', 1) || '[?]' || split_part(word, '�', 2) AS masked FROM w WHERE length(word) >= 4 AND length(replace(word, '�', '')) = length(word) - 1),
k AS (SELECT '�' AS code, masked, count(*) AS n FROM u GROUP BY masked) SELECT * FROM (SELECT *, row_number() OVER (ORDER BY n DESC, masked) AS rank FROM k) WHERE rank <= 10"""
)
def unreadable_evidence(spark: SparkSession, root: str) -> DataFrame:
    return layout.evidence(layout.unknown_words(_entries(spark, root, "body_text"), "body_text"))


_UNREADABLE = _VOTE[: _VOTE.index("un AS (")] + """un AS (SELECT '�' AS code, split_part(word, '�', 1) AS prefix, split_part(word, '�', 2) AS suffix FROM (SELECT unnest(regexp_extract_all(body_text, '([\\p{L}�]+)', 1)) AS word FROM e) WHERE length(word) >= 4 AND length(replace(word, '�', '')) = length(word) - 1),
""" + _VOTE[_VOTE.index("pl AS (") :].replace("0.55 * t", "0.3 * t").replace("n >= 2 * nx", "n >= nx")


@query(_UNREADABLE)
def unreadable_letters(spark: SparkSession, root: str) -> DataFrame:
    rows = _entries(spark, root, "body_text")
    return votes.vote(layout.unknown_words(rows, "body_text"), votes.word_counts(rows, "body_text"), share=0.3, margin=1.0)


@query("SELECT name, code, letter FROM (VALUES ('/C225', 225, 'α'), ('C233', 233, 'ι'), ('/C65', 65, NULL), ('/x', NULL, NULL)) AS v(name, code, letter)")
def decoded_names(spark: SparkSession, root: str) -> DataFrame:
    glyphs = spark.createDataFrame([("/C225",), ("C233",), ("/C65",), ("/x",)], "name string")
    return layout.decoded_names(glyphs, layout.code_page(spark, "iso8859_7")).select("name", "code", "letter")


# --- exports and checks ---------------------------------------------------------------


@query(
    f"""WITH {S.ENTRIES}, {S.REFERENCES}, {S.RESOLVED} SELECT r.entry_id AS source_entry_id, s.headword AS source_headword, s.volume AS source_volume, r.ordinal, r.raw_target, x.raw_context, r.status, r.resolved_entry_id AS target_entry_id, t.headword AS target_headword, t.volume AS target_volume, r.match_words, r.redirect_hops, r.suffix_stripped
FROM r JOIN x ON x.entry_id = r.entry_id AND x.ordinal = r.ordinal JOIN e s ON s.id = r.entry_id LEFT JOIN e t ON t.id = r.resolved_entry_id"""
)
def export_edges(spark: SparkSession, root: str) -> DataFrame:
    return sinks.edges_export(_references(spark, root), _resolved(spark, root), _entries(spark, root, "volume"))


@query(
    f"""WITH {S.ENTRIES}, {S.REFERENCES}, c AS (SELECT DISTINCT entry_id, ordinal, candidate_entry_id FROM resolved_cross_reference_candidates)
SELECT c.entry_id AS source_entry_id, c.ordinal, x.raw_target, x.raw_context, c.candidate_entry_id, e.headword AS candidate_headword, e.volume AS candidate_volume FROM c JOIN x USING (entry_id, ordinal) JOIN e ON e.id = c.candidate_entry_id"""
)
def export_ambiguous(spark: SparkSession, root: str) -> DataFrame:
    return sinks.ambiguous_export(_references(spark, root), table(spark, root, "resolved_cross_reference_candidates"), _entries(spark, root, "volume"))


@query(f"WITH {S.ENTRIES}, fl AS (SELECT entry_id, list_sort(list(DISTINCT flag)) AS flags FROM entry_flags GROUP BY entry_id) SELECT e.id, e.headword, e.volume, e.ordinal, e.entry_type, coalesce(fl.flags, []::VARCHAR[]) AS flags FROM e LEFT JOIN fl ON fl.entry_id = e.id")
def export_entries(spark: SparkSession, root: str) -> DataFrame:
    return sinks.entries_export(_entries(spark, root, "volume", "ordinal", "entry_type").drop("loaded_at"), table(spark, root, "entry_flags"))


def _absent(child: str, key: str, parent: str, parent_key: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT {key} AS k FROM {child} WHERE {key} IS NOT NULL) WHERE k NOT IN (SELECT {parent_key} FROM {parent} WHERE {parent_key} IS NOT NULL))"


def _outside(rows: str, column: str, allowed: list[str]) -> str:
    return f"(SELECT count(*) FROM {rows} WHERE {column} IS NULL OR {column} NOT IN ({', '.join(repr(a) for a in allowed)}))"


_CHECKS = {
    "resolved target without entry": _absent("resolved_cross_references", "resolved_entry_id", "entries", "id"),
    "candidate without entry": _absent("resolved_cross_reference_candidates", "candidate_entry_id", "entries", "id"),
    "lemma without entry": _absent("lemmas", "entry_id", "entries", "id"),
    "reference without source": _absent("cross_references", "entry_id", "entries", "id"),
    "entry without primary lemma": _absent("entries", "id", "(SELECT * FROM lemmas WHERE variant_type = 'primary')", "entry_id"),
    "entry delivered twice at once": "(SELECT count(*) FROM (SELECT id, loaded_at FROM entries GROUP BY 1, 2 HAVING count(*) > 1))",
    "entry type unknown": _outside("entries", "entry_type", checks.ENTRY_TYPES),
    "status unknown": _outside("resolved_cross_references", "status", checks.STATUSES),
    "variant unknown": _outside("lemmas", "variant_type", checks.VARIANTS),
    "flag unknown": _outside("entry_flags", "flag", checks.FLAGS),
    "empty body": f"(SELECT count(*) FROM entries WHERE body_text IS NULL OR {S.strip('body_text')} = '')",
    "bold or superscript left": r"(SELECT count(*) FROM entries WHERE regexp_matches(body_text, '(?s)\*\*.+?\*\*|<sup>'))",
    "unreadable count stale": f"(SELECT count(*) FROM entries WHERE unreadable_chars IS DISTINCT FROM ({S.count_sign('body_text')} + {S.count_sign('werke_raw')} + {S.count_sign('literatur_raw')}))",
    "target missing or superfluous": "(SELECT count(*) FROM resolved_cross_references WHERE (resolved_entry_id IS NULL) <> (status IN ('ambiguous', 'unresolved')))",
    "id not of its volume": "(SELECT count(*) FROM entries WHERE string_split(id, ':')[1] <> volume)",
}


@query(" UNION ALL ".join(f"SELECT '{name}' AS \"check\", {sql} AS violations" for name, sql in _CHECKS.items()))
def dataset_checks(spark: SparkSession, root: str) -> DataFrame:
    names = ["entries", "cross_references", "resolved_cross_references", "resolved_cross_reference_candidates", "lemmas", "entry_flags"]
    return checks.dataset(*[table(spark, root, n) for n in names])


def _count(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS \"check\", count(*) AS violations FROM {sql}"


_STRUCTURE = " UNION ALL ".join([
    _count("page before that of the entry before", "e a JOIN e b ON a.volume = b.volume AND a.ordinal = b.ordinal + 1 WHERE a.pdf_page_start < b.pdf_page_start"),
    _count("page span reversed", "e WHERE pdf_page_end < pdf_page_start"),
    _count("page span too long", "e WHERE pdf_page_end - pdf_page_start > 60"),
    _count("ordinal below 1", "e WHERE ordinal < 1 OR ordinal IS NULL"),
    _count("hops out of bounds", "r WHERE redirect_hops NOT BETWEEN 0 AND 3"),
    _count("match words out of bounds", "r WHERE match_words NOT BETWEEN 1 AND 6"),
    _count("redirect leads nowhere", "e WHERE entry_type = 'redirect' AND id NOT IN (SELECT entry_id FROM r WHERE ordinal = 0 AND resolved_entry_id IS NOT NULL)"),
    _count("reference ends at a redirect", "(SELECT DISTINCT resolved_entry_id AS id FROM r) WHERE id IN (SELECT id FROM e WHERE entry_type = 'redirect')"),
    _count("node without an edge", "n WHERE id NOT IN (SELECT source FROM g) AND id NOT IN (SELECT target FROM g)"),
    _count("edge end is no node", "(SELECT source AS id FROM g UNION SELECT target FROM g) WHERE id NOT IN (SELECT id FROM n)"),
    _count("edge to itself", "g WHERE source = target"),
    _count("references not numbered through", "(SELECT entry_id FROM x GROUP BY 1 HAVING count(*) <> max(ordinal) + 1)"),
    _count("place taken twice", "(SELECT volume, ordinal FROM e GROUP BY 1, 2 HAVING count(*) > 1)"),
    "SELECT 'volumes do not add up' AS \"check\", abs((SELECT sum(n) FROM (SELECT count(*) AS n FROM e GROUP BY volume)) - (SELECT count(*) FROM e))::BIGINT AS violations",
    "SELECT 'statuses do not add up' AS \"check\", abs((SELECT sum(n) FROM (SELECT count(*) AS n FROM r GROUP BY status)) - (SELECT count(*) FROM r))::BIGINT AS violations",
])


@query(f"{S.GRAPH}, {S.REFERENCES} {_STRUCTURE}")
def structure_checks(spark: SparkSession, root: str) -> DataFrame:
    entries = _entries(spark, root, "volume", "ordinal", "entry_type", "pdf_page_start", "pdf_page_end")
    nodes = graph.nodes(entries)
    resolved = _resolved(spark, root)
    return checks.structure(entries, _references(spark, root), resolved, stored(graph.edges(resolved, nodes), spark), nodes)


@query(
    f"WITH {S.ENTRIES}, f AS (SELECT volume, entry_type, count(DISTINCT id) AS n FROM entries WHERE date_trunc('month', loaded_at) = (SELECT min(date_trunc('month', loaded_at)) FROM entries) GROUP BY 1, 2), w AS (SELECT volume, entry_type, count(*) AS n FROM e GROUP BY 1, 2) "
    "SELECT volume, entry_type, coalesce(f.n, 0) AS n_before, coalesce(w.n, 0) AS n_now FROM f FULL JOIN w USING (volume, entry_type) WHERE coalesce(f.n, 0) <> coalesce(w.n, 0)"
)
def manifest_changes(spark: SparkSession, root: str) -> DataFrame:
    """Counts of the first month's deliveries against those of today, where they differ."""
    rows = table(spark, root, "entries", "id", "volume", "entry_type", F.date_trunc("month", "loaded_at").alias("m"))
    first = rows.join(F.broadcast(rows.agg(F.min("m").alias("m"))), "m").groupBy("volume", "entry_type").agg(F.countDistinct("id").alias("n"))
    now = _entries(spark, root, "volume", "entry_type").groupBy("volume", "entry_type").agg(F.count(F.lit(1)).alias("n"))
    return checks.compared(first, now, ["volume", "entry_type"])


@query(
    "WITH a AS (SELECT DISTINCT entry_id, ordinal FROM cross_references), b AS (SELECT DISTINCT entry_id, ordinal FROM resolved_cross_references) "
    "SELECT 'reference not resolved' AS \"check\", (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS violations UNION ALL SELECT 'resolution without reference', (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a))"
)
def pairing_checks(spark: SparkSession, root: str) -> DataFrame:
    return checks.unpaired(table(spark, root, "cross_references"), table(spark, root, "resolved_cross_references"))


@query(
    _RESOLVE + "SELECT 'stored ' || r.status AS \"check\", count(*) FILTER (r.status <> d.status OR r.resolved_entry_id IS DISTINCT FROM d.resolved_entry_id) AS violations FROM (SELECT DISTINCT entry_id, ordinal, status, resolved_entry_id FROM resolved_cross_references) r JOIN done d USING (entry_id, ordinal) GROUP BY r.status"
)
def recompute_check(spark: SparkSession, root: str) -> DataFrame:
    """Stored resolutions that resolving again does not give, by stored status."""
    return checks.recomputed(_resolved(spark, root), _run(spark, root)[0])


@query(f"WITH {S.ENTRIES}, c AS (SELECT {S.clean('body_text')} AS t FROM e) SELECT 'cleaning not idempotent' AS \"check\", count(*) FILTER ({S.clean('t')} <> t) AS violations FROM c")
def idempotence_check(spark: SparkSession, root: str) -> DataFrame:
    return checks.not_idempotent(_entries(spark, root, "body_text"), "body_text")


# --- streaming ------------------------------------------------------------------------


@query("SELECT volume, count(*) AS n FROM (SELECT DISTINCT id, volume, loaded_at FROM entries) GROUP BY volume")
def streamed_deliveries(spark: SparkSession, root: str) -> DataFrame:
    """Deliveries taken in by a stream, repeated ones once, counted afterwards."""
    from lemmaweave.streaming import ingest

    schema = table(spark, root, "entries", "id", "volume", "loaded_at").schema.simpleString()[7:-1].replace(":", " ")
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    import os

    whole = os.path.isdir(f"{root}/entries.parquet")
    stream = ingest.entries_stream(spark, f"{root}/entries.parquet" if whole else root, schema, "*" if whole else "entries.parquet")
    stream = stream.withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
    ingest.drain(ingest.once(stream, ["id"]), f"{folder}/rows", f"{folder}/state")
    return spark.read.parquet(f"{folder}/rows").groupBy("volume").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
