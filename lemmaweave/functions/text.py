"""Column functions on headwords and texts.

All are built-in expressions (no Python workers) unless the docstring says otherwise, and
pass null through. White space is Unicode white space, as everywhere in the engine.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters folded for matching, endings and articles of the language.
FOLDED_FROM = "äöüÄÖÜéèêëáàâíìîïóòôúùûçñ"
FOLDED_TO = "aouAOUeeeeaaaiiiiooouuucn"
SUFFIXES = ["en", "er", "em", "es", "e", "n", "s"]
ARTICLES = ["der", "die", "das", "den", "dem", "des"]
SUSPENDED = ["und", "oder", "bzw", "beziehungsweise", "sowie", "wie", "od", "u", "resp", "respektive"]
ERAS = [("antiquity", None, 500), ("middle_ages", 500, 1450), ("early_modern", 1450, 1800), ("nineteenth", 1800, 1900), ("modern", 1900, None)]
MARKS = {"´": "́", "¯": "̄", "˙": "̇", "ˇ": "̌", "˜": "̃"}

Text = Column | str


def _col(c: Text) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Text) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(_col(c), r"(?U)\A\s+|\s+\z", "")


def fold_diacritics(c: Text) -> Column:
    return F.replace(F.translate(_col(c), FOLDED_FROM, FOLDED_TO), F.lit("ß"), F.lit("ss"))


def key(c: Text) -> Column:
    """The one lookup key of a word or phrase: folded, unbracketed, single blanks, case folded."""
    spaced = F.translate(fold_diacritics(c), "()", "  ")
    lowered = F.lower(F.trim(F.regexp_replace(spaced, r"(?U)\s+", " ")))
    return F.replace(lowered, F.lit("ς"), F.lit("σ"))


def core(c: Text) -> Column:
    """Before the first comma or opening bracket."""
    return strip(F.regexp_extract(_col(c), r"\A([^,(]*)", 1))


def lemma(c: Text) -> Column:
    """The headword proper: cut at the reference arrow, trailing punctuation off."""
    return F.regexp_replace(strip(F.regexp_replace(_col(c), r"(?s)[›↑].*\z", "")), r"[,.;: ]+\z", "")


def words(c: Text) -> Column:
    """Words between white space."""
    return F.filter(F.split(_col(c), r"(?U)\s+"), lambda w: w != "")


def phrases(c: Text, n: int = 6) -> Column:
    """Beginnings of two to ``n`` words, longest first, clipped of punctuation."""
    taken = F.slice(words(c), 1, n)
    lengths = F.when(F.size(taken) >= 2, F.sequence(F.size(taken), F.lit(2), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    clipped = F.transform(lengths, lambda k: F.regexp_replace(F.array_join(F.slice(taken, F.lit(1), k), " "), r"[,.;:) ]+\z", ""))
    return F.filter(clipped, lambda p: F.contains(p, F.lit(" ")))


def comma_prefixes(c: Text) -> Column:
    """Comma-delimited beginnings of a lemma that hold more than one word."""
    chunks = F.transform(F.split(lemma(c), ","), strip)
    joined = F.transform(F.sequence(F.lit(1), F.size(chunks)), lambda k: F.regexp_replace(strip(F.array_join(F.slice(chunks, F.lit(1), k), ", ")), r"[,.;: ]+\z", ""))
    return F.filter(joined, lambda p: F.contains(p, F.lit(" ")))


def comma_inverted(c: Text) -> Column:
    """``b a`` for a lemma ``a, b`` whose second part is one lower-case word, else null."""
    parts = F.transform(F.split(_col(c), ","), strip)
    fits = (F.size(parts) == 2) & (F.element_at(parts, 1) != "") & F.element_at(parts, 2).rlike(r"(?U)\A\p{Ll}\S*\z")
    return F.when(fits, F.concat_ws(" ", F.element_at(parts, 2), F.element_at(parts, 1)))


def without_article(c: Text) -> Column:
    """Without a leading article."""
    return F.when(F.lower(F.regexp_extract(_col(c), r"(?U)\A(\S+)", 1)).isin(ARTICLES), F.regexp_replace(_col(c), r"(?U)\A\S+\s*", "")).otherwise(_col(c))


def volume_of(c: Text) -> Column:
    return F.substring_index(_col(c), ":", 1)


def entry_id(volume: Text, page: Text, ordinal: Text) -> Column:
    return F.format_string("%s:%04d:%04d", _col(volume), F.coalesce(_col(page), F.lit(0)), _col(ordinal))


def compose_diacritics(c: Text) -> Column:
    """Letters composed with a following spacing accent, whether in <sup> or bare.

    Arrow function: Spark has no Unicode normalisation.
    """
    marks = "".join(MARKS)
    raised, bare = re.compile(f"([^\\W\\d_])<sup>([{marks}])</sup>"), re.compile(f"([^\\W\\d_])([{marks}])")

    def one(hit: re.Match[str]) -> str:
        return unicodedata.normalize("NFC", hit[1].replace("ı", "i") + MARKS[hit[2]])

    @F.pandas_udf("string")
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: bare.sub(one, raised.sub(one, t)), na_action="ignore")

    # Texts without an accent (nearly all) do not leave the JVM.
    return F.when(_col(c).rlike(f"[{marks}]"), compose(_col(c))).otherwise(_col(c))


def strip_italics(c: Text) -> Column:
    """Paired single underscores removed, per line; runs of underscores are text."""
    single = r"(?<!_)_(?!_)"
    pair = single + r"((?:[^_]|_{2,}+){1,200})" + single

    def line(x: Column) -> Column:
        n = F.regexp_count(x, F.lit(single))
        return F.when((n > 0) & (n % 2 == 0), F.regexp_replace(x, pair, "$1")).otherwise(x)

    return F.array_join(F.transform(F.split(_col(c), "\n", -1), line), "\n")


def join_composites(c: Text) -> Column:
    """Two-part symbols written as one, and a negation stroke moved behind its symbol."""
    paired = F.regexp_replace(F.regexp_replace(_col(c), r"(?U)↦\s*→", "↦"), r"(?U)⇋\s*⇋", "⇋")
    return F.regexp_replace(paired, "(?U)(?<!\\S)̸\\s*(\\S)", "$1̸")


def tidy(c: Text) -> Column:
    """Superscripts, bold and white space; the part of ``clean`` SQL can say as well."""
    out = F.regexp_replace(_col(c), r"(?s)<sup>(.*?)</sup>", "^$1")
    out = F.regexp_replace(out, r"(?s)\*\*(.+?)\*\*", "$1")
    out = F.regexp_replace(strip_italics(out), r"\*{1,2}", "")
    out = F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return strip(F.regexp_replace(out, r"(?Um)[^\S\n]*\n[^\S\n]*", "\n"))


def clean(c: Text) -> Column:
    """Markup-free form; unreadable signs survive; null stays null."""
    return tidy(join_composites(compose_diacritics(c)))


def count_sign(c: Text, sign: str = "�") -> Column:
    """How often a sign is in a text; 0 for null."""
    return F.coalesce(F.length(_col(c)) - F.length(F.replace(_col(c), F.lit(sign), F.lit(""))), F.lit(0))


def heal_hyphens(c: Text) -> Column:
    """Words broken by a hyphen and white space joined; suspended hyphens stay."""
    return F.regexp_replace(_col(c), r"(?U)(?<=\p{L})-\s+(?!(?:" + "|".join(SUSPENDED) + r")\b)(?=\p{Ll})", "")


def era(year: Text) -> Column:
    """The era of a signed year, by half-open bounds."""
    out = None
    for name, low, high in ERAS:
        test = (F.lit(True) if low is None else _col(year) >= low) & (F.lit(True) if high is None else _col(year) < high)
        out = F.when(test, name) if out is None else out.when(test, name)
    assert out is not None
    return F.when(_col(year).isNotNull(), out)


def display_name(headword: Text, body: Text) -> Column:
    """The headword with the gloss that follows it at the head of its text."""
    h, rest = _col(headword), F.substr(_col(body), F.length(_col(headword)) + 1)
    gloss = F.regexp_replace(rest, r"\A[, ]+", "")
    for stop in (",", "†", "(", ";", "."):
        gloss = F.substring_index(gloss, stop, 1)
    gloss = strip(gloss)
    fits = F.startswith(_col(body), h) & (gloss != "") & (F.length(gloss) <= 40)
    joined = F.concat(h, F.when(F.startswith(rest, F.lit(",")), F.lit(", ")).otherwise(F.lit(" ")), gloss)
    return F.when(fits, joined).otherwise(h)


def escape_html(c: Text) -> Column:
    out = _col(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def fold_query(text: str) -> str:
    """A typed query folded like a key (driver side: it is one string)."""
    plain = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return plain.replace("(", "").replace(")", "").lower().strip()


def german_number(c: Text, digits: int = 0) -> Column:
    """A number with dots between thousands and a decimal comma."""
    return F.translate(F.format_number(_col(c), digits), ",.", ".,")


def percent(c: Text, digits: int = 1) -> Column:
    return F.concat(german_number(_col(c) * 100, digits), F.lit(" %"))


def year_text(c: Text) -> Column:
    """A signed year as it is written: ``428 v. Chr.``, ``1724``."""
    return F.when(_col(c) < 0, F.concat((-_col(c)).cast("string"), F.lit(" v. Chr."))).otherwise(_col(c).cast("string"))


def life_text(birth: Text, death: Text) -> Column:
    """A life of signed years; the era stands once if it holds for both."""
    b, d = _col(birth), _col(death)
    both = F.concat((-b).cast("string"), F.lit("–"), (-d).cast("string"), F.lit(" v. Chr."))
    return F.when((b < 0) & (d < 0), both).otherwise(F.concat(year_text(b), F.lit("–"), year_text(d)))


def palette_color(rank: Text, palette: int = 20) -> Column:
    """Colour of a community by rank: even hues, neutral beyond the palette."""
    hue = F.pmod(_col(rank) * F.lit(0.618033988749895), F.lit(1.0)) * 6
    sector = F.floor(hue)
    f = hue - sector
    v, s = 0.93, 0.42
    p, q, t = F.lit(v * (1 - s)), v * (1 - s * f), v * (1 - s * (1 - f))
    v_ = F.lit(v)

    def channel(order: list[Column]) -> Column:
        picked = F.element_at(F.array(*order), (sector % 6 + 1).cast("int"))
        return F.lpad(F.lower(F.hex(F.floor(picked * 255))), 2, "0")

    rgb = F.concat(F.lit("#"), channel([v_, q, p, p, t, v_]), channel([t, v_, v_, q, p, p]), channel([p, p, t, v_, v_, q]))
    return F.when(_col(rank) >= palette, "#6b7280").otherwise(rgb)
