"""Visually identical text with different characters: find it and bring it to one form.

Per token the script sets of its letters (Unicode script extensions) are intersected;
common and inherited characters match any script. A token whose resolved set is empty is
mixed; if all its letters of other scripts look like letters of one script, it is a
mixed-script confusable. A token of one other script all of whose letters look Latin is a
whole-script confusable where Latin stands beside it. Either takes the spelling of the
consistent script, and the remaining forms are normalised: width and styled forms,
ligatures, decomposed accents, invisible characters, special spaces.

Not look-alikes: words wholly in another script, letters no Latin reader would mistake
(garbled encodings leave such letters inside Latin words), ordinary blanks at the ends.

Defined results: null stays null and is no case; an empty text is no case; a value of
special spaces only is a case and becomes empty; repeated rows count once.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of other scripts, or other letters of the same, and the Latin ones
# they look like (the small hard sign and the small ge are not mistaken by a reader).
ALIKE = {
    "Cyrillic": ("АВЕЅІЈКМНОРСТУХЗаеѕіјорсухһԁԛԝкмнтвԌҮӀѵ", "ABESIJKMHOPCTYX3aesijopcyxhdqwkmhтвGYlv"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυχϲϳ", "ABEZHIKMNOPTYXaiknoptuxcj"),
    "Armenian": ("ՕՏՍԼօսհոզյց", "OSULouhnqjg"),
    "Cherokee": ("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎿᏀᏃᏎᏏᏒᏔᏙᏚᏞᏟᏢᏦᏴ", "DRTiAJEWMHOGZ4bRWVSLCPKB"),
    "Coptic": ("ⲀⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲌⲟⲥⲣ", "ABEHIKMNOPCTYXZocp"),
    "Lisu": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    "Latin": ("ɡɑᴏᴄᴠᴡᴢꜱɩ", "gaocvwzsi"),
}
# The scripts that letters are tested for, and the systems that write several.
SCRIPTS = (
    "Latin Greek Cyrillic Armenian Hebrew Arabic Syriac Thaana Devanagari Bengali Gurmukhi Gujarati Oriya Tamil Telugu Kannada Malayalam Sinhala Thai Lao "
    "Tibetan Myanmar Georgian Hangul Ethiopic Cherokee Canadian_Aboriginal Ogham Runic Khmer Mongolian Hiragana Katakana Bopomofo Han Yi Gothic Coptic "
    "Glagolitic Tifinagh Lisu Vai Deseret Old_Italic Phoenician Nko Bamum Javanese Balinese"
).split()
SYSTEMS = {"Han": {"Japanese", "Korean", "Chinese"}, "Hiragana": {"Japanese"}, "Katakana": {"Japanese"}, "Hangul": {"Korean"}, "Bopomofo": {"Chinese"}}
ALL = frozenset(SCRIPTS) | {"Japanese", "Korean", "Chinese"}
CONFUSABLE = {a: b for xs, ys in ALIKE.values() for a, b in zip(xs, ys, strict=True) if b.isascii()}
INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁤⁦-⁯︀-️﻿]")
SPACES = re.compile("[   -     　]")
LIGATURES = re.compile("[ﬀ-ﬆĲĳǄ-ǌǱ-ǳ\u2160-\u217f]")
#: Anything outside ordinary Latin text and its punctuation (Java syntax).
SUSPECT = r"[^\x{00}-\x{7E}\x{A1}-\x{AC}\x{AE}-\x{24F}\x{2B0}-\x{2FF}\x{1E00}-\x{1EFF}–—›‹»«„“”‘’‚•…†↑]"
WORD = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")
#: Signs that multi-byte text leaves when it is decoded wrongly; a special space after
#: one of them is a byte of that text.
GARBLE_SIGN = "[ÃÂâ€ÐÑ├┬ÔΓ√‰¸ˆ]"
GARBLE = re.compile("[ÃÂâ€ÐÑ├┬ÔΓ√‰¸ˆ][ ­]?")


@lru_cache(1)
def _tests() -> list[tuple[str, Any]]:
    import regex

    return [(name, regex.compile(rf"\p{{Script_Extensions={name}}}")) for name in SCRIPTS]


@lru_cache(65536)
def scripts(char: str) -> frozenset[str]:
    """The script set of a character (its Unicode script extensions, with the systems that
    write several scripts together); all scripts for common and inherited ones."""
    if not char.isalpha() or compat(char) != char:
        return ALL
    own = {name for name, test in _tests() if test.match(char)}
    return frozenset(own.union(*(SYSTEMS.get(n, set()) for n in own))) or ALL


def resolved(word: str) -> frozenset[str]:
    """The resolved script set of a word: the scripts in which all of it is written."""
    return ALL.intersection(*map(scripts, word)) if word else ALL


@lru_cache(65536)
def compat(char: str) -> str:
    """The plain form of a width, styled or ligature character, else the character."""
    if LIGATURES.match(char):
        return unicodedata.normalize("NFKC", char)
    tag = unicodedata.decomposition(char).split(" ")[0]
    return unicodedata.normalize("NFKC", char) if tag in ("<wide>", "<narrow>", "<font>", "<circle>") else char


#: Per script the letter of it that looks like a Latin one.
INVERSE = {name: {y: x for x, y in zip(*pair, strict=True)} for name, pair in ALIKE.items() if name != "Latin"}


def resolve(word: str, latin_around: bool) -> str:
    """The spelling of a word in one script, if it is confusable with such a word.

    A word of several scripts takes the Latin spelling if all letters of others look Latin,
    else that of the one script that most of its letters are of, if the rest look like
    letters of it; else it stays (garbled or a mixture that nobody would mistake). A word
    of one other script stays, unless all of it looks Latin and Latin words stand beside it.
    """
    common = resolved(word)
    other = [c for c in word if c in CONFUSABLE or "Latin" not in scripts(c)]
    if not other:
        return word
    latin = "".join(CONFUSABLE.get(c, c) for c in word) if all(c in CONFUSABLE for c in other) else None
    if common and "Latin" not in common:
        letters = sum(c.isalpha() for c in word)
        return latin if latin is not None and latin_around and len(other) == letters and len(common) == 1 else word
    if latin is not None:
        return latin
    for name, letters_ in INVERSE.items():
        own = [c for c in word if name in scripts(c) and scripts(c) != ALL]
        rest = [c for c in word if name not in scripts(c)]
        if not common and len(own) > len(rest) and all(c in letters_ for c in rest):
            return "".join(letters_[c] if c in rest else c for c in word)
    return word


def unify(text: str | None) -> tuple[str | None, bool]:
    """(the one form, whether the text held look-alike characters)."""
    if not text:
        return text, False
    changed = False
    out = text
    garbled = GARBLE.search(out) is not None
    # A sign right behind one of garbled text is a byte of it; others count.
    for pattern, to in ((INVISIBLE, ""), (SPACES, " ")):
        swapped = re.sub(rf"(?<!{GARBLE_SIGN}){pattern.pattern}", to, out)
        if swapped != out:
            out, changed = swapped.strip(" ") if to else swapped, True
    plain = "".join(map(compat, out))
    if plain != out and not (garbled and set(out) & set("ﬂﬁ")):
        out, changed = plain, True
    composed = unicodedata.normalize("NFC", out)
    if composed != out and re.search("[̀-ͯ]", out):
        changed = True
    out = composed
    if not out.isascii():
        latin = any("Latin" in scripts(c) and scripts(c) != ALL for c in out)
        consistent = WORD.sub(lambda m: resolve(m.group(), latin), out)
        changed |= consistent != out
        out = consistent
    return out, changed


def unified(column: Column) -> Column:
    """``column`` in its one form, as (text, changed)."""

    @F.pandas_udf("text string, changed boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([unify(t) for t in texts], columns=["text", "changed"])

    return run(column)


def found(sources: list[tuple[DataFrame, str, Column, Column, Column]]) -> DataFrame:
    """Distinct (field, entry_id, sub_key) of the values with look-alike characters.

    ``sources``: (frame, field name, entry id, sub key, value). Ordinary values are
    dropped by one JVM scan; Python sees the suspicious ones, each distinct case once.
    """
    parts = [
        frame.select(F.lit(name).alias("field"), entry.cast("string").alias("entry_id"), sub.cast("string").alias("sub_key"), value.cast("string").alias("value"))
        for frame, name, entry, sub, value in sources
    ]
    rows = parts[0]
    for other in parts[1:]:
        rows = rows.unionByName(other)
    odd = rows.where(F.col("value").rlike(SUSPECT)).distinct()
    return odd.where(unified(F.col("value"))["changed"]).select("field", "entry_id", "sub_key").distinct()
