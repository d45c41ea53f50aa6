"""Mapping freely typed values to a canonical list by a set-similarity join.

Values and list entries become sets of character bigrams. Tokens are ordered by global
rarity; for a Jaccard threshold t two sets can only match if they share a token among
their first ``|x| - ceil(t |x|) + 1`` ones, so only these rare prefixes are joined.
Length and positional filters drop pairs that cannot reach t, the rest are verified
exactly, and the best are kept. An exact check follows: the best pair must be within a
small edit distance, since other compounds of the same stems reach a fair Jaccard, too.

Before that a value is brought to comparable form: look-alike characters unified, a word
cut at a line end completed from its context, marks of citation and inflection taken
off, misread letters and spellings of umlauts folded. An abbreviation (``Historiomon.``)
stands for the one entry that it begins.

Each distinct value is mapped once, whatever number of rows holds it.

Defined results: null and empty values map to none (-1); of equally near entries the one
with the smaller id is taken; an abbreviation of several entries maps to none; an empty
list maps all to none; repeated rows count once.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaweave.llm.lookalikes import unify
from lemmaweave.llm.scan_noise import SUSPENDED, skeleton
from lemmaweave.operators.skew import sized
from lemmaweave.sources import cut

#: Lowest Jaccard of a match on bigrams, and the most edits of one.
THRESHOLD, EDITS = 0.33, 2
FORM = "noun string, adjective string, stem string"

# Words that accompany a cited term.
ARTICLES = {"der", "die", "das", "den", "dem", "des", "ein", "eine"}
ENDINGS = ["en", "es", "er", "s", "n"]


def complete(value: str, context: str | None) -> str:
    """``value``; if it was cut at a line end, with its rest from ``context``."""
    cut = re.search(r"(?s)^(.*\w)[-‐¬\xad]\s*$", value)
    if not cut:
        return value
    if context is None:
        return cut[1] + "."
    rest = re.match(rf"(?s)\s*{re.escape(cut[1])}[-‐¬\xad]\s*(?!(?:{SUSPENDED})\b)([a-zäöüß][\w]*)(?:(, [a-zäöüß]+)\b)?", context)
    return cut[1] + rest[1] if rest else cut[1]


_UMLAUTS = str.maketrans({"ä": "a", "ö": "o", "ü": "u", "0": "o", "1": "l", "9": "g", "6": "g", "8": "b", "5": "s"})


def fold(word: str) -> str:
    """Comparable form of one word: case, umlauts and single misread signs folded."""
    if word.isupper() and len(word) > 1:
        word = word.lower()
    word = re.sub(r"(?<=[a-zäöü])B(?=[a-z])", "ss", word)
    return word.lower().replace("ß", "ss").translate(_UMLAUTS)


def spelled(word: str) -> str:
    """A folded word with umlauts that were written as two letters."""
    for a, b in (("ae", "a"), ("oe", "o"), ("ue", "u")):
        word = word.replace(a, b)
    return word


def misread(word: str) -> str:
    """A folded word with all confusable letters folded as well."""
    return skeleton(spelled(word).replace("cli", "ch").replace("ii", "u")).lower()


def misread_h(word: str) -> str:
    """The same, where ``lii`` is read as ``hi`` and not as ``lü``."""
    return skeleton(spelled(word).replace("cli", "ch").replace("li", "h")).lower()


def forms(value: str | None, context: str | None = None) -> tuple[str, str, str]:
    """(noun, adjective, stem): folded noun and adjective; stem if abbreviated, else ''."""
    if not value:
        return "", "", ""
    text = unify(complete(value, context))[0] or ""
    text = re.sub(r"^\s*(?:[sS]\.|vgl\.|Vgl\.|siehe|→|↑)\s+(?=\S{4})", "", text.strip(" \t\n,;:›‹»«„“”\"'"))
    text = re.sub(r"\(\s*s\.\s*d\.\s*\)|\(s\. d\.\)", "", text).strip(" \t\n,;:()›‹»«„“”\"'↑")
    text = re.sub(r"(?<!\w)(?:\w ){3,}\w(?!\w)", lambda m: m[0].replace(" ", ""), text)
    text = re.sub(r"(?<=[a-zäöüß])-(?=[A-ZÄÖÜ][a-zäöüß])", lambda m: "\0", text)
    text = re.sub("\0(.)", lambda m: m[1].lower(), text)
    noun, _, adjective = (p.strip() for p in text.partition(","))
    parts = [w for w in noun.split() if w.lower().strip(".") not in ARTICLES]
    if not parts:
        return "", "", ""
    if len(parts) > 1:
        upper = [w for w in parts if w[:1].isupper() and len(w) > 3]
        noun = upper[-1] if upper and not parts[0][:1].isupper() else max(parts, key=len) if len(parts) == 2 else parts[0]
        adjective = adjective or next((w for w in parts if w != noun and w[:1].islower()), "")
    else:
        noun = parts[0]
    stem = ""
    if noun.endswith("."):
        stem = fold_plain(noun.rstrip(".)"))
        stem = stem if len(stem) >= 4 else "-"
    return fold(noun.strip(".()")), fold(adjective.strip(" .,()")) if adjective else "", stem


def fold_plain(word: str) -> str:
    """``fold`` without the misreadings: beginnings of words stay beginnings."""
    word = word.lower().replace("ß", "ss")
    for a, b in (("ä", "a"), ("ö", "o"), ("ü", "u"), ("ae", "a"), ("oe", "o"), ("ue", "u")):
        word = word.replace(a, b)
    return word


def bigrams(word: str) -> list[str]:
    """The set of numbered bigrams of a padded word (repeats become their own tokens)."""
    seen: Counter[str] = Counter()
    out = []
    for a, b in zip(f"^{word}", f"{word}$", strict=True):
        seen[a + b] += 1
        out.append(f"{a}{b}{seen[a + b]}")
    return out


def edits(a: str, b: str, most: int = EDITS) -> int:
    """Edit distance with transpositions (optimal string alignment), ``most`` + 1 if larger.

    Only the band of the table that can stay within ``most`` is filled.
    """
    n, m, far = len(a), len(b), most + 1
    # An edit changes at most two letters of the symmetric difference.
    if abs(n - m) > most or len(set(a) ^ set(b)) > 2 * most:
        return far
    before, last = [far] * (m + 1), [j if j <= most else far for j in range(m + 1)]
    for i in range(1, n + 1):
        x, row = a[i - 1], [far] * (m + 1)
        if i <= most:
            row[0] = i
        for j in range(max(1, i - most), min(m, i + most) + 1):
            y = b[j - 1]
            d = last[j - 1] + (x != y)
            if last[j] < d:
                d = min(d, last[j] + 1)
            if row[j - 1] < d:
                d = min(d, row[j - 1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] < d:
                d = min(d, before[j - 2] + 1)
            row[j] = min(d, far)
        if min(row) > most:
            return far
        before, last = last, row
    return last[m]


def nearness(value: str, entry: str) -> int:
    """Edits between a value and an entry, an ending of the value left aside.

    Compared as they stand, with umlauts respelled, with a sharp s as one letter, and with
    confusable letters folded: a slip may look like a respelling or a misreading.
    """
    bare = [value, *(value[: -len(e)] for e in ENDINGS if value.endswith(e) and len(value) > len(e) + 3)]
    views = [str, spelled, misread, misread_h] + ([lambda w: w.replace("ss", "ß")] if "ss" in entry else [])
    return min(edits(f(v), f(entry)) for f in views for v in bare)


def similarity_join(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(left_id, right_id, jaccard) of all pairs with at least ``threshold``.

    Both sides: (id, tokens), tokens a set. Exact: the filters drop no pair that matches.
    """
    sides = left.select(F.lit(0).alias("side"), F.col("id").cast("string").alias("id"), "tokens").unionByName(right.select(F.lit(1).alias("side"), F.col("id").cast("string").alias("id"), "tokens"))
    exploded = sides.select("side", "id", F.explode("tokens").alias("token"))
    exploded = cut(exploded, left.sparkSession)
    # Tokens are few and some are in most sets, so their rarity is broadcast where counted small.
    rarity = sized(cut(exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n")), left.sparkSession))
    ordered = exploded.join(rarity, "token").groupBy("side", "id").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("s"))
    ordered = ordered.select("side", "id", F.transform("s", lambda t: t["token"]).alias("tokens"), F.size("s").alias("size"))
    ordered = cut(ordered, left.sparkSession)
    length = F.col("size") - F.ceil(F.col("size") * threshold) + 1
    prefixes = ordered.select("side", "id", "tokens", "size", F.posexplode(F.slice("tokens", F.lit(1), length.cast("int"))).alias("pos", "token"))
    a = prefixes.where("side = 0").select("token", F.col("id").alias("left_id"), F.col("tokens").alias("ta"), F.col("size").alias("na"), F.col("pos").alias("pa"))
    b = prefixes.where("side = 1").select("token", F.col("id").alias("right_id"), F.col("tokens").alias("tb"), F.col("size").alias("nb"), F.col("pos").alias("pb"))
    needed = F.ceil((F.col("na") + F.col("nb")) * (threshold / (1 + threshold)) - 1e-9)
    reachable = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    met = a.join(sized(b), "token").where((F.col("nb") >= F.col("na") * threshold) & (F.col("na") >= F.col("nb") * threshold))
    # A pair that meets on several prefix tokens is kept at the first of them, where
    # nothing before it is shared: no exchange is needed to make pairs distinct.
    first = F.size(F.array_intersect(F.slice("ta", F.lit(1), F.col("pa")), F.slice("tb", F.lit(1), F.col("pb")))) == 0
    shared = F.size(F.array_intersect("ta", "tb"))
    checked = met.where((reachable >= needed) & first).withColumn("shared", shared)
    return checked.select("left_id", "right_id", (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("jaccard")).where(F.col("jaccard") >= threshold)


def mapped(values: DataFrame, register: DataFrame, threshold: float = THRESHOLD, most: int = EDITS) -> DataFrame:
    """(value, context, register_id) for distinct (value, context); -1 for none.

    ``register``: (register_id, lemma).
    """

    @F.pandas_udf(FORM)
    def to_forms(v: pd.Series, c: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([forms(a, b) for a, b in zip(v, c, strict=True)], columns=["noun", "adjective", "stem"])

    @F.pandas_udf("array<struct<view:string,tokens:array<string>>>")
    def to_tokens(nouns: pd.Series) -> pd.Series:
        # Two views of a word, with tokens of their own: as folded, and without confusables.
        return nouns.map(lambda w: [{"view": v, "tokens": [v + t for t in bigrams(f(w))]} for v, f in (("0", str), ("1", misread))])

    @F.pandas_udf("int")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([nearness(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")

    @F.pandas_udf("string")
    def plain(v: pd.Series) -> pd.Series:
        return v.map(lambda x: fold_plain(x.split(",")[0].strip()))

    wide = values.select("value", "context").distinct().repartition(values.sparkSession.sparkContext.defaultParallelism)
    shaped = wide.withColumn("f", to_forms.asNondeterministic()(F.col("value"), F.col("context"))).select("value", "context", "f.*")
    entries = register.where(F.col("lemma").isNotNull()).select("register_id", "lemma").distinct()
    entries = entries.withColumn("f", to_forms.asNondeterministic()(F.col("lemma"), F.lit(None).cast("string"))).select("register_id", F.col("f.noun").alias("entry"), F.col("f.adjective").alias("entry_adjective"), plain(F.col("lemma")).alias("plain"))

    spark = values.sparkSession
    shaped, entries = cut(shaped, spark), cut(entries, spark)  # Python ran once; several joins read them
    nouns = shaped.where((F.length("noun") >= 4) & (F.col("stem") == "")).select(F.col("noun").alias("id")).distinct()
    view = lambda frame, word: frame.withColumn("t", F.explode(to_tokens(F.col(word)))).select(F.concat("t.view", F.col("id").cast("string")).alias("id"), "t.tokens")
    met = similarity_join(view(nouns, "id"), view(entries.select(F.col("register_id").alias("id"), "entry"), "entry"), threshold)
    pairs = met.select(F.expr("substring(left_id, 2)").alias("left_id"), F.expr("substring(right_id, 2)").alias("right_id"), "jaccard").groupBy("left_id", "right_id").agg(F.max("jaccard").alias("jaccard"))
    known = entries.select(F.col("register_id").cast("string").alias("right_id"), "register_id", "entry", "entry_adjective")
    # Few bytes but much work: as many tasks as cores, whatever the size of the exchange.
    pairs = pairs.repartition(spark.sparkContext.defaultParallelism, "left_id")
    near = pairs.join(sized(known), "right_id").withColumn("d", distance.asNondeterministic()(F.col("left_id"), F.col("entry")))
    # One edit in four letters at most: short words are not stretched to fit.
    near = near.where((F.col("d") <= most) & (F.col("d") * 4 <= F.length("entry")))
    best = near.groupBy(F.col("left_id").alias("noun")).agg(F.min(F.struct("d", (-F.col("jaccard")).alias("j"), "register_id")).alias("b")).select("noun", F.col("b.register_id").alias("by_form"))

    begun = entries.select("register_id", F.explode(F.transform(F.sequence(F.lit(4), F.greatest(F.length("plain"), F.lit(4))), lambda n: F.left(F.col("plain"), n))).alias("stem"))
    unique = begun.distinct().groupBy("stem").agg(F.count(F.lit(1)).alias("n"), F.min("register_id").alias("by_stem")).where("n = 1").select("stem", "by_stem")

    joined = shaped.join(best, "noun", "left").join(unique, "stem", "left")
    chosen = F.when(F.col("stem") != "", F.col("by_stem")).otherwise(F.col("by_form"))
    return joined.select("value", "context", F.coalesce(chosen, F.lit(-1)).cast("int").alias("register_id"))

