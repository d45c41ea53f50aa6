"""Text decoded with the wrong character encoding: find it and restore it.

A smoothed character trigram model is trained on clean records (all of them). Every
candidate encode-decode chain is tried on each suspicious word, the model scores the
results, and the likeliest is accepted if it beats the word as it stands by a validated
margin. The margin is fitted on all clean words with an umlaut, each as often as it occurs:
garbled by every chain that can write them they must come back, and spelled with a foreign
letter they must stay; it is the largest value with the fewest mistakes of both kinds.

Chains of multi-byte text are undone piecewise: inside a word only the runs of characters
whose bytes form whole UTF-8 sequences change, so half-garbled words are restored too;
text garbled twice is undone twice. A U+FFFD beside a letter is a lost letter by
definition, so it is always a case; the likeliest letter is put there only if it beats
every other letter by a margin of its own, validated on the same words with one letter
taken out.

All texts are read once (``survey``): clean ones are counted for the model and give their
words, of the others only the suspicious words leave the pass. The model is an array of
ALPHABET**3 numbers whatever the size of the corpus, which is what is broadcast. The words
are tried in tasks (``tried``), and margins come from running sums over all gains
(``thresholds``); neither words nor gains are gathered in one process.

Defined results: null and blank texts are no cases and stay null or blank; a U+FFFD that
stands alone is no case; words wholly in another script and correct foreign letters are
no cases; repeated rows count once; a model trained on no records scores all characters
alike, so that only valid multi-byte sequences and lost letters are found.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Any

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lemmaweave.sources import cut

ALPHABET = 40
# Characters of clean German text and its formulas.
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüß"
CLEAN = r"\x{09}\x{0A}\x{0D}\x{20}-\x{7E}äöüÄÖÜß–—†↑›‹»«„“”‘’‚•·§…→∈∧∨∀∃⊢λ□≤≥¬×°"
MULTI_BYTE = ["cp1252", "latin-1", "cp850", "cp437", "mac_roman", "cp1250", "cp1251", "cp1253", "cp1254", "koi8_r"]
SINGLE_BYTE = [
    ("latin-1", "cp1251"), ("latin-1", "cp1253"), ("latin-1", "cp437"), ("latin-1", "cp850"), ("latin-1", "mac_roman"),
    ("latin-1", "koi8_r"), ("latin-1", "cp1255"), ("latin-1", "cp1256"), ("cp850", "cp1252"), ("cp437", "cp1252"),
    ("mac_roman", "cp1252"), ("cp850", "latin-1"), ("mac_roman", "latin-1"), ("latin-1", "iso8859_5"), ("latin-1", "iso8859_7"), ("latin-1", "cp1257"),
]
LOST = "äöüßÄÖÜéáèñçøå"
FOREIGN_LETTERS = [("a", "á"), ("a", "à"), ("a", "â"), ("a", "å"), ("e", "é"), ("e", "è"), ("e", "ê"), ("i", "í"), ("o", "ó"), ("o", "ô"), ("o", "ø"), ("u", "ú"), ("n", "ñ"), ("c", "ç"), ("c", "č"), ("s", "š"), ("z", "ž")]
#: Correct words with foreign letters that the margin must leave alone.
FOREIGN = ["Café", "Señor", "Ångström", "Øresund", "Čapek", "Šafařík", "Łódź", "Ávila", "Château", "François", "Brontë", "naïve", "São", "d’Être", "Âge", "Èze"]


# Letters of other scripts that look Latin are another problem; what a chain may restore.
ALIKE = set("іѕјаеорсухАВЕКМНОРСТХΑΒΕΖΗΙΚΜΝΟΡΤΥΧαορνικτυ")
MEANT = set("äöüßÄÖÜéèáàâêôûçñøå")


def _byte_map(encoding: str) -> dict[str, int]:
    """Character to byte of a single-byte encoding; unassigned bytes stand for themselves."""
    out: dict[str, int] = {}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


def _translation(true: str, wrong: str) -> dict[int, str]:
    """Wrongly decoded character to the one that was meant."""
    out = {}
    for char, b in _byte_map(wrong).items():
        try:
            meant = bytes([b]).decode(true)
        except UnicodeDecodeError:
            continue
        # Letters that read as Latin ones belong to words of other languages or are
        # look-alikes (another problem); only signs no such word holds are undone.
        if meant in MEANT and meant != char and not char.isspace() and char not in ALIKE and not (wrong in ("cp1252", "latin-1") and char.isalpha()):
            out[ord(char)] = meant
    return out


BYTES = {e: _byte_map(e) for e in MULTI_BYTE}
LEADS = {e: re.compile("[" + "".join(re.escape(c) for c, b in m.items() if 0xC2 <= b <= 0xF4 and c not in ALIKE) + "][" + "".join(re.escape(c) for c, b in m.items() if b < 0xC0) + "]+") for e, m in BYTES.items()}
TABLES = {f"{t}>{w}": _translation(t, w) for t, w in SINGLE_BYTE}
#: Characters without which a chain changes nothing; none is ASCII.
FIRST = {e: {c for c, b in m.items() if 0xC2 <= b <= 0xF4 and c not in ALIKE} for e, m in BYTES.items()}
KEYS = {chain: {chr(c) for c in table} for chain, table in TABLES.items()}
#: A non-breaking space is a byte of garbled text; it must not cut words.
UNBROKEN = re.compile(r"[^ \t\n\r\f\v]+")
#: Chains through the upper half of cp1252 may leave clean-looking signs only.
HIDDEN = re.compile(r"[A-Za-zäöüß][„”‡†‰][A-Za-zäöüß]")
LOST_LETTER = re.compile("(?<=[^\\W\\d_])\ufffd+|\ufffd+(?=[^\\W\\d_])")
WITH_UMLAUT = re.compile(r"(?<![^\W\d_])[A-Za-z]*[äöüÄÖÜß][A-Za-zäöüÄÖÜß]*(?![^\W\d_])")
SUSPECT = re.compile("[^" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), CLEAN).replace(re.escape(" ") + "-" + re.escape("~"), " -~") + "]")


def _undo_utf8(word: str, encoding: str) -> str:
    """Undo UTF-8 read as ``encoding`` wherever whole sequences stand."""
    table = BYTES[encoding]

    def fix(hit: re.Match[str]) -> str:
        raw = bytes(table[c] for c in hit.group())
        lead = raw[0]
        n = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        if len(raw) < n:
            return hit.group()
        try:
            return raw[:n].decode("utf-8") + fix_rest(hit.group()[n:])
        except UnicodeDecodeError:
            return hit.group()

    def fix_rest(rest: str) -> str:
        return LEADS[encoding].sub(fix, rest)

    return LEADS[encoding].sub(fix, word)


def candidates(word: str) -> Iterator[tuple[str, str]]:
    """(chain, restored) for every chain that changes ``word``."""
    seen = {word}
    odd = {c for c in word if c > "\x7f"}
    for e in MULTI_BYTE:
        if FIRST[e].isdisjoint(odd):
            continue
        once = _undo_utf8(word, e)
        if once not in seen:
            seen.add(once)
            yield f"utf-8>{e}", once
            twice = _undo_utf8(once, e)
            if twice not in seen:
                seen.add(twice)
                yield f"utf-8>{e} twice", twice
    for chain, table in TABLES.items():
        if KEYS[chain].isdisjoint(odd):
            continue
        once = word.translate(table)
        if once not in seen:
            seen.add(once)
            yield chain, once


def _class_table() -> np.ndarray:
    """Class of each character of the basic plane."""
    table = np.full(0x10000, 36, np.int64)
    for point in range(0x10000):
        char = chr(point)
        low = char.lower()
        if low in LETTERS and len(low) == 1:
            table[point] = 1 + LETTERS.index(low)
        elif char.isspace():
            table[point] = 0
        elif char.isdigit():
            table[point] = 31
        elif char.isalpha():
            name = unicodedata.name(char, "")
            table[point] = 32 if name.startswith("LATIN") else 33 if name.startswith("GREEK") else 34 if name.startswith("CYRILLIC") else 37
        elif point < 0x7F or char in "–—†↑›‹»«„“”‘’‚•·":
            table[point] = 35
    return table


_CLASSES: list[np.ndarray] = []


def codes(text: str) -> np.ndarray:
    """Character classes of a text with a boundary on both sides."""
    if not _CLASSES:
        _CLASSES.append(_class_table())
    points = np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32)
    return _CLASSES[0][np.minimum(points, 0xFFFF)]


def saved(chain: str, word: str, other: str) -> float:
    """What the signs count that a chain of whole byte sequences saves."""
    return 2.0 * (len(word) - len(other)) if chain.startswith("utf-8") else 0.0


@dataclass
class Model:
    """Smoothed log probabilities of character trigrams, and the accepted margin."""

    logs: np.ndarray
    margin: float = 4.0
    fill_margin: float = 0.0

    @staticmethod
    def of(counts: np.ndarray, margin: float = 4.0) -> Model:
        """Interpolates the trigram with its bigram, unigram and a uniform part."""
        tri = counts.reshape(ALPHABET, ALPHABET, ALPHABET).astype(float)
        bi, uni = tri.sum(0), tri.sum((0, 1))
        p1 = (uni + 1) / (uni.sum() + ALPHABET)
        p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
        p3 = (tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)
        return Model(np.log(p3).astype(np.float32).ravel(), margin)

    def score(self, word: str) -> float:
        """Log likelihood of a word; a wrong word of n odd characters loses about 2-3 n grams."""
        c = codes(word)
        return float(self.logs[(c[:-2] * ALPHABET + c[1:-1]) * ALPHABET + c[2:]].sum(dtype=float))

    def scores(self, words: list[str]) -> dict[str, float]:
        """The score of each of many words (none empty), computed at once."""
        if not words:
            return {}
        c = codes(" ".join(words))
        grams = self.logs[(c[:-2] * ALPHABET + c[1:-1]) * ALPHABET + c[2:]].astype(float)
        starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
        grams[starts[1:] - 1] = 0.0  # from the end of a word into the next
        return dict(zip(words, np.add.reduceat(grams, starts).tolist(), strict=True))

    def restore(self, word: str) -> tuple[str, str | None]:
        """(restored word, chain) — the word itself and None if nothing is likelier."""
        if "\ufffd" in word:
            if not LOST_LETTER.search(word):
                return word, None
            filled = self.fill(word)
            return (self.restore(filled)[0] if "\ufffd" not in filled else filled), "lost"
        if not SUSPECT.search(word):
            if not HIDDEN.search(word):
                return word, None
        # Words without a Latin letter may only hide whole multi-byte sequences.
        latin = any("a" <= c <= "z" or "A" <= c <= "Z" for c in word)
        if not latin and not re.search(r"[\x80-\x9fÃÂâ€ÐÑÎÏ├ÔΓ√]", word):
            return word, None
        own, best, chain = self.score(word), word, None
        top = own + self.margin
        for name, other in candidates(word):
            if not latin and not name.startswith("utf-8"):
                continue
            gain = self.gain(name, word, other) + own
            if gain > top:
                top, best, chain = gain, other, name
        return best, chain

    def gain(self, chain: str, word: str, other: str) -> float:
        """What a chain gains; whole byte sequences are rarely whole by chance, which counts
        for each sign they save."""
        return self.score(other) - self.score(word) + saved(chain, word, other)

    def fill(self, word: str) -> str:
        """Puts the likeliest letter for each U+FFFD beside a letter; signs for which no
        letter is likelier than the others by the margin stay."""
        at = 0
        while (hit := LOST_LETTER.search(word, at)) is not None:
            a, b = hit.span()
            start = a == 0 or not word[a - 1].isalpha()
            ones = [c for c in LOST if c.isupper() == start or c.islower() and not start]
            # A letter leaves one sign or one for each of its bytes; two signs may be two letters.
            twos = [x + y for x in ones for y in LOST if y.islower()] if b - a >= 2 else []
            ranked = sorted(((self.score(word[:a] + c + word[b:]), c) for c in (*ones, *twos)), reverse=True)
            if ranked[0][0] - ranked[1][0] < self.fill_margin:
                at = b
                continue
            word = word[:a] + ranked[0][1] + word[b:]
        return word

    def fix(self, text: str) -> tuple[str, str | None]:
        """(text with every garbled word restored, chains used or None)."""
        used: list[str] = []

        def one(hit: re.Match[str]) -> str:
            word, chain = self.restore(hit.group())
            if chain:
                used.append(chain)
            return word

        out = UNBROKEN.sub(one, text)
        return out, ",".join(sorted(set(used))) if used else None


def odd_words(text: str) -> list[str]:
    """Words that a chain may undo, once each."""
    if not SUSPECT.search(text) and not HIDDEN.search(text):
        return []
    return sorted({w for w in UNBROKEN.findall(text) if SUSPECT.search(w) or HIDDEN.search(w)})


def survey(frame: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """What one pass over all texts gives; to be materialised.

    Rows with ``gram``: (gram, n), trigram counts of the clean texts of a partition. Rows with
    ``word``: (word, n), how often words with an umlaut occur in a batch of its clean texts.
    Rows with ``odd``: (key, field, odd), the suspicious words of a text.
    """
    kind = dict(frame.dtypes)[key]
    columns_ = ["gram", "n", "word", key, "field", "odd"]

    def rows(**given: Any) -> pd.DataFrame:
        size = len(next(iter(given.values())))
        values = {c: given.get("key_" if c == key else c, [None] * size) for c in columns_}
        return pd.DataFrame({c: pd.Series(v, dtype="Int64" if c in ("gram", "n") else object) for c, v in values.items()})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(ALPHABET**3, np.int64)
        for batch in batches:
            clean, ids, fields, odd = [], [], [], []
            tokens: Counter[str] = Counter()
            times: Counter[str] = Counter()
            for id_, field, text in zip(batch[key], batch["field"], batch["text"], strict=True):
                if words := odd_words(text):
                    ids.append(id_), fields.append(field), odd.append(words)
                if not SUSPECT.search(text):
                    clean.append(text)
            for i in range(0, len(clean), 256):
                joined = "\n".join(clean[i : i + 256])
                tokens.update(joined.split())
                c = codes(joined)
                total += np.bincount((c[:-2] * ALPHABET + c[1:-1]) * ALPHABET + c[2:], minlength=total.size)
            yield rows(key_=ids, field=fields, odd=odd)
            for token, n in tokens.items():
                for word in WITH_UMLAUT.findall(token):
                    times[word] += n
            yield rows(word=list(times), n=list(times.values()))
        at = np.flatnonzero(total)
        yield rows(gram=at, n=total[at])

    named = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("text")) for c in columns]))
    texts = frame.select(F.col(key), named.alias("_f")).select(key, "_f.field", "_f.text").where(F.length("text") > 0)
    return texts.mapInPandas(read, f"gram long, n long, word string, `{key}` {kind}, field string, odd array<string>")


def accented(word: str) -> str:
    """A word with one letter spelled as other languages do, chosen by the word itself."""
    pairs = [(i, b) for i, c in enumerate(word) for a, b in FOREIGN_LETTERS if a == c]
    if not pairs:
        return word
    i, b = pairs[xxhash.xxh64_intdigest(word) % len(pairs)]
    return word[:i] + b + word[i + 1 :]


def garbled(word: str) -> Iterator[tuple[str, str]]:
    """(chain, garbled word) for every chain that can write the word."""
    chains = [(f"utf-8>{e}", "utf-8", e, 1) for e in MULTI_BYTE] + [(f"utf-8>{e} twice", "utf-8", e, 2) for e in MULTI_BYTE] + [(f"{t}>{w}", t, w, 1) for t, w in SINGLE_BYTE]
    for chain, true, wrong, times in chains:
        out = word
        try:
            for _ in range(times):
                out = out.encode(true).decode(wrong)
        except UnicodeError:
            continue
        if out != word:
            yield chain, out


def fewest_mistakes(right: list[float], wrong: list[float], default: float) -> float:
    """The threshold that ``right`` exceed and ``wrong`` do not, with the fewest mistakes,
    each side weighing the same; the largest of equally good ones. The rule of
    ``thresholds`` for a few gains in memory."""
    if not right:
        return default
    values = np.unique([0.0, *right, *wrong])
    cuts = (values[1:] + values[:-1]) / 2 if len(values) > 1 else values
    lost = np.searchsorted(np.sort(right), cuts, "right") / len(right)
    kept = 1 - np.searchsorted(np.sort(wrong), cuts, "right") / max(1, len(wrong)) if wrong else np.zeros(len(cuts))
    cuts, cost = cuts[cuts > 0], (lost + kept)[cuts > 0]
    # The largest of what is as good, to a mistake in 500: nothing is changed for little.
    return float(cuts[cost <= cost.min() + 0.002][-1]) if len(cuts) else default


KINDS = "kind string, gain double, good long, bad long"


def tried(model: Model, words: dict[str, int]) -> pd.DataFrame:
    """(kind, gain, good, bad): what trials on clean ``words``, which occur so often, gain, and
    how many of them must pass the threshold of that kind (good) or must not (bad). Kinds are
    chain and fill."""
    undone, strange, spelled = [], [], []
    lower = [c for c in LOST if c.islower()]
    for word, n in words.items():
        back: dict[str, str | None] = {}
        for _, bad in garbled(word):
            # It must come back: the chain undone gives the word.
            if bad not in back:
                back[bad] = next((c for c, o in candidates(bad) if o == word), None)
            if chain := back[bad]:
                undone.append((chain, bad, word, n))
        if (other := accented(word)) != word:
            strange.append((other, list(candidates(other)), n))
        for hit in re.finditer("[äöüß]", word):
            spelled.append((hit.group(), [word[: hit.start()] + c + word[hit.end() :] for c in lower], n))
    texts = {t for _, *pair, _ in undone for t in pair} | {t for w, all_, _ in strange for t in (w, *(o for _, o in all_))} | {t for _, all_, _ in spelled for t in all_}
    score = model.scores(sorted(texts))
    rows = [("chain", score[word] - score[bad] + saved(c, bad, word), n, 0) for c, bad, word, n in undone]
    rows += [("chain", max((score[o] - score[w] + saved(c, w, o) for c, o in all_), default=0.0), 0, n) for w, all_, n in strange]
    for meant, all_, n in spelled:
        first, second = sorted(((score[t], c) for t, c in zip(all_, lower, strict=True)), reverse=True)[:2]
        rows.append(("fill", first[0] - second[0], n * (first[1] == meant), n * (first[1] != meant)))
    out = pd.DataFrame(rows, columns=["kind", "gain", "good", "bad"])
    # Sums of the same numbers in another order are the same gain.
    return out.assign(gain=out["gain"].astype(float).round(9)).groupby(["kind", "gain"], as_index=False).sum()


def thresholds(gains: DataFrame, kinds: list[str], spark: SparkSession) -> dict[str, float]:
    """Each of ``kinds`` to its threshold by the rule of ``fewest_mistakes``, over all
    ``gains`` (as KINDS). Kinds without good or without bad gains are left out.

    The running sums are made in bins by size of the gain, 64 to a factor of e, so the sums
    of whole bins that come to the driver are at most some thousands.
    """
    least = F.greatest(F.col("gain"), F.lit(0.0)).alias("gain")  # only thresholds above 0 count
    zero = spark.createDataFrame([(k, 0.0, 0, 0) for k in kinds], KINDS)
    counts = gains.select("kind", least, "good", "bad").unionByName(zero).groupBy("kind", "gain").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    counts = cut(counts.withColumn("bin", F.floor(F.log1p("gain") * 64)), spark)
    bins = counts.groupBy("kind", "bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("gain").alias("least")).toPandas().sort_values(["kind", "bin"])
    by = bins.groupby("kind")
    bins = bins.assign(goods=by["good"].transform("sum"), bads=by["bad"].transform("sum"), good_before=by["good"].cumsum() - bins["good"], bad_before=by["bad"].cumsum() - bins["bad"], after=by["least"].shift(-1))
    bins = bins[(bins["goods"] > 0) & (bins["bads"] > 0)]
    known = [(r.kind, int(r.bin), int(r.goods), int(r.bads), int(r.good_before), int(r.bad_before), None if pd.isna(r.after) else float(r.after)) for r in bins.itertuples()]
    whole = spark.createDataFrame(known, "kind string, bin long, goods long, bads long, good_before long, bad_before long, after double")
    order = Window.partitionBy("kind", "bin").orderBy("gain")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lost = (F.col("good_before") + F.sum("good").over(so_far)) / F.col("goods")
    kept = 1 - (F.col("bad_before") + F.sum("bad").over(so_far)) / F.col("bads")
    above = F.coalesce(F.lead("gain").over(order), F.col("after"))
    costs = counts.join(F.broadcast(whole), ["kind", "bin"]).select("kind", ((above + F.col("gain")) / 2).alias("at"), (lost + kept).alias("cost")).where("at > 0")
    best = {r.kind: r.cost for r in costs.groupBy("kind").agg(F.min("cost").alias("cost")).collect()}
    good = [(F.col("kind") == k) & (F.col("cost") <= c + 0.002) for k, c in best.items()]
    # The largest of what is as good, to a mistake in 500: nothing is changed for little.
    return {r.kind: r["at"] for r in costs.where(reduce(or_, good, F.lit(False))).groupBy("kind").agg(F.max("at").alias("at")).collect()}


def model_of(surveyed: DataFrame) -> Model:
    """The model of a ``survey``, its margins validated on all its words."""
    spark = surveyed.sparkSession
    rows = surveyed.where(F.col("gram").isNotNull()).groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(ALPHABET**3, np.int64)
    counts[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    model = Model.of(counts)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 1000):
                part = batch.iloc[i : i + 1000]
                yield tried(shared.value, dict(zip(part["word"].tolist(), part["n"].tolist(), strict=True)))

    # One task a core, since a word costs far more than its bytes suggest.
    words = surveyed.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")).repartition(spark.sparkContext.defaultParallelism)
    foreign = [("chain", max((model.gain(c, w, o) for c, o in candidates(w)), default=0.0), 0, 1) for w in FOREIGN]
    gains = words.mapInPandas(run, KINDS).unionByName(spark.createDataFrame(foreign, KINDS))
    limits = thresholds(gains, ["chain", "fill"], spark)
    model.margin, model.fill_margin = limits.get("chain", 4.0), limits.get("fill", 0.0)
    return model


def train(frame: DataFrame, columns: list[str]) -> Model:
    """The model of all clean values of ``columns``."""
    return model_of(survey(frame.withColumn("_k", F.lit(None).cast("string")), "_k", columns))


def restored(frame: DataFrame, columns: list[str], model: Model, spark: SparkSession) -> DataFrame:
    """Adds ``<column>_fixed`` and ``<column>_chain`` (null where nothing was garbled), in
    one pass for all ``columns``."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("fixed string, chain string")
    def run(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        return pd.DataFrame([m.fix(t) if t and odd_words(t) else (t, None) for t in texts], columns=["fixed", "chain"])

    out = frame
    for c in columns:
        out = out.withColumn(f"_{c}", run.asNondeterministic()(F.col(c).cast("string")))
    return out.select(*frame.columns, *[F.col(f"_{c}.{part}").alias(f"{c}_{part}") for c in columns for part in ("fixed", "chain")])


def found(surveyed: DataFrame, key: str, model: Model, spark: SparkSession) -> DataFrame:
    """Distinct (key, field) of the surveyed values with garbled words."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def judge(words: pd.Series) -> pd.Series:
        m = shared.value
        return words.map(lambda ws: any(m.restore(w)[1] for w in ws))

    odd = surveyed.where(F.col("odd").isNotNull()).select(key, "field", "odd").repartition(spark.sparkContext.defaultParallelism)
    return odd.where(judge(F.col("odd"))).select(key, "field").distinct()


def miscounted(frame: DataFrame, key: str, stored: str, texts: list[str], sign: str = "\ufffd") -> DataFrame:
    """Distinct keys whose stored number differs from the signs actually in the texts."""
    actual = sum((F.coalesce(F.length(t) - F.length(F.replace(F.col(t), F.lit(sign), F.lit(""))), F.lit(0)) for t in texts), F.lit(0))
    return frame.where(~F.col(stored).eqNullSafe(actual)).select(F.col(key)).distinct()
