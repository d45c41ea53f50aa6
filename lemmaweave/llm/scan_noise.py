"""Noise of scanned pages: broken words, running heads, page numbers, misread letters.

A frequency lexicon is counted over the whole corpus, in distinct texts. A symmetric-delete
index over all of it generates the candidates of misread words: words and lexicon are
folded so that the commonest confusable letters coincide (``rn``/``m``, ``e``/``c``, ...),
and each side gives the folded word and all its forms with one unit, a letter or a
confusable pair of letters, deleted; they meet on equal keys. A weighted edit distance, in
which a confusion pair costs little and a plain edit a lot, ranks the candidates; a word
counts as misread only if it differs by confusions alone, so typing errors (letters
swapped, dropped or doubled) stay out. Every accepted candidate is kept, and where a text
is repaired the bigram with the word before, counted over all texts, picks among them,
then cost, then frequency.

Letters and digits in one word (CO2, ISO9001, 2nd) are misread only if the index knows a
repair. Exit: a digit between two small letters is no word in print and needs no repair
to be noise.

The words of the head of the frequency list (each at least ``HEAD_SHARE`` of all words,
so at most 1 / HEAD_SHARE words) are broadcast; only words outside it are exchanged.

Defined results: null and empty texts hold no noise; repeated rows count once; texts are
read whole, in time linear in their length; an empty corpus gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaweave.operators.skew import heavy_values, join_by_value
from lemmaweave.sources import cut

HEAD_SHARE = 5e-6

# What printed letters are misread as, and words after a suspended hyphen.
CONFUSIONS = [
    ("e", "c"), ("l", "1"), ("h", "li"), ("g", "9"), ("d", "cl"), ("o", "0"), ("O", "0"), ("m", "rn"), ("rn", "m"), ("ü", "ii"),
    ("w", "vv"), ("ß", "B"), ("S", "5"), ("G", "6"), ("B", "8"), ("nn", "rm"), ("n", "ri"), ("u", "ii"), ("I", "l"), ("Z", "2"), ("i", "1"), ("W", "VV"), ("h", "1i"),
]
SUSPENDED = "und|oder|bzw|beziehungsweise|sowie|als|wie|noch|bis|aber|u"
HYPHEN = "(?:[-‐¬­]|Â¬|Â­|┬¼|â€\x90|ÔÇÉ|ΓÇÉ|‚Äê)"
_DASH = "(?:[-–—]|â€”|â€“|â\x80[\x93\x94]|ÔÇ[öô]|ΓÇ[öô]|‚Äî|‚Äì)"
NUMBER_LINE = rf"[ \t]*(?:{_DASH}[ \t]*\d{{1,4}}[ \t]*{_DASH}|\[[ \t]*\d{{1,4}}[ \t]*\]|S\.[ \t]?\d{{1,4}}|\d{{1,4}})[ \t]*"
_LETTER = r"[^\W\d_]"
#: A head is a headword: a capital or a compound with a slash, up to four words.
_TITLE = rf"(?!Seit\b)(?:(?=[^\W\d_a-zäöüß])|(?=\w+/[^\W\d_a-zäöüß])){_LETTER}[^\s.!?:;<>{{}}|=*#\[\]]*(?:,? [^\s.!?:;<>{{}}|=*#\[\]]+){{0,3}}"
HEAD_LINE = rf"[ \t]*(?:\d{{1,4}}[ \t]+(?:\|[ \t]*)?{_TITLE}|{_TITLE}[ \t]+(?:\|[ \t]*)?\d{{1,4}}|{_TITLE} [–—] {_TITLE})[ \t]*"
BREAK = re.compile(rf"{_LETTER}{HYPHEN}[ \t]*\n(?!\s*(?:{SUSPENDED})\b)|[a-zäöüß](?:[-‐¬]|Â¬|┬¼)[ \t]+(?!(?:{SUSPENDED})\b)[a-zäöüß]{{2,}}")
PAGE_LINE = re.compile(rf"(?:(?<=\n)|^)(?:{NUMBER_LINE}|{HEAD_LINE})(?=\n|$)")
#: A digit between small letters, in a word that is no part of a path or formula.
MIXED = re.compile(r"(?<![\w/=&#\\])[^\W\d_]*[a-zäöüß]\d{1,2}[a-zäöüß][^\W_]*(?!\w)")
MARKUP = re.compile(r"<[/a-zA-Z!][^<>]*>|\\[A-Za-z]+\*?|&\#?\w+;|\]\([^()\s]*\)|\$[^$\n]*\$|```.*?```", re.S)
#: Signs of garbled text; the words around them are another problem's.
GARBLED = re.compile(r"[^\t\n\r -~äöüÄÖÜß–—†↑›‹»«„“”’‚•·§…→∈∧∨∀∃⊢λ□≤≥¬×°À-žſ‐\xad]")
CHUNK = re.compile(rf"\S*{GARBLED.pattern}\S*")
WORD = re.compile(r"[^\W_]+")
#: Pieces of words at a hyphen or break; they attest no word.
PIECE = re.compile(r"([^\W_]+)[-‐¬\xad]|[-‐¬\xad]\s*([^\W_]+)")
#: Words that are judged: 4 to 40 letters and digits, two letters at least.
PLAIN = re.compile(r"(?=\d*[A-Za-zÄÖÜäöüß]\d*[A-Za-zÄÖÜäöüß])[0-9A-Za-zÄÖÜäöüß]{4,40}")


def layout_noise(text: str) -> bool:
    """Broken words, running heads or page numbers."""
    if "\n" in text and (PAGE_LINE.search(text) and "\n" in text.strip()):
        for hit in PAGE_LINE.finditer(text):
            if hit.group().strip() and len(hit.group().strip()) < len(text.strip()):
                return True
    return BREAK.search(text) is not None


def words(text: str) -> list[str]:
    """Words outside markup."""
    if "<" in text or "\\" in text or "&" in text or "$" in text or "`" in text or "](" in text:
        text = MARKUP.sub(" ", text)
    if not text.isascii() and GARBLED.search(text):
        text = CHUNK.sub(" ", text)
    return WORD.findall(text)


@lru_cache(100_000)
def skeleton(word: str) -> str:
    """Key in which words that differ by confusions only are equal."""
    s = word.replace("vv", "w").replace("VV", "W").replace("ii", "ü").replace("1", "l").replace("0", "o").replace("O", "o").replace("9", "g")
    s = s.replace("6", "G").replace("8", "B").replace("5", "S").replace("2", "Z").replace("ß", "B").replace("I", "l")
    s = s.replace("rn", "m").replace("rm", "nn")
    s = s.replace("cli", "ch").replace("di", "ch").replace("cl", "d").replace("li", "h")
    return s.replace("c", "e")


@lru_cache(100_000)
def skeletons(word: str) -> tuple[str, ...]:
    """The keys of a word in question: ``lii`` may be a ``hi`` or ``lü``, ``cl`` an ``el`` or ``d``."""
    return tuple(dict.fromkeys(map(skeleton, (word, word.replace("lii", "hi"), word.replace("cl", "el")))))


def _costs(a: str, b: str) -> float:
    """Weighted edit distance: a confusion pair costs 0.2, a plain edit 1."""
    inf = 9.0
    row = [[inf] * (len(b) + 1) for _ in range(len(a) + 1)]
    row[0][0] = 0.0
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            here = row[i][j]
            if here >= inf:
                continue
            if i < len(a) and j < len(b):
                step = 0.0 if a[i] == b[j] else 0.5 if b[j].isdigit() else 1.0
                row[i + 1][j + 1] = min(row[i + 1][j + 1], here + step)
            if i < len(a):
                row[i + 1][j] = min(row[i + 1][j], here + 1)
            if j < len(b):
                row[i][j + 1] = min(row[i][j + 1], here + 1)
            for x, y in CONFUSIONS:
                if a.startswith(x, i) and b.startswith(y, j):
                    row[i + len(x)][j + len(y)] = min(row[i + len(x)][j + len(y)], here + 0.2)
    return row[-1][-1]


SUFFIXES = ["es", "en", "er", "em", "s", "n", "e"]


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over a one-column frame of texts, n = distinct texts that hold the word
    whole, 0 if only as a piece; combined per partition before the exchange."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        for batch in batches:
            for text in batch.iloc[:, 0]:
                pieces = {w for hit in PIECE.findall(text) for w in hit}
                total.update({w: int(w not in pieces) for w in words(text)})
            if len(total) > 500_000:
                yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                total.clear()
        yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    return texts.distinct().mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


#: Letter pairs that are deleted as one unit, since one letter may be misread as them.
PAIRS = ("ri", "nn", "ch", "cl", "li", "ii", "di")


def _deletions(folded: str) -> set[str]:
    """A folded word with one unit deleted, marked so that it meets only such forms."""
    out = {"~" + folded[:i] + folded[i + 1 :] for i in range(len(folded))}
    out.update("~" + folded[:i] + folded[i + 2 :] for i in range(len(folded) - 1) if folded.startswith(PAIRS, i))
    return out


def _keys(batch: pd.Series) -> pd.Series:
    """Keys of words in question: folded, without an ending, and all deletions."""

    def keys(word: str) -> list[str]:
        out: set[str] = set()
        for key in skeletons(word):
            out |= {key, *_deletions(key)}
            out.update(key[: -len(s)] for s in SUFFIXES if key.endswith(s) and len(key) - len(s) > 3)
        return sorted(out)

    return batch.map(keys)


def _lexicon_keys(batch: pd.Series) -> pd.Series:
    """Keys of lexicon words: folded, and all deletions."""
    return batch.map(lambda w: sorted({key := skeleton(w), *_deletions(key)}))


_PAIRED = set(CONFUSIONS)


def _apart(a: str, b: str) -> tuple[str, str]:
    """What is left of two words without their common beginning and end."""
    n, least = 0, min(len(a), len(b))
    while n < least and a[n] == b[n]:
        n += 1
    m = 0
    while m < least - n and a[-1 - m] == b[-1 - m]:
        m += 1
    return a[n : len(a) - m], b[n : len(b) - m]


def _cost(form: str, word: str) -> float:
    """``_costs``, or 9 at once for what is no confusion at sight (the most candidates)."""
    a, b = _apart(form, word)
    if (a, b) in _PAIRED:
        return 0.2
    if len(b) == 1 and b.isdigit() and len(a) == 1:
        return 0.5
    x, y = skeleton(form), skeleton(word)
    if x not in skeletons(word):
        u, v = _apart(x, y)
        if (u, v) not in _PAIRED and not (v.isdigit() and len(v) == 1 and len(u) <= 2) and not (u and v and len(u) + len(v) <= 5 and len(a) == len(b) and any(c.isdigit() for c in b)):
            return 9.0
    return _costs(form, word)


def _judge(words_: pd.Series, candidates: pd.Series) -> pd.DataFrame:
    """Cost of a word against the nearest form of a candidate, and that form; known:
    plainly a form of it."""
    out = []
    for word, base in zip(words_, candidates, strict=True):
        forms = (base, *(base + s for s in SUFFIXES))
        if word in forms:
            out.append((0.0, True, word))
            continue
        cost, form = min((_cost(f, word), f) for f in forms if abs(len(f) - len(word)) <= 4) if abs(len(base) - len(word)) <= 4 else (9.0, base)
        out.append((cost, False, form))
    return pd.DataFrame(out, columns=["cost", "known", "form"])


def misreadings(counts: DataFrame, names: DataFrame, ratio: int = 3) -> DataFrame:
    """(word, repair, cost, n_repair): words that are misread forms of lexicon words, with
    every accepted repair.

    ``counts``: in how many distinct texts a word stands, so that repeated rows have no
    weight. ``names``: (word) known to be right whatever their frequency. Any other word
    without digits outranks a form that is in ``ratio`` times fewer texts; a known name
    outranks any unknown form. Words of 4 to 40 letters and digits are judged.
    """
    keys, lexicon_keys = F.pandas_udf("array<string>")(_keys), F.pandas_udf("array<string>")(_lexicon_keys)  # type: ignore[call-overload]
    judge = F.pandas_udf("cost double, known boolean, form string")(_judge).asNondeterministic()  # type: ignore[call-overload]
    cores = counts.sparkSession.sparkContext.defaultParallelism
    known = names.select("word", F.lit(True).alias("named")).distinct()
    all_ = counts.join(known, "word", "full").select("word", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("named", F.lit(False)).alias("named"))
    all_ = all_.where(F.col("word").rlike("^[0-9A-Za-zÄÖÜäöüß]{4,40}$") & F.col("word").rlike("[A-Za-zÄÖÜäöüß][0-9]*[A-Za-zÄÖÜäöüß]"))
    # Few bytes but much work in Python: as many tasks as cores, whatever the size.
    all_ = cut(all_.repartition(cores), counts.sparkSession)
    digits = F.col("word").rlike("[0-9]")
    # What is misread stands in one text at least, so rarer words pass no comparison.
    lexicon = all_.where(~digits & (F.col("named") | (F.col("n") >= ratio)))
    coded = lambda f, w: F.explode(F.transform(f(F.col(w)), lambda k: F.xxhash64(k))).alias("key")
    indexed = lexicon.select(coded(lexicon_keys, "word"), F.col("word").alias("repair"), F.col("n").alias("n_repair"), F.col("named").alias("named_repair"))
    unknown = all_.where(~F.col("named")).select(coded(keys, "word"), "word", "n")
    pairs = (
        unknown.join(indexed, "key")
        .where((F.col("word") != F.col("repair")) & (F.col("named_repair") | (F.col("n_repair") >= F.col("n") * ratio)) & (F.abs(F.length("word") - F.length("repair")) <= 4))
        .select("word", "repair", "n_repair")
        .distinct()
        .repartition(cores, "word", "repair")
        .withColumn("j", judge(F.col("word"), F.col("repair")))
    )
    allowed = F.greatest(0.2 * F.floor(F.length("word") / 3), F.when(F.col("word").rlike("[0-9]"), 0.5).otherwise(0.0))
    confused = F.col("j.cost") <= allowed + 0.01
    close = F.when(F.col("j.known"), 0.0).when((F.col("j.cost") < 1.0) & confused, F.col("j.cost"))
    judged = pairs.withColumn("c", close).where(F.col("c").isNotNull()).select("word", F.col("repair").alias("base"), F.col("j.form").alias("repair"), "c", "n_repair")
    judged = cut(judged, counts.sparkSession)
    # A form of a word that is misread itself is not known by it.
    misread = judged.groupBy("word").agg(F.min("c").alias("least")).where(F.col("least") > 0).select(F.col("word").alias("base"))
    forms = judged.where(F.col("c") == 0).join(misread, "base", "left_anti").select("word").distinct()
    return judged.where(F.col("c") > 0).join(forms, "word", "left_anti").groupBy("word", "repair").agg(F.min("c").alias("cost"), F.max("n_repair").alias("n_repair"))


def usual_words(counts: DataFrame, noise: DataFrame, spark: SparkSession):  # noqa: ANN201
    """The head of the word list without misread words, broadcast: at most 1 / HEAD_SHARE
    words. A word of letters and digits is never usual, whatever its frequency."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    head = counts.where(F.col("n") >= max(2.0, total * HEAD_SHARE)).where(~F.col("word").rlike(r"[0-9]") | F.col("word").rlike("^[0-9]+$")).join(noise.select("word"), "word", "left_anti").select("word")
    return spark.sparkContext.broadcast(frozenset(r.word for r in head.collect()))


def text_cases(frame: DataFrame, key: str, text: str, counts: DataFrame, noise: DataFrame, spark: SparkSession) -> DataFrame:
    """Distinct keys of the texts with noise."""
    shared = usual_words(counts, noise, spark)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        usual = shared.value
        for batch in batches:
            ids, rare = [], []
            for id_, t in zip(batch["id"], batch["text"], strict=True):
                if layout_noise(t):
                    ids.append(id_), rare.append(None)
                    continue
                other = set(words(t)) - usual
                if any(c.isdigit() for w in other for c in w) and MIXED.search(MARKUP.sub(" ", t)):
                    ids.append(id_), rare.append(None)
                    continue
                for w in other:
                    if PLAIN.fullmatch(w):
                        ids.append(id_), rare.append(w)
            yield pd.DataFrame({"id": ids, "word": rare}, dtype=object)

    rows = frame.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).where(F.length("text") > 0)
    seen = cut(rows.mapInPandas(read, "id string, word string"), spark)  # the texts are read once
    odd = seen.where(F.col("word").isNotNull())
    counted = odd.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
    # Copies of one text may make a misread word hot.
    misread = join_by_value(odd, noise.select("word").distinct(), "word", heavy_values(counted, "word", "_n")).select("id")
    return seen.where(F.col("word").isNull()).select("id").unionByName(misread).distinct()


def value_noise(value: Column, context: Column) -> Column:
    """Short values: cut at a line end, or with a digit between small letters of a word.

    ``context`` is the value as it stands in the sentence; a hyphen before "und" and the
    like is a suspended one, a bare hyphen without context decides nothing.
    """
    cut_ = value.rlike(r"(?s)\p{L}(?:¬\s*|[-‐\x{AD}][ \t]*\n\s*)$")
    suspended = context.rlike(r"(?s)^[^\s]*[-‐]\s+(?:" + SUSPENDED + r")\b")
    hyphen = value.rlike(r"\p{L}[-‐]$") & context.rlike(r"(?s)^[^\s]*[-‐]\s+\p{L}") & ~suspended
    inside = value.rlike(r"\p{Ll}[-‐¬\x{AD}]\s+(?!(?:" + SUSPENDED + r")\b)\p{Ll}{2,}")
    mixed = value.rlike(r"(?U)(?<!\w)\p{L}*\p{Ll}\d{1,2}\p{Ll}[\p{L}\d]*(?!\w)")
    return F.coalesce(cut_ | hyphen | inside | mixed, cut_ | inside | mixed)


def value_cases(rows: DataFrame, value: str, context: str, noise: DataFrame) -> DataFrame:
    """Rows whose short value holds noise; heavy values are judged once and broadcast."""
    counted = rows.where(F.length(value) > 0).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    token = F.explode(F.regexp_extract_all(F.col(value), F.lit(r"([\p{L}\d]+)"), F.lit(1)))
    misread = counted.select(value, token.alias("word")).join(noise.select("word").distinct(), "word", "left_semi").select(value).distinct()
    direct = rows.where(value_noise(F.col(value), F.col(context)))
    return direct.unionByName(join_by_value(rows, misread, value, heavy_values(counted, value, "_n")))


# --- repair ---------------------------------------------------------------------------


PAGE = re.compile(rf"(?:{NUMBER_LINE}|{HEAD_LINE})$")
NUMBER = re.compile(rf"{NUMBER_LINE}$")
BROKEN = re.compile(rf"({_LETTER}){HYPHEN}$")
SUSPENDED_NEXT = re.compile(rf"(?:{SUSPENDED})\b")
INSIDE = re.compile(rf"([a-zäöüß])[-‐¬][ \t]+(?!(?:{SUSPENDED})\b)(?=[a-zäöüß]{{2,}})")
LIST = re.compile(r"[-*#|=+]|\d+\.")


def continuous(text: str, repairs: dict[str, str] | None = None) -> str:
    """Readable paragraphs: page lines dropped, breaks healed, lines joined, words repaired.

    ``repairs``: by a word, or by the word before it, a blank and the word, which goes first.
    """
    lines = text.split("\n")
    # (line, what stood before it: nothing, a page change, an empty line)
    kept: list[tuple[str, str]] = []
    gap = ""
    for i, line in enumerate(lines):
        bare = line.strip()
        if bare and PAGE.match(line) and len(lines) > 1:
            # A title line right above a page number is a running head as well.
            if kept and not gap and NUMBER.match(line) and len(kept[-1][0].split()) <= 3 and not re.search(r"[.!?:;,\-‐¬]$|^[a-zäöüß]", kept[-1][0]) and i > 1:
                gap = kept.pop()[1]
            gap = "page"
        elif not bare:
            gap = gap or "empty"
        else:
            kept.append((line.rstrip() if kept else bare, gap))
            gap = ""
    out: list[str] = []
    for line, before_ in kept:
        lead = line.lstrip()
        if not out:
            out.append(line)
        elif BROKEN.search(out[-1]) and lead[:1].islower() and not SUSPENDED_NEXT.match(lead):
            out[-1] = BROKEN.sub(r"\1", out[-1])
            out.append(lead)
        elif before_ == "empty" or before_ == "page" and out[-1][-1:] in ".!?:":
            out += ["\n\n", line]
        else:
            out += ["\n" if LIST.match(lead) else " ", line if LIST.match(lead) else lead]
    joined = INSIDE.sub(r"\1", "".join(out))
    if repairs:
        before = ""

        def mend(m: re.Match[str]) -> str:
            nonlocal before
            pair, before = f"{before} {m.group()}", m.group()
            return repairs.get(pair) or repairs.get(m.group(), m.group())

        joined = WORD.sub(mend, joined)
    return joined.strip()


def repairs(frame: DataFrame, key: str, text: str, counts: DataFrame, noise: DataFrame, spark: SparkSession) -> DataFrame:
    """(id, before, word, repair, cost, n_repair, n_bigram): what may replace each word.

    ``noise`` has every accepted repair of a word.

    Only words outside the head of the word list leave the texts one by one; bigrams are
    counted per partition before they are exchanged. ``n_bigram`` is how often, over all
    texts, the repair follows the word that stands before the misread one in the joined text.
    """
    shared = usual_words(counts, noise, spark)

    def rare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        usual = shared.value
        for batch in batches:
            out = [(i, a, b) for i, t in zip(batch["id"], batch["text"], strict=True) for w in [words(continuous(t))] for a, b in zip(["", *w], w, strict=False) if b not in usual and len(b) >= 4]
            yield pd.DataFrame(out, columns=["id", "before", "word"])

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for t in batch["text"]:
                w = words(t)
                total.update((a, b) for a, b in zip(["", *w], w, strict=False) if len(b) >= 3)
            if len(total) > 500_000:
                yield pd.DataFrame([(a, b, n) for (a, b), n in total.items()], columns=["before", "repair", "n"])
                total.clear()
        yield pd.DataFrame([(a, b, n) for (a, b), n in total.items()], columns=["before", "repair", "n"])

    rows = frame.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).where(F.length("text") > 0).distinct()
    hits = rows.mapInPandas(rare, "id string, before string, word string").join(noise, "word").distinct()
    wanted = hits.select("before", "repair").distinct()
    counted = rows.mapInPandas(pairs, "before string, repair string, n long").groupBy("before", "repair").agg(F.sum("n").alias("n_bigram"))
    return hits.join(counted.join(wanted, ["before", "repair"], "left_semi"), ["before", "repair"], "left").select("id", "before", "word", "repair", "cost", "n_repair", F.coalesce("n_bigram", F.lit(0)).alias("n_bigram"))


def choices(fixes: DataFrame) -> DataFrame:
    """(id, fixes): map for ``continuous`` from ``repairs``; per occurrence the repair with
    most bigrams, then least cost, then most texts; by the word alone over all of a text."""
    best = lambda: F.max_by("repair", F.struct("n_bigram", -F.col("cost"), "n_repair", "repair")).alias("repair")
    each = fixes.groupBy("id", F.concat_ws(" ", "before", "word").alias("key")).agg(best())
    any_ = fixes.groupBy("id", F.col("word").alias("key"), "repair").agg(F.sum("n_bigram").alias("n_bigram"), F.min("cost").alias("cost"), F.max("n_repair").alias("n_repair")).groupBy("id", "key").agg(best())
    return each.unionByName(any_).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("key", "repair"))).alias("fixes"))
