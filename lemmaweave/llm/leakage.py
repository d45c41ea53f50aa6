"""Held-out passages inside a corpus, by a distributed positional inverted index.

Index terms are runs of ``WIDTH`` normalised words. The postings (term, document,
position) of all corpus terms that occur in some test passage are built in one pass and
stored; how many documents hold a term is its rarity. For each passage the lists of its
rarest terms are intersected first: of any ``SEEDS`` neighbouring terms the rarest is a
seed, so every undisturbed run of that many terms holds one, and only (document, passage)
pairs that meet on a seed go on. For these all postings are offset-adjusted (document
position minus passage position); equal offsets in sequence are exact phrases, and from
each phrase the single words before and after it are aligned with replaced, added and
left out words, as far as the edits allow.

Why no leak is lost: 20 words with at most one edit in ten hold a run of six undisturbed
words, hence three neighbouring terms, hence a seed; the alignment from this run reaches
every match that holds it, however short the stretches between its edits are.

Normalised words have no case, punctuation, line-end hyphens, footnote marks or
difference of umlaut spelling. Lines that several passages share, counted over all of
them, are instructions and no part of a passage, unless too few words would be left; then
the shared lines that are long enough for a match and shared by the fewest stay. Items with the same text are matched
once.

The passages are a stated query set: they are taken in blocks of at most about ``BLOCK``
passages and ``CHARS`` characters, whose words are what is broadcast, so its size does not
grow with either table. Which block a passage is in has no influence on the result. Terms
are numbered by their words; should two numbers coincide in a huge vocabulary, the
alignment of the words themselves refuses the match.

Defined results: null or empty texts and passages match nothing; passages shorter than
``least`` words match nothing; repeated documents are each reported; repeated rows count
once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaweave.operators.skew import heavy_values, join_by_value, sized
from lemmaweave.sources import cut

WIDTH, SEEDS, LEAST, RATE, BLOCK, CHARS = 4, 3, 20, 0.1, 2000, 8_000_000
WORD = re.compile(r"[^\W_]+")
_HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐¬\xad][ \t]*\n\s*(?=[a-zäöüß])")
_MARK = re.compile(r"\[\d{1,3}\]|\(\d{1,2}\)(?=[\s.,;])|[¹²³⁰-⁹]+|\^\d+|<sup>.*?</sup>")
_INVISIBLE = re.compile("[\xad​-‏⁠﻿]")
_FOLD = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"}


def normal(word: str) -> str:
    """One word without case and umlaut spelling."""
    word = word.lower()
    return "".join(_FOLD.get(c, c) for c in word) if not word.isascii() else word


def raw_words(text: str) -> list[str]:
    """Words of a text, breaks healed and marks dropped, not yet normalised."""
    if "-\n" in text or "‐\n" in text or "¬\n" in text or "\xad" in text or "- \n" in text:
        text = _HYPHEN.sub("", text)
    if "[" in text or "(" in text or "^" in text or "<" in text or not text.isascii():
        text = _MARK.sub(" ", text) if "<" in text or "[" in text or "^" in text else re.sub(r"\(\d{1,2}\)(?=[\s.,;])|[¹²³⁰-⁹]+", "", text)
        if _INVISIBLE.search(text):
            text = _INVISIBLE.sub("", text)
    return WORD.findall(text)


def passages(items: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((rep, text) of the passages without instructions, (rep, item_id) of their items)."""
    rows = items.where(F.length("text") > 0).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    texts = rows.groupBy("text").agg(F.min("item_id").alias("rep"))
    numbered = cut(texts, items.sparkSession)
    lines = numbered.select("rep", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("line", F.trim("line")).where("line <> ''")
    lines = cut(lines, items.sparkSession)
    counts = lines.select("rep", "line").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    shared = counts.where("n > 1")
    # An instruction may stand in a third of all items.
    marked = join_by_value(lines, shared, "line", heavy_values(counts, "line", "n"), "left")
    whole = marked.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("pos", "line", F.col("n").isNotNull().alias("shared"), "n"))).alias("s"))
    n_words = lambda line: F.size(F.split(line, r"\s+"))
    own = F.filter("s", lambda x: ~x["shared"])
    held = F.aggregate(own, F.lit(0), lambda n, x: n + n_words(x["line"]))
    rarest = F.array_min(F.transform(F.filter("s", lambda x: x["shared"] & (n_words(x["line"]) >= least)), lambda x: x["n"]))
    kept = F.when((F.size("s") == 1) | (F.size(own) == F.size("s")), F.col("s")).when(held >= least, own).otherwise(F.filter("s", lambda x: ~x["shared"] | (n_words(x["line"]) >= least) & (x["n"] == rarest)))
    own_text = whole.select("rep", F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("text"))
    return own_text, rows.join(numbered, "text").select("rep", "item_id")


class Terms:
    """The words and terms of a block of passages; terms are numbered."""

    def __init__(self, texts: dict[int, list[str]]) -> None:
        self.ids = {w: i + 1 for i, w in enumerate(sorted({w for t in texts.values() for w in t}))}
        self.base = len(self.ids) + 1
        at: list[tuple[int, int, int]] = []
        for item, words in texts.items():
            c = self.codes(np.array([self.ids[w] for w in words], np.uint64))
            at += [(item, i, int(x)) for i, x in enumerate(c)]
        self.keys = np.unique(np.array([x for *_, x in at], np.uint64))
        self.words = {item: [self.ids[w] for w in words] for item, words in texts.items()}
        self.postings = [(item, i, int(np.searchsorted(self.keys, np.uint64(x)))) for item, i, x in at]

    def codes(self, words: np.ndarray) -> np.ndarray:
        """A number for each run of WIDTH words (wraps for huge vocabularies)."""
        n = len(words) - WIDTH + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for k in range(WIDTH):
            out = out * np.uint64(self.base) + words[k : k + n]
        return out


def postings(documents: DataFrame, terms: Terms, spark: SparkSession, key: str, text: str) -> DataFrame:
    """(term, key, pos) of every place where a corpus text holds a term of the block.

    A text with a run of ``SEEDS`` such places, which alone can hold a match, also gives
    one row without a term: the numbers of its ``words``, for the alignment.
    """
    shared = spark.sparkContext.broadcast((terms.ids, terms.keys, terms))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, keys, t = shared.value
        known: dict[str, int] = {}
        for batch in batches:
            doc, pos, term, whole = [], [], [], []
            for d, body in zip(batch[key], batch[text], strict=True):
                words = raw_words(body)
                row = []
                for w in words:
                    i = known.get(w)
                    if i is None:
                        if len(known) > 200_000:
                            known.clear()
                        i = known[w] = ids.get(normal(w), 0)
                    row.append(i)
                numbers = np.array(row, np.uint64)
                codes = t.codes(numbers)
                if not len(codes):
                    continue
                at = np.searchsorted(keys, codes)
                at[at == len(keys)] = 0
                hit = np.flatnonzero(keys[at] == codes)
                if len(hit):
                    doc.append(np.full(len(hit), d))
                    pos.append(hit)
                    term.append(at[hit])
                    if len(hit) >= SEEDS and (hit[SEEDS - 1 :] - hit[: 1 - SEEDS] == SEEDS - 1).any():
                        whole.append((None, d, None, row))
            if doc:
                yield pd.DataFrame({"term": np.concatenate(term), key: np.concatenate(doc), "pos": np.concatenate(pos), "words": None})
            if whole:
                yield pd.DataFrame(whole, columns=["term", key, "pos", "words"]).astype({"term": "Int32", "pos": "Int32"})

    kind = dict(documents.dtypes)[key]
    rows = documents.select(key, text).where(F.length(text) > 0)
    return rows.mapInPandas(read, f"term int, `{key}` {kind}, pos int, words array<int>")


def reaches(doc: np.ndarray, passage: np.ndarray, d: int, p: int, most: int) -> list[tuple[int, int, int]]:
    """(edits, passage words, document words) that run on from (d, p), for each number of
    edits up to ``most`` the farthest reach that ends with a common word.

    Diagonals are followed to their farthest point for each number of edits, so every
    alignment of single words counts, whatever lies between two edits.
    """
    n, m = len(passage), len(doc)

    def slide(k: int, at: int) -> int:
        while at < n and at + k < m and passage[at] == doc[at + k]:
            at += 1
        return at

    last = {d - p: slide(d - p, p)}
    out = [(0, last[d - p] - p, last[d - p] - p)]
    for e in range(1, most + 1):
        if out[-1][1] == n - p:
            break
        now: dict[int, int] = {}
        best = (0, 0)
        for k in range(d - p - e, d - p + e + 1):
            # replaced; left out of the document; added to it
            at = max(last.get(k, -1) + 1 if k in last else -1, last.get(k + 1, -2) + 1 if k + 1 in last else -1, last.get(k - 1, -1))
            if at < p or at > n or at + k > m:
                continue
            now[k] = end = slide(k, at)
            if end > at:
                best = max(best, (end - p, end + k - d))
        last = now
        if best[0] > out[-1][1]:
            out.append((e, *best))
    return out


def aligned(doc: list[int], passage: list[int], hits: list[tuple[int, int]], least: int = LEAST, rate: float = RATE) -> tuple[int, int, int, int, int] | None:
    """The longest match of a document and a passage (word numbers), or None.

    Returns (first document word, document words, first passage word, passage words,
    edits). ``hits`` are the places (document, passage) of common terms; from each run of
    them single words are aligned to both sides. A match begins and ends with a common
    word, so a word replaced beyond its ends is no part of it.
    """
    runs: list[tuple[int, int]] = []
    for offset, p in sorted({(d - p, p) for d, p in hits}):
        if not runs or last != (offset, p - 1):
            runs.append((p + offset, p))
        last = (offset, p)
    most = int(len(passage) / (1 / rate - 1)) + 1
    back, forth = (doc[::-1], passage[::-1]), (doc, passage)
    best: tuple[int, int, int, int, int] | None = None
    for d, p in runs:
        if best and best[4] == 0 and best[2] <= p < best[2] + best[3] and d - p == best[0] - best[2]:
            continue  # inside the match
        right = reaches(*forth, d, p, most)
        left = reaches(*back, len(doc) - d, len(passage) - p, most)
        for e0, p0, d0 in left:
            for e1, p1, d1 in right:
                span, words, edits = p0 + p1, max(p0 + p1, d0 + d1), e0 + e1
                if span >= least and edits <= rate * words and (best is None or (span, -edits) > (best[3], -best[4])):
                    best = (d - d0, d0 + d1, p - p0, span, edits)
    return best


def _match(documents: DataFrame, terms: Terms, spark: SparkSession, key: str, text: str, least: int) -> DataFrame:
    if not terms.postings:
        return documents.select(key, F.lit(0).cast("long").alias("item_id"), *[F.lit(0).alias(c) for c in ("start", "words", "edits")]).limit(0)
    stored = cut(postings(documents, terms, spark, key, text), spark)  # the stored index
    index, bodies = stored.where(F.col("term").isNotNull()).select("term", key, "pos"), stored.where(F.col("term").isNull()).select(key, F.col("words").alias("body")).distinct()
    passage_words = spark.sparkContext.broadcast(terms.words)
    item_terms = spark.createDataFrame(pd.DataFrame(terms.postings, columns=["item_id", "at", "term"]).astype({"item_id": "int64", "at": "int32", "term": "int32"}))
    # Rarity: a term is counted in documents, combined map-side; terms are bounded by the block.
    rarity = {r["term"]: r["n"] for r in index.groupBy("term").agg(F.approx_count_distinct(key).alias("n")).collect()}
    by_item: dict[int, list[tuple[int, int]]] = {}
    for item, at, term in terms.postings:
        by_item.setdefault(item, []).append((at, term))
    seeds = set()
    for item, list_ in by_item.items():
        list_.sort()
        for i in range(len(list_) - SEEDS + 1):
            at, term = min(list_[i : i + SEEDS], key=lambda x: (rarity.get(x[1], 0), x[1], x[0]))
            seeds.add((item, at, term))
    # A passage with fewer terms than SEEDS is below the least length of a match anyway.
    if not seeds:
        seeds = {(item, at, term) for item, at, term in terms.postings}
    seed_terms = spark.createDataFrame(pd.DataFrame(sorted(seeds), columns=["item_id", "at", "term"]).astype({"item_id": "int64", "at": "int32", "term": "int32"}))
    met = index.join(sized(seed_terms, 2_000_000), "term").select(key, "item_id").distinct()
    lists = index.join(sized(item_terms, 2_000_000), "term").groupBy(key, "item_id").agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.struct(F.col("pos").alias("d"), F.col("at").alias("p"))).alias("hits"))
    # 20 words with two edits leave at least 20 - 3 (WIDTH - 1) - 2 terms.
    fewest = max(1, int(least - 3 * (WIDTH - 1) - 2 - least * RATE + 1))
    lists = lists.where(F.col("n") >= fewest).join(met, [key, "item_id"], "left_semi")

    @F.pandas_udf("start int, words int, edits int")
    def align(all_hits: pd.Series, bodies_: pd.Series, item_ids: pd.Series) -> pd.DataFrame:
        out = []
        for hits, body, item in zip(all_hits, bodies_, item_ids, strict=True):
            best = aligned([int(x) for x in body], passage_words.value[item], [(h["d"], h["p"]) for h in hits], least)
            out.append((best[0], best[3], best[4]) if best else (None, None, None))
        return pd.DataFrame(out, columns=["start", "words", "edits"]).astype("Int32")

    judged = lists.join(bodies, key).withColumn("m", align.asNondeterministic()(F.col("hits"), F.col("body"), F.col("item_id")))
    return judged.select(key, "item_id", "m.*").where(F.col("words").isNotNull())


def leaks(documents: DataFrame, items: DataFrame, spark: SparkSession, key: str = "doc_id", text: str = "text", least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """(key, item_id, start, words, edits): documents that hold at least ``least`` words
    of an item's passage, where the match starts, how long it is and its edits."""
    own, members = passages(items, least)
    own = cut(own, spark)
    size = own.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(1, -(-size.n // block), -(-size.chars // CHARS))
    parts = []
    for i in range(blocks):
        rows = own.where(F.pmod(F.xxhash64("rep"), F.lit(blocks)) == i).collect()
        words = {r.rep: [normal(w) for w in raw_words(r.text)] for r in rows}
        parts.append(_match(documents, Terms(words), spark, key, text, least))
    found = reduce(DataFrame.unionByName, parts).withColumnRenamed("item_id", "rep")
    return found.join(sized(cut(members, spark)), "rep").select(key, "item_id", "start", "words", "edits")
