"""Several values packed in one field: split into one row per value, position kept.

A small parsing expression grammar with ordered alternatives::

    Field     <- Blank Slot (Separator Slot)* Separator? End
    Slot      <- Mark? (Quoted / Bracketed / Bare / Loose)
    Quoted    <- '"' ('""' / [^"])* '"' &Stop        (body must be a whole value)
    Bracketed <- '„' [^“]* '“' &Stop / '»' [^«]* '«' &Stop / ...
    Bare      <- (!(Tail Stop) .)* Tail &Stop
    Loose     <- (!Strong .)+
    Stop      <- Blank End / Separator Slot-start / Blank Mark

``Tail`` is what closes a value (for bibliographies: the year or "o. J." and the like, with
pages, reprint or translation), so delimiters inside titles, author lists and parentheses do not split.
When an alternative fails the parser backtracks to the next one: a quote that never
closes is read as bare text and flagged ``open_quote``; a value without a tail is read
up to the next strong delimiter and flagged ``no_tail``.

Defined results for odd input: null and blank fields give no values; empty slots are
skipped and take no position; repeated values are all kept (positions differ); texts of
any length are read whole in one left-to-right pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "array<struct<pos:int,item:string,error:string>>"

# What closes a bibliographic item, and how items are marked and joined.
BIB_TAIL = (
    r"(?:\b[12][0-9]{3}\b(?:/[0-9]{1,4}\b)?|(?<!\w)(?:o\.\s?[JD]\.|s\.\s?[ad]\.|n\.\s?d\.|ohne Jahr\b))"
    r"(?:,\s*(?:S\.\s*)?[0-9]{1,4}(?:\s*[–—-]\s*[0-9]{1,4})?)?"
    r"(?:\s*\((?=[^()\n]*[0-9]{4})[A-Za-z][^()\n]*\))*"
    r"(?:\}+|\]+|_+|\*+|'+|</[a-z0-9]+>)*"
)
MARK = r"(?:\[[0-9]{1,3}\]|\(?[0-9]{1,3}\)|[0-9]{1,3}\.|\(?[a-z]\)|[-–•*·])[ \t]+"
#: A piece without a tail that is proven to be a heading or leftover: no comma parts it, or it breaks off inside markup.
LEFTOVER = r"^[^,]*$|(?:<[^<>]*|&#?\w*|\\[A-Za-z]*)$"
SEPARATOR = r"[ \t]*(?:;|//?|\||[•·]|[—–](?=[ \t])|\n|\t)[ \t]*"
STRONG = r"[ \t]*(?:;|//|\||[•·]|\n|\t)[ \t]*"
PAIRS = {'"': '"', "„": "“", "»": "«", "«": "»", "“": "”", "›": "‹", "‚": "‘"}


@dataclass(frozen=True)
class Grammar:
    """``tail``: pattern that closes a value, or None where any delimiter does."""

    tail: str | None = BIB_TAIL
    mark: str = MARK
    separator: str = SEPARATOR
    strong: str = STRONG
    pairs: dict[str, str] = field(default_factory=lambda: dict(PAIRS))


class Parser:
    """Recursive-descent reader of one grammar; ``values`` reads one field."""

    def __init__(self, grammar: Grammar) -> None:
        self.g = grammar
        self.blank = re.compile(r"\s*")
        self.mark = re.compile(grammar.mark)
        self.separators = re.compile(rf"(?:\s*(?:{grammar.separator}))+\s*")
        self.strong = re.compile(grammar.strong)
        self.tail = re.compile(grammar.tail) if grammar.tail else None
        self.whole = re.compile(rf"(?:{grammar.tail})[“”«»‹‘'\"]*\s*\Z") if grammar.tail else None

    def stop(self, text: str, at: int, quoted: bool) -> bool:
        """May a value end at ``at``?"""
        end = self.blank.match(text, at).end()
        if end == len(text):
            return True
        if self.separators.match(text, at):
            return True
        if end > at and self.mark.match(text, end):
            return True
        comma = re.compile(r"\s*,\s*").match(text, at)
        return bool(quoted and comma and (comma.end() == len(text) or text[comma.end()] in self.g.pairs))

    def enclosed(self, text: str, at: int) -> tuple[str, int] | None:
        """Quoted / Bracketed: the body and where it ends, if it holds a whole value."""
        close = self.g.pairs.get(text[at])
        if close is None:
            return None
        i = at + 1
        while (i := text.find(close, i)) >= 0:
            if close == '"' and text.startswith('""', i):
                # A doubled quote is text, unless the field closes right after it.
                i += 2
                continue
            body = text[at + 1 : i]
            if (self.whole is None or self.whole.search(body)) and self.stop(text, i + 1, True):
                return (body.replace('""', '"') if close == '"' else body), i + 1
            if close != '"' and self.whole is not None and not self.whole.search(body):
                return None  # the quotes enclose a title only
            i += 1
        return None

    def bare(self, text: str, at: int) -> int | None:
        """Bare: the nearest tail at which a value may stop."""
        if self.tail is None:
            hit = re.compile(rf"{self.g.separator}|\s*,\s*").search(text, at)
            return hit.start() if hit else len(text)
        for hit in self.tail.finditer(text, at):
            end = hit.end()
            while end < len(text) and text[end] in "“”«»‹‘":
                end += 1
            if self.stop(text, end, False):
                return end
        return None

    def values(self, text: str | None) -> Iterator[tuple[str, str | None]]:
        """(item, error) in order."""
        if not text:
            return
        at = self.blank.match(text).end()
        while at < len(text):
            skipped = self.separators.match(text, at)
            if skipped and skipped.end() > at:
                at = skipped.end()
                continue
            if text[at] == "," or text[at].isspace():
                at += 1
                continue
            marked = self.mark.match(text, at)
            start = marked.end() if marked else at
            if start >= len(text):
                return
            error = None
            if whole := self.enclosed(text, start):
                item, at = whole
            else:
                if text[start] == '"' and text.count('"', start) % 2:
                    error = "open_quote"
                end = self.bare(text, start)
                if end is None:
                    loose = self.strong.search(text, start + 1)
                    end, error = (loose.start() if loose else len(text)), error or "no_tail"
                item, at = text[start:end], end
            if item := item.strip():
                yield item, error


def split_field(column: Column, grammar: Grammar = Grammar()) -> Column:
    """``column`` as an array of (pos from 1, item, error)."""

    @F.pandas_udf(SCHEMA)
    def split(texts: pd.Series) -> pd.Series:
        parser = Parser(grammar)
        return pd.Series(
            [[{"pos": i, "item": v, "error": e} for i, (v, e) in enumerate(parser.values(t), 1)] for t in texts],
            dtype=object,
        )

    return split.asNondeterministic()(column)  # computed once, not again in each filter


def split_rows(frame: DataFrame, keys: list[str], fields: list[str], grammar: Grammar = Grammar(), least: int = 2, strict: bool = True) -> DataFrame:
    """One row per value of each field that holds at least ``least`` values.

    ``strict`` leaves out pieces that are proven to be headings or leftovers; other values
    without a tail stay, with their flag.

    Result: the keys, ``field``, ``pos``, ``item``, ``error``. Repeated rows are reduced
    before the parser runs.
    """
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields]))
    long = frame.select(*keys, named.alias("_f")).select(*keys, "_f.field", "_f.text")
    parsed = (
        long.where(F.col("text").isNotNull() & (F.length(F.trim("text")) > 0))
        .dropDuplicates([*keys, "field", "text"])
        .withColumn("values", F.filter(split_field(F.col("text"), grammar), lambda v: ~(v["error"].eqNullSafe("no_tail") & v["item"].rlike(LEFTOVER)) if strict else F.lit(True)))
        .where(F.size("values") >= least)
    )
    return parsed.select(*keys, "field", F.posexplode("values").alias("i", "v")).select(*keys, "field", (F.col("i") + 1).alias("pos"), "v.item", "v.error")
