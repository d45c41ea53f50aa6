"""Display transforms: line breaks of the print undone, references carried across.

Every break is of a class that the signs on both sides of it tell: a broken word, a
suspended hyphen, a compound, the end of a sentence, the edge of the text, or none of
these. Each class is one replacement, so a text is reflowed by a chain of expressions. A
reference is put between two private signs before, which the replacements let pass; where
they stand afterwards are its offsets.

Defined results: null stays null, an empty text stays empty; an entry whose references do
not agree with the stored ones gets null marks, never wrong ones; private signs that a
text holds itself are dropped where marks are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaweave.functions import text as T
from lemmaweave.operators.parse import WORD, reference_words
from lemmaweave.operators.skew import join_nullable

#: Private signs: around a reference, and for a paragraph break that is decided.
OPEN, CLOSE, PARAGRAPH = "\ue000", "\ue001", "\ue002"
_SIGNS = f"([{OPEN}{CLOSE}]*)"
BREAK = rf"{_SIGNS}[^\S\n]*\n\s*{_SIGNS}"
# (pattern, replacement) of each class, the first that fits decides.
HYPHENS = [
    (rf"(?U)-{BREAK}(?=\p{{Lu}})", "-$1$2"),
    (rf"(?U)-{BREAK}(?=(?:{'|'.join(T.SUSPENDED)})(?!\p{{L}}))", "-$1 $2"),
    (rf"(?U)-{BREAK}(?=\S)", "$1$2"),
]
EDGES = [(rf"(?U)\A{BREAK}", f"$1{PARAGRAPH}$2"), (rf"(?U){BREAK}\z", f"$1{PARAGRAPH}$2")]
SENTENCES = (rf"(?U)([.!?:;][»«\"'›‹)\]}}{OPEN}{CLOSE}]*)[^\S\n]*\n\s*{_SIGNS}(?=[\p{{Lu}}\p{{Nd}}(\[])", f"$1{PARAGRAPH}$2")
OTHERS = (rf"(?U){BREAK}", "$1 $2")


def reflowed(text: Column, paragraphs: bool = True) -> Column:
    """A text without the line breaks of the print; with ``paragraphs`` a break stays one
    between the end of one sentence and the start of the next."""
    for pattern, to in [*EDGES, *HYPHENS, *([SENTENCES] if paragraphs else []), OTHERS]:
        text = F.regexp_replace(text, pattern, to)
    return F.replace(text, F.lit(PARAGRAPH), F.lit("\n\n"))


def with_marks(frame: DataFrame, text: str, stored: str, arrow: str = "↑") -> DataFrame:
    """Adds ``body``, the reflowed ``text``, and ``marks``: [start, end, number] of each of
    its references there, null if they are not the beginning of the ``stored`` words."""
    plain = F.translate(text, OPEN + CLOSE + PARAGRAPH, "")
    signed = F.regexp_replace(plain, f"({arrow}›?{WORD})", f"{OPEN}$1{CLOSE}")
    said, known = F.transform("_found", lambda w: T.key(w)), F.transform(F.slice(F.col(stored), F.lit(1), F.greatest(F.size("_found"), F.lit(0))), lambda w: T.key(w))
    # Between the signs lie text and references by turns; lengths add up to offsets.
    steps = lambda done, part: F.array_append(done, F.element_at(done, -1) + F.length(part))
    frame = frame.withColumns({"_found": reference_words(plain, arrow), "_parts": F.split(reflowed(signed), f"[{OPEN}{CLOSE}]", -1)})
    frame = frame.withColumn("_at", F.aggregate("_parts", F.array(F.lit(0)), steps))
    numbers = F.when(F.size("_found") > 0, F.sequence(F.lit(0), F.size("_found") - 1)).otherwise(F.array().cast("array<int>"))
    made = F.transform(numbers, lambda k: F.array(F.get("_at", 2 * k + 1), F.get("_at", 2 * k + 2), k))
    agree = (F.length(text) > 0) & F.col(stored).isNotNull() & (said == known)
    frame = frame.withColumns({"marks": F.when(agree, made), "body": F.when(F.col(text).isNotNull(), F.array_join("_parts", ""))})
    return frame.drop("_found", "_parts", "_at")


def payloads(entries: DataFrame, resolved: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per entry on the map: reflowed text, reference list and marks."""

    on_map = nodes.select(F.col("id").alias("resolved_entry_id"), F.lit(True).alias("on_map"))
    listed = resolved.select("entry_id", "ordinal", "raw_target", "status", "resolved_entry_id")
    listed = join_nullable(listed, on_map, "resolved_entry_id")
    refs = listed.groupBy(F.col("entry_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("ordinal", "raw_target", "status", F.when(F.col("on_map"), F.col("resolved_entry_id")).alias("node")))).alias("refs"))
    joined = entries.select("id", "headword", "volume", "entry_type", "author_sigil", "printed_page_start", "body_text", (F.col("werke_raw").isNotNull() | F.col("literatur_raw").isNotNull()).alias("has_bib")).join(refs, "id", "left")
    words = F.transform("refs", lambda r: r["raw_target"])
    return with_marks(joined.withColumn("_words", words), "body_text", "_words").drop("_words", "body_text")
