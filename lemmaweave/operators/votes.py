"""Evidence by votes: which character an unknown code stands for, and runs of spans.

Defined results: null words are left out; ties for the first place are no decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def word_counts(texts: DataFrame, text: str, least: int = 1) -> DataFrame:
    """(word, n) of the words of a text column."""
    words = texts.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(\p{L}+)"), F.lit(1))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def vote(unknown: DataFrame, known: DataFrame, floor: int = 5, share: float = 0.55, margin: float = 2.0) -> DataFrame:
    """Decide each code by the clean words that fit around it.

    ``unknown``: (code, prefix, suffix) of words with exactly one unreadable place;
    ``known``: (word, n). A known word votes, with its count, for the letter it has at the
    place. Places where both cases of a letter fit are left out. A letter is accepted from
    ``floor`` votes, ``share`` of all votes and ``margin`` times the runner-up.
    """
    asked = unknown.groupBy("code", "prefix", "suffix").agg(F.count(F.lit(1)).alias("k"))
    place = known.where(F.length("word") >= 4).select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i"))
    cut = place.select(F.expr("left(word, i - 1)").alias("prefix"), F.expr("substring(word, i, 1)").alias("letter"), F.expr("substring(word, i + 1)").alias("suffix"), "n")
    keyed = cut.join(asked.select("prefix", "suffix").distinct(), ["prefix", "suffix"], "left_semi").groupBy("prefix", "suffix", "letter").agg(F.sum("n").alias("n"))
    cases = keyed.groupBy("prefix", "suffix", F.lower("letter").alias("low")).agg(F.countDistinct("letter").alias("c")).where("c > 1").select("prefix", "suffix").distinct()
    votes = asked.join(keyed.join(cases, ["prefix", "suffix"], "left_anti"), ["prefix", "suffix"]).groupBy("code", "letter").agg(F.sum(F.col("n") * F.col("k")).alias("n"))
    by = Window.partitionBy("code")
    ranked = votes.withColumn("r", F.row_number().over(by.orderBy(F.desc("n"), "letter"))).withColumn("next", F.lead("n").over(by.orderBy(F.desc("n"), "letter"))).withColumn("total", F.sum("n").over(by))
    ok = (F.col("r") == 1) & (F.col("n") >= floor) & (F.col("n") >= share * F.col("total")) & (F.col("next").isNull() | (F.col("n") >= margin * F.col("next")))
    return ranked.where(ok).select("code", "letter", F.col("n").alias("votes"), F.round(F.col("n") / F.col("total"), 6).alias("share"))


def layered(layers: list[DataFrame]) -> DataFrame:
    """(code, letter) of several (code, letter) tables, later ones overriding earlier."""
    ranked = [f.select("code", "letter", F.lit(i).alias("rank")) for i, f in enumerate(layers)]
    united = ranked[0]
    for f in ranked[1:]:
        united = united.unionByName(f)
    return united.groupBy("code").agg(F.max_by("letter", F.struct("rank", "letter")).alias("letter"))


def islands(rows: DataFrame, part: list[str], order: list[str], same: str) -> DataFrame:
    """Runs of consecutive rows with the same value: (part, run, value, n, first, last)."""
    by = Window.partitionBy(*part).orderBy(*order)
    starts = rows.withColumn("_s", (~F.col(same).eqNullSafe(F.lag(same).over(by)) | (F.row_number().over(by) == 1)).cast("int"))
    runs = starts.withColumn("run", F.sum("_s").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*part, "run").agg(F.first(same).alias(same), F.count(F.lit(1)).alias("n"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"))


def as_of(events: DataFrame, marks: DataFrame, part: list[str], at: str, value: str, width: int = 1000) -> DataFrame:
    """Each event with the value of the last mark at or before it.

    Time is taken in stretches of ``width``: a window per part and stretch over the union of
    both streams finds the last mark within; the last mark of all stretches before is found
    among one row per stretch. So no part, however large, is one task.
    """
    stretch = F.floor(F.col(at) / width)
    both = events.withColumn("_m", F.lit(1)).withColumn(f"_{value}", F.lit(None).cast(dict(marks.dtypes)[value])).unionByName(
        marks.select(*part, at, F.lit(0).alias("_m"), F.col(value).alias(f"_{value}")), allowMissingColumns=True
    )
    within = F.last(f"_{value}", ignorenulls=True).over(Window.partitionBy(*part, "_s").orderBy(at, "_m").rowsBetween(Window.unboundedPreceding, 0))
    seen = both.withColumn("_s", stretch).withColumn("_w", within).where("_m = 1")
    ends = marks.where(F.col(value).isNotNull()).groupBy(*part, stretch.alias("_s")).agg(F.max_by(value, at).alias("_e"))
    asked = events.select(*part, stretch.alias("_s")).distinct().withColumn("_q", F.lit(True))
    steps = asked.join(ends, [*part, "_s"], "full")
    before = F.last("_e", ignorenulls=True).over(Window.partitionBy(*part).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1))
    carried = steps.withColumn("_c", before).where("_q").select(*part, "_s", "_c")
    return seen.join(carried, [*part, "_s"], "left").withColumn(value, F.coalesce("_w", "_c")).drop("_m", "_s", "_w", "_c", f"_{value}")
