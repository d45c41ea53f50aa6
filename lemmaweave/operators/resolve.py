"""Reference resolution: a priority funnel of lookups with recorded ambiguity.

Every entry is indexed twice: by its whole lemma and the comma-delimited beginnings of it
(``L``), and by its first word or, of compounds with a slash, the first word of each half
(``W``). A reference becomes prioritised probes: the phrases of its context, its word, the
halves of a compound, its stems. What an index key says for a source volume is decided
once per (index, key, volume) by two grouped aggregates, not once per reference.

A probe wins with its single exact headword anywhere; else with the single exact headword,
or the single candidate, of the same volume (of all volumes, if the volume has none). A
phrase counts only if it wins, any other probe as soon as it has candidates; the first
that counts decides. Nothing is guessed: several equal candidates are ``ambiguous``.

References are resolved per distinct (volume, target, context), so a target that a third
of all references name is looked up once per context, and comes back to its rows by a
skew-safe join.

Defined results: one row per (entry_id, ordinal), the earliest delivery; null or empty
targets and contexts are unresolved probes of their kind; entries count once per id (the
latest delivery); null headwords are not indexed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lemmaweave.functions import text as T
from lemmaweave.operators.skew import heavy_values, join_by_value
from lemmaweave.sources import cut

MAX_HOPS = 3
RESOLVED = ["same_volume", "cross_volume", "deinflected", "slash_half"]


def latest(entries: DataFrame) -> DataFrame:
    """One row per id: the latest delivery (ties by headword)."""
    columns = [c for c in entries.columns if c != "id"]
    best = entries.groupBy("id").agg(F.max_by(F.struct(*columns), F.struct(F.coalesce("loaded_at", F.lit("1970-01-01").cast("timestamp")), F.coalesce("headword", F.lit("")))).alias("e"))
    return best.select("id", "e.*")


def delivered(references: DataFrame) -> DataFrame:
    """One row per (entry_id, ordinal): the earliest delivery."""
    return references.groupBy("entry_id", "ordinal").agg(F.min(F.struct("loaded_at", "raw_target", "raw_context")).alias("r")).select("entry_id", "ordinal", "r.raw_target", "r.raw_context")


def index(entries: DataFrame) -> DataFrame:
    """(ix, key, entry_id, volume, is_exact, via_slash) of all entries."""
    named = entries.where(F.col("headword").isNotNull()).select(F.col("id").alias("entry_id"), "volume", "headword", T.key(T.lemma("headword")).alias("exact"))
    lemmas = named.select("entry_id", "volume", "exact", F.explode(F.array_distinct(F.transform(T.comma_prefixes("headword"), T.key))).alias("key"))
    lemmas = lemmas.select(F.lit("L").alias("ix"), "key", "entry_id", "volume", (F.col("key") == F.col("exact")).alias("is_exact"), F.lit(False).alias("via_slash"))
    part = F.explode(F.split(T.core("headword"), "/", -1))
    halves = named.withColumn("slashed", F.contains(T.core("headword"), F.lit("/"))).select("entry_id", "volume", "exact", "slashed", part.alias("part"))
    first = F.element_at(F.filter(T.words(T.without_article(T.strip("part"))), lambda w: w != ""), 1)
    firsts = halves.where(F.size(T.words(T.without_article(T.strip("part")))) > 0).select("entry_id", "volume", "exact", "slashed", first.alias("word")).where(F.length("word") > 1)
    firsts = firsts.select(F.lit("W").alias("ix"), T.key("word").alias("key"), "entry_id", "volume", (T.key("word") == F.col("exact")).alias("is_exact"), F.col("slashed").alias("via_slash"))
    return lemmas.unionByName(firsts)


def _said(by: list[str]) -> list[Column]:
    one = F.struct("entry_id", "volume", "via_slash")
    return [F.count(F.lit(1)).alias("n"), F.count_if("is_exact").alias("n_exact"), F.max(one).alias("any_one"), F.max(F.when(F.col("is_exact"), one)).alias("exact_one")]


def lookups(probes: DataFrame, indexed: DataFrame) -> DataFrame:
    """(ix, key, volume, winner, scope) for the distinct probed (ix, key, volume).

    ``winner`` is null if nothing or no single candidate is there; ``scope`` is the volume
    whose candidates were considered, '*' for all volumes, null if there are none.
    """
    everywhere = indexed.groupBy("ix", "key").agg(*_said(["ix", "key"]))
    per_volume = indexed.groupBy("ix", "key", F.col("volume").alias("v")).agg(*_said(["ix", "key", "v"]))
    distinct = probes.select("ix", "key", "volume").distinct()
    g, v = everywhere.alias("g"), per_volume.alias("v")
    met = distinct.alias("p").join(g, (F.col("p.ix") == F.col("g.ix")) & (F.col("p.key") == F.col("g.key")), "inner")
    met = met.join(v, (F.col("p.ix") == F.col("v.ix")) & (F.col("p.key") == F.col("v.key")) & (F.col("p.volume") == F.col("v.v")), "left")
    own = F.col("v.n").isNotNull()
    scoped = {c: F.when(own, F.col(f"v.{c}")).otherwise(F.col(f"g.{c}")) for c in ("n", "n_exact", "any_one", "exact_one")}
    winner = F.when(F.col("g.n_exact") == 1, F.col("g.exact_one")).when(scoped["n_exact"] == 1, scoped["exact_one"]).when(scoped["n"] == 1, scoped["any_one"])
    scope = F.when((F.col("g.n_exact") == 1) | ~own, F.lit("*")).otherwise(F.col("p.volume"))
    return met.select(F.col("p.ix").alias("ix"), F.col("p.key").alias("key"), F.col("p.volume").alias("volume"), winner.alias("winner"), scope.alias("scope"))


def probes(forms: DataFrame, words_only: bool = False) -> DataFrame:
    """Prioritised probes of distinct (form, volume, raw_target, raw_context)."""
    target = F.coalesce(F.col("raw_target"), F.lit(""))
    kind = "struct<priority:int,ix:string,text:string,suffix:string,n_words:int>"
    one = lambda p, ix, t, s, n: F.struct(p.cast("int").alias("priority"), F.lit(ix).alias("ix"), t.alias("text"), s.cast("string").alias("suffix"), n.cast("int").alias("n_words")).cast(kind)
    none, single = F.lit(None), F.lit(1)
    word = F.array(one(F.lit(100), "W", target, none, single))
    halves = F.filter(F.split(target, "/", -1), lambda h: T.strip(h) != "")
    # Longest first; halves of equal length keep their order.
    ranked = F.array_sort(F.transform(halves, lambda h, i: F.struct((-F.length(h)).alias("n"), i.alias("i"), h.alias("h"))))
    slashed = F.when(F.contains(target, F.lit("/")), F.transform(ranked, lambda h, i: one(200 + i, "W", h["h"], none, single))).otherwise(F.array().cast(f"array<{kind}>"))
    endings = F.array(*[F.struct(F.lit(300 + i).alias("p"), F.lit(s).alias("s")) for i, s in enumerate(T.SUFFIXES)])
    fitting = F.filter(endings, lambda e: F.endswith(target, e["s"]) & (F.length(target) - F.length(e["s"]) >= 3))
    stems = F.transform(fitting, lambda e: one(e["p"], "W", F.left(target, F.length(target) - F.length(e["s"])), e["s"], single))
    phrase = F.transform(T.phrases("raw_context"), lambda p, i: one(i, "L", p, none, F.size(T.words(p))))
    parts = [word, slashed, stems] if words_only else [F.coalesce(phrase, F.array().cast(f"array<{kind}>")), word, slashed, stems]
    exploded = forms.select("form", "volume", F.explode(F.concat(*parts)).alias("p")).select("form", "volume", "p.*")
    return exploded.withColumn("key", T.key("text")).drop("text")


def funnel(references: DataFrame, indexed: DataFrame, words_only: bool = False) -> DataFrame:
    """Resolve (entry_id, ordinal, raw_target, raw_context): one row each, no redirects chased."""
    rows = references.withColumn("volume", T.volume_of("entry_id"))
    context = F.lit(None).cast("string") if words_only else F.col("raw_context")
    rows = rows.withColumn("form", F.to_json(F.struct("volume", "raw_target", context.alias("c"))))
    counted = rows.groupBy("form").agg(F.count(F.lit(1)).alias("_n"), F.first("volume").alias("volume"), F.first("raw_target").alias("raw_target"), F.first(context).alias("raw_context"))
    counted = cut(counted, rows.sparkSession)
    asked = probes(counted, words_only)
    said = lookups(asked, indexed)
    answered = asked.join(said, ["ix", "key", "volume"])
    counts = (F.col("ix") == "W") | F.col("winner").isNotNull()
    best = answered.where(counts).groupBy("form").agg(F.min_by(F.struct("ix", "key", "suffix", "n_words", "winner", "scope"), "priority").alias("b"))
    bare = counted.select("form", T.key(F.coalesce("raw_target", F.lit(""))).alias("bare"))
    decided = bare.join(best, "form", "left")
    status = (
        F.when(F.col("b").isNull(), "unresolved")
        .when(F.col("b.winner").isNull(), "ambiguous")
        .when(F.col("b.suffix").isNotNull(), "deinflected")
        .when((F.col("b.ix") == "W") & F.col("b.winner.via_slash"), "slash_half")
    )
    decided = decided.select(
        "form", status.alias("s"), F.col("b.winner.entry_id").alias("resolved_entry_id"), F.col("b.winner.volume").alias("to_volume"),
        F.coalesce("b.key", "bare").alias("match_key"), F.col("b.suffix").alias("suffix_stripped"), F.coalesce("b.n_words", F.lit(1)).alias("match_words"), F.col("b.scope").alias("scope"),
    )
    decided = cut(decided, rows.sparkSession)  # both parts of the join read it
    out = join_by_value(rows, decided, "form", heavy_values(counted, "form", "_n"))
    final = F.coalesce("s", F.when(F.col("to_volume") == F.col("volume"), "same_volume").otherwise("cross_volume"))
    return out.select("entry_id", "ordinal", "raw_target", final.alias("status"), "resolved_entry_id", "match_key", "suffix_stripped", "match_words", "scope")


def next_hop(entries: DataFrame, references: DataFrame, indexed: DataFrame) -> DataFrame:
    """(id, next_id): where each redirect's first reference leads, by its word alone."""
    redirects = entries.where("entry_type = 'redirect'").select(F.col("id").alias("entry_id"))
    firsts = references.where("ordinal = 0").join(redirects, "entry_id", "left_semi")
    return funnel(firsts, indexed, words_only=True).where(F.col("resolved_entry_id").isNotNull()).select(F.col("entry_id").alias("id"), F.col("resolved_entry_id").alias("next_id"))


def chase(resolved: DataFrame, hops: DataFrame, most: int = MAX_HOPS) -> DataFrame:
    """Follow redirects: bounded self-joins that stop at a failure or a revisit.

    Chains are walked from each redirect, not from each reference: the last stop and the
    number of hops of an id are one small table, joined once.
    """
    walk = hops.select("id", F.col("next_id").alias("at"), F.array("id", "next_id").alias("seen"), F.lit(1).alias("n"))
    for _ in range(most - 1):
        step = hops.select(F.col("id").alias("at"), F.col("next_id").alias("to"))
        on = walk.join(step, "at", "left")
        go = F.col("to").isNotNull() & ~F.array_contains("seen", F.coalesce("to", F.lit("")))
        walk = on.select("id", F.when(go, F.col("to")).otherwise(F.col("at")).alias("at"), F.when(go, F.array_append("seen", F.col("to"))).otherwise(F.col("seen")).alias("seen"), (F.col("n") + go.cast("int")).alias("n"))
    ends = walk.where(F.col("at") != F.col("id")).select(F.col("id").alias("resolved_entry_id"), F.col("at").alias("end_id"), F.col("n").alias("redirect_hops"))
    counted = resolved.where(F.col("resolved_entry_id").isNotNull()).groupBy("resolved_entry_id").agg(F.count(F.lit(1)).alias("_n"))
    some = resolved.where(F.col("resolved_entry_id").isNotNull())
    chased = join_by_value(some, ends, "resolved_entry_id", heavy_values(counted, "resolved_entry_id", "_n"), "left")
    rest = resolved.where(F.col("resolved_entry_id").isNull()).withColumn("end_id", F.lit(None).cast("string")).withColumn("redirect_hops", F.lit(None).cast("int"))
    return chased.unionByName(rest).withColumn("resolved_entry_id", F.coalesce("end_id", "resolved_entry_id")).withColumn("redirect_hops", F.coalesce("redirect_hops", F.lit(0))).drop("end_id")


def run(entries: DataFrame, references: DataFrame, only: str | None = None, most: int = MAX_HOPS) -> DataFrame:
    """Resolve all references; ``only`` keeps sources whose volume contains it (the index
    always covers all volumes)."""
    # Read by several steps each, so made once: the lineage would otherwise multiply.
    spark = entries.sparkSession
    entries, references = cut(latest(entries), spark), cut(delivered(references), spark)
    indexed = cut(index(entries), spark)
    sources = references if only is None else references.where(F.contains(T.volume_of("entry_id"), F.lit(only)))
    return chase(cut(funnel(sources, indexed), spark), cut(next_hop(entries, references, indexed), spark), most)


def candidates(resolved: DataFrame, indexed: DataFrame) -> DataFrame:
    """(entry_id, ordinal, candidate_entry_id): what each ambiguous reference could mean."""
    open_ = resolved.where("status = 'ambiguous'").select("entry_id", "ordinal", F.col("match_key").alias("key"), "scope")
    words_ = indexed.where("ix = 'W'").select("key", F.col("entry_id").alias("candidate_entry_id"), "volume")
    # A term that most ambiguous references name has one list of candidates, which goes to
    # its references; keys and scopes meet once, not once per reference.
    asked = open_.groupBy("key", "scope").agg(F.count(F.lit(1)).alias("_n"))
    listed = asked.join(words_, "key").where((F.col("scope") == "*") | (F.col("scope") == F.col("volume")))
    listed = listed.groupBy("key", "scope").agg(F.collect_set("candidate_entry_id").alias("c"))
    form = F.to_json(F.struct("key", "scope"))
    met = join_by_value(open_.withColumn("form", form).drop("key", "scope"), listed.select(form.alias("form"), "c"), "form", heavy_values(asked.withColumn("form", form), "form", "_n"))
    return met.select("entry_id", "ordinal", F.explode("c").alias("candidate_entry_id")).distinct()


def status_report(resolved: DataFrame) -> DataFrame:
    """Per status: references, share, redirects followed, found by a phrase."""
    total = Window.partitionBy()
    counted = resolved.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("redirect_hops") > 0).alias("n_chased"), F.count_if(F.col("match_words") > 1).alias("n_by_phrase"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(total), 6))
