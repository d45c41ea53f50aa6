"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaweave.llm import canonical, encoding, leakage, lookalikes, markup, packing, residue, scan_noise
from lemmaweave.operators.skew import heavy_values, join_by_value
from lemmaweave.sources import cut, spread, table

TEXTS = ["body_text", "werke_raw", "literatur_raw"]


def _pages(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Entries and the tokens of their fields: one pass over the texts, used by every step."""
    entries = spread(table(spark, root, "entries", "id", "volume", *TEXTS), spark)
    return entries, cut(markup.page_tokens(entries, ["id"], "volume", TEXTS), spark)


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return markup.found(_pages(spark, root)[1], ["id"]).select(F.col("id").alias("entry_id"), "field")


def p1_ways(spark: SparkSession, root: str) -> DataFrame:
    return markup.ways(_pages(spark, root)[1], ["id"])


def p1_clean(spark: SparkSession, root: str) -> DataFrame:
    entries, counted = _pages(spark, root)
    return markup.cleaned(entries.drop("volume"), counted, ["id"], TEXTS).withColumnRenamed("id", "entry_id")


def p1_slots(spark: SparkSession, root: str) -> DataFrame:
    entries, counted = _pages(spark, root)
    return markup.slots(entries.drop("volume"), counted, ["id"], TEXTS).withColumnRenamed("id", "entry_id")


def p1_classes(spark: SparkSession, root: str) -> DataFrame:
    found = markup.classes(_pages(spark, root)[1])
    return found.select(F.col("_host").alias("volume"), "class_id", F.array_join("roles", " ").alias("roles"), F.array_join("words", " ").alias("words"), "n_pages", "parent")


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    entries = spread(table(spark, root, "entries", "id", "headword", *TEXTS, "unreadable_chars"), spark)
    surveyed = cut(encoding.survey(entries, "id", ["body_text", "headword"]), spark)
    texts = encoding.found(surveyed, "id", encoding.model_of(surveyed), spark)
    counts = encoding.miscounted(entries, "id", "unreadable_chars", TEXTS).select("id", F.lit("unreadable_chars").alias("field"))
    return texts.unionByName(counts).select(F.col("id").alias("entry_id"), "field")


def p2_restored(spark: SparkSession, root: str) -> DataFrame:
    entries = spread(table(spark, root, "entries", "id", "headword", "body_text"), spark)
    surveyed = cut(encoding.survey(entries, "id", ["body_text", "headword"]), spark)
    fixed = encoding.restored(entries, ["body_text", "headword"], encoding.model_of(surveyed), spark)
    return fixed.select(F.col("id").alias("entry_id"), "headword_fixed", "headword_chain", "body_text_fixed", "body_text_chain").distinct()


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    resolved = table(spark, root, "resolved_cross_references", "entry_id", "ordinal", "raw_target", "status")
    open_ = resolved.where("status = 'unresolved'").select("entry_id", F.col("ordinal").cast("string").alias("sub_key"), F.col("raw_target").alias("value")).distinct()
    # Only words cut at a line end need their context, so only those rows are exchanged.
    ends = r"(?sU)\w[-‐¬\x{AD}]\s*$"
    contexts = (
        table(spark, root, "cross_references", "entry_id", "ordinal", "raw_target", "raw_context")
        .where(F.col("raw_target").rlike(ends))
        .groupBy("entry_id", F.col("ordinal").cast("string").alias("sub_key"), F.col("raw_target").alias("value"))
        .agg(F.max("raw_context").alias("context"))
    )
    whole = open_.where(~F.col("value").rlike(ends) | F.col("value").isNull()).withColumn("context", F.lit(None).cast("string"))
    parted = open_.where(F.col("value").rlike(ends)).join(contexts, ["entry_id", "sub_key", "value"], "left")
    lemmas = table(spark, root, "lemmas", "entry_id", "variant_type", "lemma").where("variant_type = 'redirect_alias'")
    aliases = lemmas.select(F.lit("lemma").alias("field"), "entry_id", F.col("variant_type").alias("sub_key"), F.col("lemma").alias("value"), F.lit(None).cast("string").alias("context")).distinct()
    rows = whole.unionByName(parted).withColumn("field", F.lit("raw_target")).unionByName(aliases)
    # One value may hold a third of the rows: each (value, context) is mapped once, and
    # the mapping comes back to the rows by their key, heavy keys by broadcast.
    rows = rows.withColumn("key", F.to_json(F.struct("value", "context")))
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("value").alias("value"), F.first("context").alias("context"))
    counted = cut(counted, spark)
    to_ids = canonical.mapped(counted.select("value", "context"), table(spark, root, "lemma_register", "register_id", "lemma"))
    mapping = cut(to_ids.select(F.to_json(F.struct("value", "context")).alias("key"), "register_id"), spark)
    found = join_by_value(rows, mapping, "key", heavy_values(counted, "key", "n"))
    return found.groupBy("field", "entry_id", "sub_key").agg(F.max("register_id").alias("register_id"))


def _scan_parts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts, word counts and misreadings of the corpus, the same for finding and repairing."""
    entries = spread(table(spark, root, "entries", "id", "headword", "body_text"), spark)
    targets = table(spark, root, "cross_references", "raw_target").distinct()
    token = F.explode(F.array_distinct(F.regexp_extract_all("raw_target", F.lit(r"([\p{L}\d]+)"), F.lit(1)))).alias("word")
    in_texts = scan_noise.count_words(entries.select("body_text").where(F.length("body_text") > 0))
    # Pieces of words (broken, abbreviated) attest no word.
    pieces = [F.regexp_extract_all("raw_target", F.lit(p), F.lit(1)) for p in (r"([\p{L}\d]+)[-‐¬\x{AD}.…\x{200B}-\x{200F}]", r"[-‐¬\x{AD}\x{200B}-\x{200F}]\s*([\p{L}\d]+)")]
    in_targets = targets.select(token, F.concat(*pieces).alias("pieces")).select("word", F.when(F.array_contains("pieces", F.col("word")), 0).otherwise(1).alias("n"))
    counts = cut(in_texts.unionByName(in_targets).groupBy("word").agg(F.sum("n").alias("n")), spark)
    # Headwords and the canonical list are right whatever their frequency.
    known = entries.select("headword").unionByName(table(spark, root, "lemma_register", F.col("lemma").alias("headword")))
    names = known.select(F.explode(F.regexp_extract_all("headword", F.lit(r"([\p{L}]+)"), F.lit(1))).alias("word"))
    return entries, counts, cut(scan_noise.misreadings(counts, names), spark)


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    entries, counts, noise = _scan_parts(spark, root)
    texts = scan_noise.text_cases(entries, "id", "body_text", counts, noise, spark)
    rows = table(spark, root, "cross_references", "entry_id", "ordinal", "raw_target", "raw_context")
    values = scan_noise.value_cases(rows, "raw_target", "raw_context", noise).select(F.lit("raw_target").alias("field"), "entry_id", "ordinal").distinct()
    return texts.select(F.lit("body_text").alias("field"), F.col("id").alias("entry_id"), F.lit(-1).alias("ordinal")).unionByName(values)


def p6_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    entries, counts, noise = _scan_parts(spark, root)
    maps = scan_noise.choices(scan_noise.repairs(entries, "id", "body_text", counts, noise, spark))

    @F.pandas_udf("string")
    def mend(texts, found):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([None if t is None else scan_noise.continuous(t, dict(m) if m is not None else None) for t, m in zip(texts, found, strict=True)])

    joined = entries.select("id", "body_text").distinct().join(maps, "id", "left")
    return joined.select(F.col("id").alias("entry_id"), mend(F.col("body_text"), F.col("fixes")).alias("body_text"))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return lookalikes.found(
        [
            (table(spark, root, "entries", "id", "headword"), "headword", F.col("id"), F.lit(""), F.col("headword")),
            (table(spark, root, "lemmas", "entry_id", "variant_type", "lemma_key"), "lemma_key", F.col("entry_id"), F.col("variant_type"), F.col("lemma_key")),
            (table(spark, root, "cross_references", "entry_id", "ordinal", "raw_target"), "raw_target", F.col("entry_id"), F.col("ordinal"), F.col("raw_target")),
        ]
    )


def _packed(spark: SparkSession, root: str) -> DataFrame:
    import public_tokenizers

    documents = spread(table(spark, root, "documents", "doc_id", "text"), spark)
    sizes = cut(packing.measured(documents, public_tokenizers.path("byte_bpe_50k.tiktoken")), spark)
    rows = table(spark, root, "container_sizes", "size_id", "capacity_tokens").distinct().collect()  # the parameter of the operator
    return packing.packed(sizes, sorted((r.size_id, r.capacity_tokens) for r in rows))


def p8_pack(spark: SparkSession, root: str) -> DataFrame:
    return _packed(spark, root)


def p8_report(spark: SparkSession, root: str) -> DataFrame:
    return packing.report(_packed(spark, root), table(spark, root, "container_sizes"))


def _leaks(spark: SparkSession, root: str) -> DataFrame:
    documents = spread(table(spark, root, "documents", "doc_id", "text"), spark)
    return leakage.leaks(documents, table(spark, root, "eval_items", "item_id", "text"), spark)


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return _leaks(spark, root).select("doc_id", "item_id").distinct()


def p9_matches(spark: SparkSession, root: str) -> DataFrame:
    kind = F.when(F.col("edits") == 0, "phrase").otherwise("proximity")
    return _leaks(spark, root).select("doc_id", "item_id", "start", "words", "edits", kind.alias("kind"))


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return residue.found(spread(table(spark, root, "documents", "doc_id", "text"), spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {}
