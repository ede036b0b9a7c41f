"""The registered queries of the thirteen operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, cnn, decontam, jaccard, language, mixing, quality, reputation, rules, spelling, sql, tokens, winnow
from .common import fold, read, written


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = docs.join(read(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2).select("doc_id", "quality"), "doc_id")
    scored = quality.scored(docs, quality.fit(docs, learnt))
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= quality.LEVEL).cast("int").alias("predicted"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.counted(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > tokens.LIMIT).alias("over_limit"), "truncate_chars")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.link_classes(read(spark, sf_dir, "documents"), k=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ok).alias("text"))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    back = chat.read_back(chat.formatted(chat.chain(rows)))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        F.when(F.col("tree") != "-", F.substring("tree", 2, 30)).cast("long").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is bad if the label with its number has quality 0 or toxic 1."""
    bad = F.expr("CASE WHEN quality IS NULL AND toxic IS NULL THEN NULL WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END")
    return reputation.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels").select("doc_id", bad.alias("bad")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = docs.join(read(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0).select("doc_id", "toxic"), "doc_id")
    scored = cnn.scored(docs, cnn.fit(learnt))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify_documents(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    held_out = fold("doc_id", language.FOLDS) == language.HELD_OUT
    return found.select("doc_id", F.col("lid_lang").alias("language"), F.col("lid_posterior").alias("posterior"), F.col("lid_text_lang").alias("text_language"), F.col("lid_keep").alias("keep"), held_out.alias("held_out"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compared(read(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(rules.statistics(read(spark, sf_dir, "documents").select("doc_id", "text")), "rule_statistics")
    labelled = stats.join(read(spark, sf_dir, "labels").filter("quality is not null").select("doc_id", F.col("quality").alias("label")), "doc_id")
    forest = rules.fit(labelled)
    level = rules.threshold(rules.scored(labelled, forest))
    return rules.judged(rules.scored(stats, forest), level).select("doc_id", *rules.STATISTICS[:5], "base_failed", "kept", "anomaly")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(read(spark, sf_dir, "documents")))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(read(spark, sf_dir, "documents").select("doc_id", "text"))


def lang_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator where all kinds of evidence are: pages with their markup, address and host."""
    found = language.identify_pages(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))
    return found.select("page_id", F.col("lid_lang").alias("language"), F.col("lid_posterior").alias("posterior"), F.col("lid_text_lang").alias("text_language"), F.col("lid_keep").alias("keep"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality, op2_token_counts, op3_source_mix, op4_jaccard_join, op5_decontaminate, op6_chat_format, op7_url_filter, op8_toxicity, op9_language_id, op10_fingerprints, op11_quality_rules, op12_spelling_variants, op13_token_alignment, lang_pages)}
SQL: dict[str, str] = {"op4_jaccard_join": sql.JACCARD, "op6_chat_format": sql.CHAT, "op7_url_filter": sql.REPUTATION}
