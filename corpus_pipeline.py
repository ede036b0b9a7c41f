"""A training corpus from `documents`: language, toxicity, near duplicates, benchmark leaks, and the mix of sources.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns rows with the columns of documents; the last returns the mix.
A stage's output is written as Parquet and read again as the next one's docs. Null or empty tables, null texts and repeated rows are handled as the
operators' docstrings say. The near-duplicate and the leak stage tell rows by a hash of doc_id and text, not by doc_id alone: rows with one doc_id, or
without any, and different texts are different documents; of rows with the same doc_id and text the near-duplicate stage keeps one. A document
without any text has no language and goes in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncloom.llm import cnn, decontam, jaccard, language, mixing
from syncloom.llm.common import checkpoint, forget, join_checked, read, written

#: Near duplicates: words of a shingle and least similarity in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: What tells rows apart in the stages that drop copies and leaks.
KEY = "_row_key"
#: Rows of a list of ids that is broadcast; a longer one is joined by a shuffle.
ID_ROWS = 2_000_000


def _set_aside(docs: DataFrame) -> DataFrame:
    """docs with all columns but those of documents under names that clash with no operator's."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in COLUMNS else f"_extra_{i}") for i, c in enumerate(docs.columns)])


def _restored(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select(*[F.col(c if c in COLUMNS else f"_extra_{i}").alias(c) for i, c in enumerate(docs.columns)])


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with KEY, a 64-bit hash of doc_id and text that is never null. It is the same whenever the rows are read, so nothing is written for it."""
    return docs.withColumn(KEY, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified surely enough (operator 9)."""
    return _restored(language.identify_documents(_set_aside(docs)).filter("lid_keep"), docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of operator 8, fitted on labels of these documents, doesn't hold toxic."""
    learnt = docs.select("doc_id", "text").join(read(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id")
    return _restored(cnn.scored(_set_aside(docs), cnn.fit(learnt), out="_toxicity").filter("_toxicity < 0.5"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id (none comes last), of each class of near duplicates (operator 4)."""
    # rows whose doc_id is null or repeated are known by their hash; the others keep their doc_id, whose order makes few pivots and edges
    unclear = checkpoint(docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").select(F.col("doc_id").alias("_unclear")))
    clear = unclear.isEmpty()
    if clear:
        keyed = docs.withColumn(KEY, F.col("doc_id"))
    else:
        marked = join_checked(_keyed(docs), unclear.filter("_unclear is not null"), F.col("doc_id") == F.col("_unclear"), "left")
        keyed = marked.withColumn(KEY, F.when(F.col("doc_id").isNull() | F.col("_unclear").isNotNull(), F.col(KEY)).otherwise(F.col("doc_id"))).drop("_unclear")
    classes = jaccard.link_classes(keyed, SHINGLE_WORDS, SIMILARITY, id_col=KEY)
    gone = checkpoint(classes.filter("id <> component").select(F.col("id").alias(KEY)))
    if clear:
        return join_checked(keyed, gone, KEY, "left_anti", rows=ID_ROWS).select(*[f"`{c}`" for c in docs.columns])
    # a class has the smallest key of its members as component, which needn't be that of the smallest id
    others = checkpoint(classes.filter("id <> component").select("id", "component").distinct())
    members = checkpoint(others.unionByName(others.select(F.col("component").alias("id"), "component").distinct()))
    ids = join_checked(keyed.select(F.col(KEY).alias("id"), "doc_id"), members, "id", rows=ID_ROWS)
    first = ids.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id")).alias("first")).select("first.id")
    gone = checkpoint(members.join(first, "id", "left_anti").select(F.col("id").alias(KEY)))
    kept = join_checked(keyed, gone, KEY, "left_anti", rows=ID_ROWS)
    repeated = checkpoint(keyed.groupBy(KEY).count().filter("count > 1").select(KEY))
    if not repeated.isEmpty():
        one = join_checked(kept, repeated, KEY, "left_semi").dropDuplicates([KEY, "doc_id", "text"])
        kept = join_checked(kept, repeated, KEY, "left_anti").unionByName(one)
    return kept.select(*[f"`{c}`" for c in docs.columns])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with any item of `benchmark` (operator 5)."""
    keyed = _keyed(docs)
    leaks = checkpoint(decontam.contaminated(keyed, read(spark, sf_dir, "benchmark"), id_col=KEY).select(F.col("doc_id").alias(KEY)).distinct())
    return join_checked(keyed, leaks, KEY, "left_anti", rows=ID_ROWS).select(*[f"`{c}`" for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes (operator 3)."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("source_mix", mix_sources),
]

#: The classifiers can't be expressed in SQL; the stages are tested against brute force and planted documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
