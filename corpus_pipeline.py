"""The corpus pipeline: language ID, quality, near duplicates, mixing and tokens, each over all that its predecessor kept.

SQL can't express any stage (context trees, a fitted kernel model, hash minima, an apportionment, merges), so ORACLE_SQL is
None; tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amplicore.llm import minhash_near, mixing, ppm_language, rff_quality, sentencepiece_bpe
from amplicore.llm._common import joined_by_id, stored, table

#: A text that its best language codes in more bits a byte than this is in none of the languages.
MOST_BITS = 6.5
LEAST_QUALITY = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a learned language; without any language labels, all documents with a letter."""
    model = ppm_language.train(docs)
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = ppm_language.identify(docs, model, id_col=docs.columns[0], carry=[F.col(c) for c in docs.columns[1:]], prefix="__")
    return found.where((F.col("__lang_pred") != "und") & (F.col("__bits_per_byte") <= MOST_BITS)).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose probability of good quality isn't below LEAST_QUALITY."""
    model = rff_quality.train(docs, table(spark, sf_dir, "labels"), "quality")
    scored = rff_quality.score(docs, model, [F.col(c) for c in docs.columns], score_col="__quality")
    return scored.where(F.col("__quality") >= LEAST_QUALITY).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class; one row of an id and text that has several.

    Different texts under one id are documents of their own, which come after all others in their classes. Rows with a null
    id stay.
    """
    ids = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h")).distinct()
    several = stored(ids.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("__several")), "several")
    keyed = docs.withColumn("__key", F.col("doc_id"))
    if not several.isEmpty():
        own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit(2**62 - 1)) + F.lit(2**62)
        keyed = joined_by_id(docs, several, "doc_id", "left").withColumn("__key", F.when(F.col("__several"), own).otherwise(F.col("doc_id")))
    classes = stored(minhash_near.near_classes(keyed, id_col="__key"), "classes")
    gone = stored(classes.where(~F.col("kept")).select(F.col("doc").alias("__key")).distinct(), "gone")
    kept = joined_by_id(keyed, gone, "__key", "left_anti")
    twice = stored(classes.where("kept and doc is not null").groupBy(F.col("doc").alias("__key")).count().where("count > 1").select("__key"), "twice")
    if not twice.isEmpty():
        kept = joined_by_id(kept, twice, "__key", "left_anti").unionByName(joined_by_id(kept, twice, "__key", "left_semi").dropDuplicates(["__key"]))
    return kept.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes half of them or more: not at all, once or twice. Ids may be null or repeated: rows are
    told apart by id, text and source, and rows equal in these share their copies evenly."""
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", F.lit(0), "text", F.lit(0), "source"))
    counted = mixing.mix(keyed, id_col="__key").groupBy(F.col("doc_id").alias("__key")).agg(F.count("*").alias("__rows"), F.sum("copies").alias("__copies"))
    counted = stored(counted.where("__copies > 0"), "copies")
    once = counted.where("__rows = 1").select("__key", F.expr("explode(array_repeat(1, int(__copies)))").alias("copy")).drop("copy")
    out = joined_by_id(keyed, once, "__key", "inner").select(*docs.columns)
    equal = counted.where("__rows > 1")
    if equal.isEmpty():
        return out
    numbered = joined_by_id(keyed, equal, "__key", "inner").withColumn("__row", F.row_number().over(Window.partitionBy("__key").orderBy("__key")))
    times = F.expr("explode(array_repeat(1, int(__copies div __rows) + int(__row <= __copies % __rows)))")
    return out.union(numbered.select(*docs.columns, times.alias("__copy")).select(*docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode_decode(docs, sentencepiece_bpe.default_model(), full=False)


STAGES = [("language_id", language_id), ("quality", quality), ("minhash_near_dedup", near_dedup), ("mix_sources", mix_sources), ("sentencepiece", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
