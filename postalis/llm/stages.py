"""A corpus pipeline of five stages over documents: quality, language, near duplicates, mixing, packing.

Every stage is written as Parquet in the folder that driver and executors share and read again, so a lost executor
repeats no earlier stage. All stages take nulls in any column, empty and very long texts, repeated rows and further
columns of any name, and give an empty table for an empty one; what they do with such rows is said at each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.llm import jaccard, langid, mixing, packing, quality
from postalis.llm.common import Scratch, screen, shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A prediction under this share is no language: its words fit several about as well.
LEAST_SCORE = 0.4
#: Rows can't be expressed in SQL (learned models, packing); tests/llm compares with brute-force versions.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines removed from them. Null and empty texts have no word and go; a
    null source is a host of its own; equal rows are judged alike."""
    own = docs.withColumn("_source", F.col("source"))
    rows = quality.judge(own, carry=("lang", "_source", "n_chars")).filter("kept")
    return rows.select("doc_id", F.col("clean_text").alias("text"), "lang", F.col("_source").alias("source"), F.when(F.col("n_removed_lines") > 0, F.length("clean_text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell, which is learned from the non-null labels among them; without any, none
    is kept. Null, empty and letterless texts go."""
    own = docs.withColumn("_text", F.col("text"))
    rows = langid.predict(own, langid.fit(docs), carry=("_text", "lang", "source", "n_chars"))
    return rows.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("doc_id", F.col("_text").alias("text"), "lang", "source", "n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class (five-word shingles, similarity 0.8 or more), once. Only documents
    that go, or stand twice, are shuffled. Texts without a word are like no other; rows with a null doc_id stay."""
    scratch = Scratch(spark)
    found = jaccard.classes(docs, size=5, percent=80).filter("doc_id is not null")
    odd = scratch.keep(found.groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count("*").alias("n")).filter("n > 1 or first <> doc_id"))
    rows = docs.select(*COLUMNS)
    hit = screen(rows, "doc_id", odd).join(odd, "doc_id", "left").filter("first is null or first = doc_id")
    once = hit.filter("n > 1").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("r")).select("doc_id", "r.*")
    return screen(rows, "doc_id", odd, hit=False).unionByName(hit.filter("n is null or n = 1").select(*COLUMNS)).unionByName(once)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. Texts are shuffled once, to their counts;
    equal rows, which share a count, again. A null text has no word and may be taken or not; a null source is one."""
    rows = docs.select(*COLUMNS).withColumn("_mark", F.xxhash64(*COLUMNS[1:]))
    taken = mixing.mix(rows, carry=("_mark",)).groupBy(F.col("doc_id").alias("_id"), F.col("_mark").alias("_of")).agg(F.sum("copies").alias("_c"), F.count("*").alias("_n")).filter("_c > 0")
    both = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_of")))
    equal = both.filter("_n > 1").groupBy("doc_id", "_mark").agg(F.min(F.struct(*COLUMNS[1:])).alias("r"), F.min("_c").alias("_c")).select("doc_id", "r.*", "_c")
    every = both.filter("_n = 1").select(*COLUMNS, "_c").unionByName(equal)
    return every.withColumn("_i", F.explode(F.expr("sequence(1L, _c)"))).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places; a null text is the end id alone."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("language_id", language_id), ("near_duplicates", near_duplicates), ("source_mixing", source_mixing), ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
