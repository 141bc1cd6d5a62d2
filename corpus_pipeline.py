"""From raw documents to packed sequences: five stages, each over all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrue.llm.decontaminate import contamination
from accrue.llm.jaccard import similar_groups
from accrue.llm.language import fit_profiles, identify
from accrue.llm.packing import pack, pieces
from accrue.llm.substring import remove_repeats
from accrue.sources.shared import discard, written
from accrue.sources.ship import ship_library

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "byte_bpe_50k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: tuple[str, ...] | None = None) -> DataFrame:
    """Documents with a letter, in one of `languages` by their text where these are given; the others go.

    A row without `lang` gets the predicted one. Profiles are learned from all labelled documents.
    """
    ship_library(spark)
    docs = docs.select(*COLUMNS)
    found = identify(docs, fit_profiles(docs), lettered=True).where("lettered")
    if languages is not None:
        found = found.where(F.col("lang_pred").isin(*languages))
    told = F.when(F.col("lang_pred") != "und", F.col("lang_pred"))
    return found.withColumn("lang", F.coalesce("lang", told)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates; documents without id all stay.

    Rows are told apart by id and text, so that of several texts of one id each is judged by itself; of rows equal in both
    the smallest stays.
    """
    ship_library(spark)
    docs = docs.select(*COLUMNS)
    # in the order of the ids: below each id there is room for a hash of the text
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 59)).cast("decimal(20,0)")
    keyed = docs.where("doc_id IS NOT NULL").withColumn("key", (F.col("doc_id").cast("decimal(19,0)") * F.lit(1 << 59).cast("decimal(18,0)") + place).cast("decimal(38,0)"))
    heads = similar_groups(keyed.select("key", "text"), "key").where("key = component_id").select("key").distinct()
    one = keyed.join(heads, "key").groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return one.select("row.*").select(*COLUMNS).union(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that an earlier one has; those of which nothing is left go."""
    ship_library(spark)
    cut = remove_repeats(docs, carry=["lang", "source", "n_chars"])
    changed = F.col("n_removed") > 0
    cut = cut.where(~changed | (F.col("kept") != "")).select("doc_id", F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"), "carried.*", changed.alias("_changed"))
    return cut.withColumn("n_chars", F.when(F.col("_changed"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no phrase of the benchmark occurs."""
    ship_library(spark)
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=["text", "lang", "source", "n_chars"])
    return found.where(F.size("spans") == 0).select("doc_id", "carried.*").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as pieces packed into sequences of 2048."""
    ship_library(spark)
    packed = pack(pieces(docs, public_tokenizers.path(TOKENIZER)))
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Token ids and the language model are beyond SQL; tests/llm compares each stage with a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return docs
