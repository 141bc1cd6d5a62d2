"""The registered queries: one operator each, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrue.llm.decontaminate import contamination
from accrue.llm.fim import fill_in_middle, restored
from accrue.llm.hilbert import pack_along_curve
from accrue.llm.jaccard import similar_groups
from accrue.llm.language import fit_profiles, identify
from accrue.llm.lm import encoded, fit_encoded, score_encoded, vocabulary, word_counts
from accrue.llm.merkle import document_manifest, siblings
from accrue.llm.packing import pack, pieces
from accrue.llm.quality import fit_pooled, picked_labels, pooled, score_pooled, word_vectors
from accrue.llm.simhash import edited_fingerprints
from accrue.llm.split import held_out
from accrue.llm.substring import remove_repeats
from accrue.llm.tokenfile import read_token_files, write_token_files
from accrue.llm.warc import deduplicate_archives, read_archives, resolve_revisits, write_archives
from accrue.sources.shared import discard, shared_folder, written
from accrue.sources.ship import ship_library

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_library(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside phrases of the benchmark, and the items they come from."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span.end - span.first)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, deduplicated, and read back with revisits joined to their responses."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    captured, kept = shared_folder(spark, "warc"), shared_folder(spark, "warc")
    write_archives(pages, captured)
    deduplicate_archives(spark, captured, kept, kind)
    return resolve_revisits(read_archives(spark, kept, kind))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of windows that begin in an earlier document."""
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents; counts and model come from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 7, 2).alias("held_out"))
    training = docs.where("NOT held_out")
    counts = word_counts(training)
    known = vocabulary(counts)
    codes = encoded(docs, known, carry="held_out")
    scored = score_encoded(codes, counts, known, fit_encoded(codes.where("NOT carried"), known))
    discard(codes)
    return scored.withColumnRenamed("id", "doc_id").withColumn("held_out", held_out("doc_id", 7, 2))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces packed into sequences of 2048 ids."""
    packed = pack(pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "bins", "bound")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to token files and read back."""
    docs = table(spark, sf_dir, "documents")
    path = shared_folder(spark, "token-files")
    write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
    return read_token_files(spark, path, docs.schema["doc_id"].dataType).withColumnRenamed("id", "doc_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, compared, and searched in permuted block tables.

    Those of the edited texts are searched, and the own ones of every id divisible by 20.
    """
    return edited_fingerprints(table(spark, sf_dir, "documents"), probe=F.col("doc_id") % 20 == 0)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents whose sets of 3-word shingles are 0.9 similar."""
    return similar_groups(table(spark, sf_dir, "documents"), size=3, percent=90)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; labels are learned from the rows that are not held out, word vectors from all texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 3, 1).alias("held_out"))
    vectors = word_vectors(docs)
    means = written(pooled(docs.withColumn("id", F.col("doc_id")), "text", vectors, ["id", "held_out"]), "means")
    discard(vectors.table)
    network = fit_pooled(means.where("NOT carried.held_out"), picked_labels(docs.where("NOT held_out"), table(spark, sf_dir, "labels")))
    scored = score_pooled(means, network).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted languages of all documents; profiles are counted over the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out("doc_id", 3, 1).alias("held_out"))
    profiles = fit_profiles(docs.where("NOT held_out"))
    return identify(docs.select("doc_id", "text", "held_out"), profiles).drop("text")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into prefix, middle and suffix and rearranged, and their texts rebuilt from that."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    sha = lambda text: F.sha2(text, 256)
    rebuilt = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(rebuilt).alias("restored_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; every third proof is checked against a tampered text."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    made = document_manifest(table(spark, sf_dir, "documents"), tampered=tampered)
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed along a Hilbert curve into sequences of 4096 ids."""
    return pack_along_curve(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER)).withColumnRenamed("id", "doc_id")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_packing": op5_packing,
    "op6_token_files": op6_token_files,
    "op7_simhash": op7_simhash,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_quality": op9_quality,
    "op10_language": op10_language,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_curve_packing": op13_curve_packing,
}
