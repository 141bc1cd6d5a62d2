"""Document fingerprints by weighted term hashes, and tables of permuted blocks to find near ones. SQL functions only.

Each term (run of digits, letters and non-ASCII characters, lower case) hashes to 64 bits; for every bit the terms that
have it vote for it and the others against, each with its length as weight (16 at most). 32 sums of two 32-bit counters
each hold the votes: the weights of a text add up to no more than its length, so no counter overflows.

To find all fingerprints within `radius` bits, the 64 bits are cut into blocks; two fingerprints that near agree in all
but `radius` blocks at least. There is a table for each choice of the other blocks, in which these come first and are the
key (the permutation), and each table's pairs of equal keys are compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.sources.shared import written

RADIUS, BLOCKS = 3, 6
BUCKET_BYTES = 8 << 20
MAX_BUCKETS = 50_000
WEIGHT = 16
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_PAIR = (1 << 32) | 1


def simhash(texts: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """`keys` and the 64-bit fingerprint (long) of each row's text; `keys` tell rows apart. Texts without a term have 0."""
    terms = texts.select(*keys, F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _SEPARATORS)).alias("term"))
    terms = terms.select(*keys, F.xxhash64("term").alias("h"), F.least(F.length("term"), F.lit(WEIGHT)).cast("long").alias("w"))
    votes = [F.sum(F.col("w") * F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_PAIR))).alias(f"v{i}") for i in range(32)]
    sums = terms.groupBy(*keys).agg(F.sum("w").alias("all"), *votes)
    bits = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"v{i}", 32)
        for bit, ayes in ((i, low), (i + 32, high)):
            bits = bits.bitwiseOR(F.when(ayes * 2 > F.col("all"), F.lit(1 << bit if bit < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("long"))
    return sums.select(*keys, bits.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _masks(radius: int, blocks: int) -> list[int]:
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within_radius(queries: DataFrame, table: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fingerprint): all distinct pairs of fingerprints of the two tables that differ in at most `radius` bits.

    Both have a column `fingerprint`. More blocks make more tables with longer keys, which suit larger tables.
    """
    masks = _masks(radius, blocks)

    def keyed(of: DataFrame, name: str) -> DataFrame:
        tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)])
        return of.select("fingerprint").where("fingerprint IS NOT NULL").distinct().select(F.col("fingerprint").alias(name), F.inline(tables))

    met = keyed(queries, "query").join(keyed(table, "found"), ["t", "key"])
    return met.where(F.bit_count(F.col("query").bitwiseXOR(F.col("found"))) <= radius).select("query", F.col("found").alias("fingerprint")).distinct()


def _cuts(docs: DataFrame, n: int) -> list[Any]:
    """At most n - 1 ids at equal distances among some 20 n distinct ones, for types that have no percentiles."""
    ids = docs.select("id").where("id IS NOT NULL").distinct()
    every = max(1, ids.agg(F.approx_count_distinct("id")).first()[0] // (20 * n))
    chosen = [r.id for r in ids.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).orderBy("id").collect()]
    return [chosen[k * len(chosen) // n] for k in range(1, n)] if len(chosen) >= n else chosen


def _in_buckets(docs: DataFrame, bucket_bytes: int) -> tuple[DataFrame, int]:
    """Adds `bucket`: ranges of ids in order, of about `bucket_bytes` text each; null ids are in the first."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(MAX_BUCKETS, -(-size // bucket_bytes) or 1)
    cuts = []
    if n > 1:
        shares = [k / n for k in range(1, n)]
        if isinstance(docs.schema["id"].dataType, T.NumericType):
            cuts = sorted(set(docs.agg(F.percentile_approx("id", shares, max(10_000, 20 * n))).first()[0] or []))
        else:
            cuts = _cuts(docs, n)
    bounds = F.array(*[F.lit(c) for c in cuts])
    rows = docs.withColumn("bucket", F.lit(0))
    step = 1 << max(0, len(cuts).bit_length() - 1)
    while step and cuts:
        reached = F.get(bounds, F.col("bucket") + (step - 1)) < F.col("id")
        rows = rows.withColumn("bucket", F.col("bucket") + F.when(reached, step).otherwise(0))
        step //= 2
    return rows, len(cuts) + 1


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES, radius: int = RADIUS, blocks: int = BLOCKS, probe: Column | None = None) -> DataFrame:
    """Fingerprints of all texts and of their edited versions, and what they have in common.

    The edited text of a document has its last half (rounded down, in code points) replaced by as many first code points
    of the next document, ascending id; after the last comes the first. Rows of one id are in order of their texts,
    null ids come first, a null text is empty. Ids are numbers or texts.

    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, near_documents, near_own): near_edited
    and near_next are shares of equal bits; near_documents counts the documents within `radius` bits of the edited fingerprint,
    near_own those within it of the document's own one, itself included, where the condition `probe` on columns of `docs`
    holds (else null; without `probe`, everywhere).
    """
    probed = F.lit(True) if probe is None else F.coalesce(probe, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), probed.alias("probed"))
    spark = docs.sparkSession
    rows, n = _in_buckets(rows, bucket_bytes)
    filled = sorted(r.bucket for r in rows.select("bucket").distinct().collect())  # at most MAX_BUCKETS
    after = spark.createDataFrame([(b, filled[(i + 1) % len(filled)]) for i, b in enumerate(filled)], "bucket int, following int")
    # the first document of each bucket stands behind the last of the bucket before it
    first_id = rows.groupBy("bucket").agg(F.min(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("first"))
    first_id = F.broadcast(first_id.select(F.col("bucket").alias("b"), F.col("first.id").alias("i")).limit(MAX_BUCKETS))
    firsts = rows.join(first_id, (F.col("bucket") == F.col("b")) & F.col("id").eqNullSafe(F.col("i"))).groupBy("bucket").agg(F.min("text").alias("border"))
    borders = firsts.withColumnRenamed("bucket", "following").join(F.broadcast(after), "following").select("bucket", "border")

    order = Window.partitionBy("bucket").orderBy("id", "text")
    placed = rows.select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next"))
    placed = placed.join(borders, "bucket")
    half = F.floor(F.length("text") / 2).cast("int")
    following = F.coalesce("next", "border")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(following, F.lit(1), half))
    both = placed.select("bucket", "place", "id", "probed", "text", edited.alias("edited"))
    sides = both.select("bucket", "place", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))).alias("x"))
    prints = simhash(sides.select("bucket", "place", "x.side", "x.text"), ["bucket", "place", "side"])
    prints = prints.groupBy("bucket", "place").agg(F.max(F.when(F.col("side") == 0, F.col("fingerprint"))).alias("own"), F.max(F.when(F.col("side") == 1, F.col("fingerprint"))).alias("changed"))
    told = both.select("bucket", "place", "id", "probed", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    known = written(told.join(prints, ["bucket", "place"]), "fingerprints")

    beside = known.where("place = 1").select(F.col("bucket").alias("following"), F.col("own").alias("border")).join(F.broadcast(after), "following").select("bucket", "border")
    known = known.withColumn("next", F.lead("own").over(Window.partitionBy("bucket").orderBy("place"))).join(beside, "bucket")
    asked = known.select(F.explode(F.array("changed", F.when(F.col("probed"), F.col("own")))).alias("fingerprint"))
    near = within_radius(asked, known.select(F.col("own").alias("fingerprint")), radius, blocks)
    holders = known.groupBy(F.col("own").alias("fingerprint")).agg(F.count("*").alias("n"))
    found = written(near.join(holders, "fingerprint").groupBy("query").agg(F.sum("n").alias("n")), "near")
    of_edited = found.select(F.col("query").alias("changed"), F.col("n").alias("near_documents"))
    of_own = found.select(F.col("query").alias("own"), F.col("n").alias("near_own"))
    text_of = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return known.join(of_edited, "changed", "left").join(of_own, "own", "left").select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        text_of("own").alias("fingerprint"),
        text_of("changed").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.coalesce("next", "border")).alias("near_next"),
        F.coalesce("near_documents", F.lit(0)).alias("near_documents"),
        F.when(F.col("probed"), F.col("near_own")).alias("near_own"),
    )
