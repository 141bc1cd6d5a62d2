"""Fill-in-the-middle documents by counted quantifiers.

A text is a run of units, one code point each. `regexp_count` gives the number n of them, and two hashes of the id cut
them at a <= b. The pattern of a row is its own: `unit{a}+` captures the prefix, `unit{b-a}+` the middle and `unit*+` the
suffix, all possessive, so that one match without any backtracking yields the three, and the replacement puts them into
their new order at once. Everything is a projection of the scanned rows: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FIM_PERCENT, SPM_PERCENT = 90, 20
UNIT = "(?s:.)"
STRIDE = 1024


def unit_count(text: Column, stride: int = STRIDE) -> Column:
    """The number of code points of a text.

    `regexp_count` holds all its matches at once, so whole strides are counted first and only what is left behind the
    last one is counted unit by unit.
    """
    rest = F.regexp_replace(text, rf"\A(?:{UNIT}{{{stride}}})*+", "")
    return (F.regexp_count(text, F.lit(f"{UNIT}{{{stride}}}+")).cast("long") * stride + F.regexp_count(rest, F.lit(UNIT))).cast("long")


def id_hashes(id_col: Column, seed: int, n: int = 4) -> list[Column]:
    """The first n 8-digit groups of the hex sha256 of `seed:id`, as unsigned integers; a null id is an empty one."""
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hexes, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 1, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row.

    Of the hashes h1 to h4 of the id, h1 and h2 modulo n + 1 are the cuts, h3 decides whether the text is rearranged
    (`fim_percent` of 100) and h4 whether the suffix goes first (`spm_percent` of these). An empty text and one that holds
    a sentinel stay plain, with their own text as output; a null text is empty. Rows that repeat give equal rows; rows
    without an id share the hashes of an empty one. Other columns are left behind, whatever their names.
    """
    one, two, three, four = id_hashes(F.col("_id"), seed)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), whole.alias("_text")).withColumn("_n", unit_count(F.col("_text")))
    sentinel = F.contains("_text", F.lit(PREFIX)) | F.contains("_text", F.lit(SUFFIX)) | F.contains("_text", F.lit(MIDDLE))
    form = F.when((F.col("_n") == 0) | sentinel | (three % 100 >= fim_percent), PLAIN).when(four % 100 < spm_percent, SPM).otherwise(PSM)
    cuts = [h % (F.col("_n") + 1) for h in (one, two)]
    rows = rows.select("*", form.alias("_form"), F.least(*cuts).alias("_a"), F.greatest(*cuts).alias("_b"))
    counted = F.concat(F.lit(rf"\A({UNIT}{{"), F.col("_a").cast("string"), F.lit(rf"}}+)({UNIT}{{"), (F.col("_b") - F.col("_a")).cast("string"), F.lit(rf"}}+)({UNIT}*+)\z"))
    order = F.when(F.col("_form") == PSM, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    cut = F.col("_form") != PLAIN
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n"),
        F.col("_form").alias("form"),
        F.when(cut, F.col("_a")).alias("prefix_chars"),
        F.when(cut, F.col("_b") - F.col("_a")).alias("middle_chars"),
        F.when(cut, F.regexp_replace(F.col("_text"), counted, order)).otherwise(F.col("_text")).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of: its parts between the sentinels, in their first order.

    The text holds no sentinel, and none can arise across a seam, so the first one of each kind is the one put there.
    """
    parts = lambda first, second: rf"(?s)\A{first}(.*?){second}(.*?){MIDDLE}(.*+)\z"
    return (
        F.when(form == PSM, F.regexp_replace(output, parts(PREFIX, SUFFIX), "$1$3$2"))
        .when(form == SPM, F.regexp_replace(output, parts(SUFFIX, PREFIX), "$2$3$1"))
        .otherwise(output)
    )
