"""Documents with every odd thing the operators must take, under columns of clashing names."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = "id string, words string, n_words string, spans string, items string, carried string, kept string, runs string, anchors string, row string, n string, gram string, prefix string, bucket string, place string, next string, held_out string, n_tokens string, length string, sequence_id string, `group` string, component_id string"
EXTRA = [c.split()[0].strip("`") for c in CLASH.split(", ")]
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text, pattern=WORDS, lower=False):
    return pattern.findall(low(text) if lower else text or "")


def docs_of(spark, rows):
    """Rows of (doc_id, text[, lang])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1]), *["x"] * len(EXTRA)) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


LONG = " ".join(f"w{i % 977}x" for i in range(60_000))
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "One"),
    (6, "one two"),
    (7, "größer als ein Wort, n’est-ce pas? 语言 模型 　  x"),
    (8, LONG),
    (9, LONG),
    (10, "!!! ### 123 456"),
    (11, "a" * 70_000),
    (12, "same same same same same same same same same same same same"),
    (12, "same same same same same same same same same same same same"),
    (None, "a row without an id keeps its words and has many of them in it"),
    (None, None),
    (13, "a row without an id keeps its words and has many of them in it"),
    (-5, "negative ids come first \U0001f600 \U00010400"),
]
