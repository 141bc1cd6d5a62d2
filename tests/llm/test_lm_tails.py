"""Words outside the head are told apart by the model, as target and as context."""

import random

from cases import docs_of

from accrue.llm.lm import LEAST, fit, score, vocabulary, word_counts


def test_words_outside_the_head_have_vectors(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        side, word = rng.choice([("left", "x"), ("right", "y")])
        rows.append((i, " ".join(f"{side} {word}{rng.randrange(20)} {word}{rng.randrange(20)}" for _ in range(10))))
    docs = docs_of(spark, rows)
    counts = word_counts(docs)
    known = vocabulary(counts, head=4)
    model = fit(docs, known)
    texts = [f"{a} {b}{k}" for k in range(10, 16) for a, b in (("left", "x"), ("left", "y"), ("right", "y"), ("right", "x"))]
    texts += [f"{a}{k + 1} {b}{k}" for k in range(10, 16) for a, b in (("x", "x"), ("x", "y"), ("y", "y"), ("y", "x"))]
    got = {r.doc_id: r.score for r in score(docs_of(spark, [*enumerate(texts)]), counts, known, model).collect()}
    own = [(got[k] - got[k + 1]) + (got[k + 2] - got[k + 3]) for k in range(0, len(texts), 4)]
    assert min(own[:6]) > 0.5 and min(own[6:]) > 0.2


def test_vectors_grow_with_the_vocabulary(spark):
    for n in (50, 3000):
        docs = docs_of(spark, [(i, " ".join(f"w{k}" for k in range(n))) for i in range(LEAST)])
        known = vocabulary(word_counts(docs))
        tails = fit(docs, known).tails
        assert len(tails.n) == n and tails.outside.sum() == max(0, n - 1024)
