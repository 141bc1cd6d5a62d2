import math
import random
from collections import Counter

import numpy as np
import pytest
from cases import ODD, docs_of, words

from accrue.llm.lm import LogBilinear, fit, score, vocabulary, word_counts


def text(rng):
    out = []
    for _ in range(rng.randrange(1, 25)):
        out += rng.choice([["the", "red", f"fox{rng.randrange(40)}."], ["A", "blue", f"cat{rng.randrange(40)},"], ["one", "two"]])
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    return [(i, text(rng)) for i in range(300)]


@pytest.mark.parametrize("common", [5, 1000])
def test_counts_and_scores(spark, corpus, common):
    training = corpus[:250]
    rows = corpus + [(2000 + i, r[1]) for i, r in enumerate(ODD)]
    counts = word_counts(docs_of(spark, training))
    known = vocabulary(counts, head=20, common=common)
    c = Counter(w for _, t in training for w in words(t, lower=True))
    c[None] = len(training)
    n, v = sum(c.values()), len(c)
    assert (known.tokens, known.distinct) == (n, v)
    model = fit(docs_of(spark, training), known)
    got = {r.doc_id: r for r in score(docs_of(spark, rows), counts, known, model).collect()}
    for i, t in rows:
        tokens = [*words(t, lower=True), None]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(c[w] > 0 for w in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens), rel=1e-9)
        assert r.score < 0
    held_out = [got[i] for i, _ in corpus[250:]]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out) + 0.1 * sum(r.n_tokens for r in held_out)


def test_scores_do_not_depend_on_how_texts_are_dealt(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(text(rng) for _ in range(8))) for i in range(600)]
    by_parts = []
    for n in (1, 16):
        docs = docs_of(spark, rows).repartition(n)
        counts = word_counts(docs)
        known = vocabulary(counts, head=40)
        by_parts.append({r.doc_id: (r.score, r.n_tokens) for r in score(docs, counts, known, fit(docs, known)).collect()})
    one, many = by_parts
    tokens = sum(n for _, n in one.values())
    assert abs(sum(s for s, _ in one.values()) - sum(s for s, _ in many.values())) < 0.02 * tokens
    assert max(abs(one[i][0] - many[i][0]) / one[i][1] for i in one) < 0.06


def test_probabilities_add_up_to_one(spark, corpus):
    counts = word_counts(docs_of(spark, corpus))
    known = vocabulary(counts, head=10)
    model = fit(docs_of(spark, corpus), known, rounds=1)
    one, two = model.tables()
    total = LogBilinear.log_total(one, two)
    chances = np.exp(one[:, None, :] + two[None, :, :] - total[:, :, None])
    assert np.allclose(chances.sum(axis=2), 1)
    # all words that can follow, and one never seen of each class
    seen = [r.key for r in counts.collect()]
    candidates = sorted({w for _, t in corpus for w in words(t, lower=True)})
    assert len(seen) == len(candidates) + 1
    rows = [(i, w) for i, w in enumerate([*candidates, "unseen", "unseen.", "unseen,"])]
    first = {r.doc_id: r.score for r in score(docs_of(spark, rows), counts, known, model).collect()}
    end = {r.doc_id: r.score for r in score(docs_of(spark, [(0, "")]), counts, known, model).collect()}[0]
    # score of "w" is that of w behind the begin, and of the end behind w: take the end's off
    begin, stop = known.size - 1, known.head + 3
    taken = 0.0
    for i, w in rows:
        from accrue.llm.lm import _Tokens
        import pyarrow as pa

        symbol = known.look_up(_Tokens(pa.array([w])))[1][0]
        taken += 10 ** (first[i] - (one[symbol, stop] + two[begin, stop] - total[symbol, begin]) / math.log(10))
    assert taken + 10**end == pytest.approx(1, abs=1e-4)


def test_nothing_to_learn_from(spark):
    none = docs_of(spark, [])
    counts = word_counts(none)
    known = vocabulary(counts)
    got = {r.doc_id: r for r in score(docs_of(spark, [(1, "a b"), (2, None)]), counts, known, fit(none, known)).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[1].base_score, got[2].n_tokens) == (3, 0, 0, 0.0, 1)
    assert score(none, counts, known, fit(none, known)).count() == 0


def test_words_are_found_once_for_all_passes(spark):
    import numpy as np

    from accrue.llm.lm import encoded, fit_encoded, score_encoded

    docs = docs_of(spark, [(1, "a b, c. a"), (None, "a zz zz"), (3, None), (4, "")])
    counts = word_counts(docs.where("doc_id = 1"))
    known = vocabulary(counts, head=2, common=2)  # the two words behind, b, and c., are not common
    codes = encoded(docs.selectExpr("*", "doc_id = 3 AS held"), known, carry="held")
    got = {r.id: r for r in codes.collect()}
    for key, n in ((1, 5), (None, 4), (3, 1), (4, 1)):
        places = np.frombuffer(got[key].codes, "<i4")
        assert got[key].n_tokens == len(places) == n and places[-1] == -4  # the end
        assert all(-3 <= p < len(known.keys) for p in places[:-1])
    zz = got[None]
    assert list(np.frombuffer(zz.codes, "<i4"))[1:3] == [-3, -3] and zz.times == [2] and len(zz.rare) == 1
    assert len({r.row for r in got.values()}) == 4 and got[3].carried is True
    model = fit_encoded(codes.where("id = 1"), known)
    a = {r.id: tuple(r)[1:] for r in score_encoded(codes, counts, known, model).collect()}
    b = {r.doc_id: tuple(r)[1:] for r in score(docs, counts, known, model).collect()}
    assert a == b and a[1][:2] == (5, 5)
