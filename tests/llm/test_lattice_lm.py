"""Lattice likelihood against enumeration of all segmentations, the base against plain counting, held-out quality."""

import math
from collections import Counter

import numpy as np
import pytest

from weekloom.llm import lattice_lm as lm
from weekloom.llm.common import table
from tests.conftest import SF


@pytest.fixture(scope="module")
def vocabulary():
    return lm.vocabulary_of(lm.load())


def enumerate_all(v, word, scores):
    """Probability of a word with its marker by trying every split."""
    total, stack = 0.0, [(0, 0.0)]
    while stack:
        i, s = stack.pop()
        if i == len(word):
            total += math.exp(s)
            continue
        stack += [(j, s + scores[v.place[word[i:j]]]) for j in range(i + 1, len(word) + 1) if word[i:j] in v.place]
        if i:
            stack.append((i + 1, s + scores[v.spelled(word[i])].sum()))
    return math.log(total)


def test_forward_sums_all_segmentations(vocabulary):
    scores = vocabulary.start()
    words = ["the", "thering", "é", "straße", "中文", "a▁b", "x\u0000y", "😀"]
    got = lm.word_scores(vocabulary, words, scores)
    assert np.allclose(got, [enumerate_all(vocabulary, lm.MARK + w, scores) for w in words])
    assert np.allclose(got, [lm.one_word(vocabulary, lm.MARK + w, scores) for w in words])


def test_expected_counts_agree_and_spell_the_words(vocabulary):
    scores = vocabulary.start()
    words, weights = ["theroning", "aé", "😀b"], [3.0, 2.0, 1.0]
    fast, slow = np.zeros(vocabulary.size), np.zeros(vocabulary.size)
    lm.word_scores(vocabulary, words, scores, fast, weights)
    for w, n in zip(words, weights):
        lm.one_word(vocabulary, lm.MARK + w, scores, slow, n)
    assert np.allclose(fast, slow)
    letters = sum(fast[i] * len(p) for i, p in enumerate(vocabulary.pieces))
    assert letters <= sum(n * (len(w) + 1) for w, n in zip(words, weights)) + 1e-9


def test_long_words(vocabulary):
    assert np.isfinite(lm.word_scores(vocabulary, ["ab" * 5000], vocabulary.start())[0])


def brute_base(docs):
    words = {k: lm.words_of(t) for k, (_, t) in enumerate(docs)}
    train = Counter()
    for k, (i, _) in enumerate(docs):
        if not lm.held_out(i):
            train.update(words[k] + [None])
    total, distinct = sum(train.values()), len(train)
    rows = []
    for k, (i, _) in enumerate(docs):
        tokens = words[k] + [None]
        rows.append((i, lm.held_out(i), len(tokens), sum(train[w] > 0 for w in tokens), total,
                     sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in tokens)))
    return rows


@pytest.mark.parametrize("head", [0, 7, 100_000])
def test_documents(spark, head):
    docs = [(i, f"The quick {'Brown' if i % 2 else 'red'} fox\n w{i} w{i % 5}") for i in range(40)]
    docs += [(None, "the end"), (5, None), (6, ""), (7, "the quick"), (7, "the quick"), (9, "  x\x1cy ")]
    frame = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id long, text string, row int, word string")
    got = [tuple(r) for r in lm.LatticeModel(head=head).fit(frame).score(frame).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert [r[:5] for r in sorted(got, key=key)] == [r[:5] for r in sorted(brute_base(docs), key=key)]
    assert np.allclose([r[5] for r in sorted(got, key=key)], [r[5] for r in sorted(brute_base(docs), key=key)])
    assert all(r[6] < 0 for r in got)


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert lm.LatticeModel().fit(frame).score(frame).count() == 0


def test_training_raises_the_likelihood_of_held_out_texts(spark):
    docs = table(spark, SF, "documents")
    sums = [lm.LatticeModel(rounds=n).fit(docs).score(docs).where("held_out").agg({"score": "sum"}).first()[0] for n in (0, 1, 2)]
    assert sums[0] < sums[1] < sums[2] < 0
