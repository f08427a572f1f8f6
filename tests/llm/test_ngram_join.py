"""The similarity join against all pairs by plain sets."""

import random
import re
from itertools import combinations

import pytest

from weekloom.llm import ngram_join as nj


def grams(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    """[(doc_id, class_id, n_links, n_copies)] by comparing every pair of different texts."""
    texts = sorted({t or "" for _, t in docs})
    sets = {t: grams(t) for t in texts}
    links = [(a, b) for a, b in combinations(texts, 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b])]
    root = {t: t for t in texts}

    def find(t):
        return t if root[t] == t else find(root[t])

    for a, b in links:
        root[find(a)] = find(b)
    out = []
    for i, t in docs:
        same = [j for j, u in docs if find(u or "") == find(t or "") and j is not None]
        out.append((i, min(same, default=None), sum((t or "") in p for p in links), sum((u or "") == (t or "") for _, u in docs)))
    return sorted(out, key=str)


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for family in range(12):
        base = draw.choices(vocabulary, k=draw.choice([3, 5, 12, 60, 200]))
        for _ in range(draw.choice([1, 2, 9, 25])):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            docs.append((len(docs), " ".join(words) + draw.choice(["", ".", "!"])))
    return docs + [(None, docs[0][1]), (None, None), (900, ""), (900, ""), (901, "..."), (docs[3][0], docs[3][1])]


@pytest.mark.parametrize("block_texts", [400, 7])
def test_same_links_and_classes_as_all_pairs(spark, block_texts):
    docs = corpus(block_texts)
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, root string, n int")
    got = [tuple(r) for r in nj.NgramJoin(frame, block_texts=block_texts).documents().collect()]
    assert sorted(got, key=str) == brute(docs)


def test_one_of_each_class(spark):
    docs = corpus(3)
    frame = spark.createDataFrame([(*d, f"s{k}") for k, d in enumerate(docs)], "doc_id long, text string, source string")
    kept = nj.one_of_each(frame)
    assert kept.columns == frame.columns
    rows = kept.collect()
    classes = {}
    for k, (i, t) in enumerate(docs):
        classes.setdefault(i, set())
    expected = {r[1] for r in brute(docs) if r[1] is not None}
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == sorted(expected)
    assert len(rows) == len({(r["doc_id"], r["text"]) for r in rows})


def test_no_rows_and_no_links(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert nj.NgramJoin(frame).documents().count() == 0 and nj.one_of_each(frame).count() == 0
    frame = spark.createDataFrame([(1, "one two three four five six"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, nj.NgramJoin(frame).documents().collect())) == [(1, 1, 0, 1), (2, 2, 0, 1)]


def test_chains_become_one_component(spark):
    draw = random.Random(1)
    order = list(range(60))
    draw.shuffle(order)
    edges = [(bytes([a]), bytes([b])) for a, b in zip(order, order[1:])] + [(bytes([200]), bytes([100]))]
    frame = spark.createDataFrame(edges, "fp binary, root binary")
    got = {bytes(r["fp"]): bytes(r["root"]) for r in nj.components(frame).collect()}
    assert got == {bytes([k]): b"\0" for k in range(60)} | {bytes([200]): bytes([100]), bytes([100]): bytes([100])}


def test_pruning_keeps_pairs_at_the_threshold():
    """The posterior rule drops a pair whose similarity is the threshold with at most a tiny probability in all steps together."""
    from math import comb

    lost = 0.0
    for step, fewest in enumerate(nj.least_matches(0.8, nj.TOLERANCE), 1):
        n = step * nj.STEP
        lost += sum(comb(n, m) * 0.8**m * 0.2 ** (n - m) for m in range(fewest))
    assert lost < 1e-4


def test_repeated_rows_with_map_columns(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text, {"b": 1}, {"x": 1}), (1, text, {"a": 2}, {"x": 2}), (2, text, None, None), (None, None, {"c": 3}, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>, fp map<string,int>")
    kept = nj.one_of_each(frame)
    assert kept.schema == frame.schema
    assert sorted(((r["doc_id"], r["tags"]) for r in kept.collect()), key=str) == sorted([(1, {"a": 2}), (None, {"c": 3})], key=str)


def test_hot_keys_are_joined_without_dealing_their_rows(spark):
    hot = [("hot", i) for i in range(5000)] + [(f"k{i}", i) for i in range(5000)]
    rows = spark.createDataFrame(hot, "k string, i int")
    known = spark.createDataFrame([("hot", 5000, "h")] + [(f"k{i}", 1, str(i)) for i in range(5000)], "k string, n long, label string")
    joined = nj.with_hot_keys(rows, known, "k", "n")
    assert sorted(map(tuple, joined.select("k", "i", "label").collect())) == sorted((k, i, "h" if k == "hot" else str(i)) for k, i in hot)
    assert nj.with_hot_keys(rows.limit(0), known.limit(0), "k", "n").count() == 0


def test_star_with_a_hub(spark):
    edges = [(i.to_bytes(2, "big"), (3000).to_bytes(2, "big")) for i in range(1, 3000)] + [((3000).to_bytes(2, "big"), (4000).to_bytes(2, "big"))]
    got = nj.components(spark.createDataFrame(edges, "fp binary, root binary")).collect()
    assert {int.from_bytes(r["fp"], "big") for r in got} == {*range(1, 3001), 4000}
    assert {int.from_bytes(r["root"], "big") for r in got} == {1}
