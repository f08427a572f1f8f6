import random
from hashlib import sha256
from zlib import crc32

import pytest

from weekloom.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, digest string, witness int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc, source, lang, chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, chars, text)))


def plain_tree(nodes):
    """Root and per node the steps (before, after) to it."""
    at, steps = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for i, place in enumerate(at):
            run, k = runs[place // 3], place % 3
            steps[i].append((run[:k], run[k + 1:]))
            at[i] = place // 3
        nodes = [h(*run) for run in runs]
    return nodes[0], steps


def plain(rows):
    by = {}
    for doc, text, lang, source, chars, *_ in rows:
        by.setdefault(source, []).append((doc is not None, doc or 0, leaf(doc, source, lang, chars, text), doc, text, lang, chars))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    roots = {}
    for s in order:
        by[s].sort(key=lambda r: r[:3])
        roots[s] = plain_tree([r[2] for r in by[s]])
    root, tops = plain_tree([roots[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (_, _, own, doc, text, lang, chars), steps in zip(by[s], roots[s][1]):
            touched = doc is not None and crc32(str(doc).encode()) % 2 == 0
            at = leaf(doc, s, lang, chars, text.replace("\n", "") if touched and text is not None else text)
            for before, after in steps + top:
                at = h(*before, at, *after)
            proof = h(*(d for before, after in steps + top for d in before + after))
            out.append((doc, own, roots[s][0], root, proof, at, at == root))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    got = merkle.audited(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted(map(tuple, got), key=repr)


def documents(n, sources, seed=1):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n)
    return [(i, rng.choice(["a\nb", "", None, "é\n\n", "plain"]), rng.choice(["en", None]), rng.choice(sources), rng.choice([None, 3]), 1, "d", 2) for i in ids]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_against_plain_trees(spark, levels):
    rows = documents(260, ["hot"] * 9 + ["", None, "ü", "z", *(f"s{i}" for i in range(12))])
    assert run(spark, rows, levels=levels) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_sizes_of_one_source(spark, n):
    rows = documents(n, ["only"], seed=n)
    assert run(spark, rows, levels=2) == plain(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a\n", "en", "s", 1, 1, "d", 2), (None, "b", "en", "s", 1, 1, "d", 2), (4, "c\n", "en", None, None, 1, "d", 2)] + [(7, "x\n", None, "s", 2, 1, "d", 2)] * 5
    got = run(spark, rows, levels=1)
    want = plain(rows)
    # equal leaves may change places, their proofs with them
    assert [(r[:4], r[6]) for r in got] == [(r[:4], r[6]) for r in want]
    assert sorted(r[4] for r in got) == sorted(r[4] for r in want)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_appender_extends_witnesses_of_open_subtrees():
    tree = merkle.Appender(3)
    for k in range(7):
        tree.append(h(str(k)), k)
    # two complete runs and one open node
    assert [len(run) for run in tree.open] == [1, 2, 0, 0]
    assert [witness for _, below in tree.open[1] for _, witness in below][1] == [h("0") + "|" + h("2")]
    assert tree.open[0][0][1] == [(6, [])]


def test_any_change_is_noticed(spark):
    rows = documents(40, ["a", "b"])
    rows[5] = (1000, "first\nsecond", "en", "a", 3, 1, "d", 2)
    got = {r.doc_id: r for r in merkle.audited(spark.createDataFrame(rows, SCHEMA)).collect()}
    for doc, text, *_ in rows:
        assert got[doc].verified is not (crc32(str(doc).encode()) % 2 == 0 and "\n" in (text or ""))
