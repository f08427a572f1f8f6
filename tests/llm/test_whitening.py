import numpy as np
import pytest

from weekloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, key string, dim int"


def plain(vectors, weights="one"):
    """Clean vectors in, per vector (deviation, whitened up to 16 axes), shares out."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)) + 1_000_000
    distinct, back, times = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    w = np.ones(len(distinct)) if weights == "one" else times.astype(float)
    n, s = int(w.sum()), [int(v) for v in w @ distinct]
    mean = w @ distinct / n
    v = (distinct - mean).T @ (w[:, None] * (distinct - mean)) / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:16], axes[:, ::-1][:, :16]
    deviation = [sum((n * int(c) - t) ** 2 for c, t in zip(row, s)) for row in x]
    return n, deviation, (x - mean) @ axes / np.sqrt(e), e / np.trace(v)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "clash", 7) for i, v in rows], SCHEMA)
    return sorted(whitening.whitened(df, **options).collect(), key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component))


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_against_numpy(spark, weights):
    rng = np.random.default_rng(5)
    base = (rng.normal(size=(150, 20)) @ rng.normal(size=(20, 20))).tolist()
    vectors = [*base, *base[:30], *[base[3]] * 400]
    got = run(spark, list(enumerate(vectors)), weights=weights, hot_rows=8)
    n, deviation, white, share = plain(vectors, weights)
    assert len(got) == 16 * len(vectors)
    for at, r in enumerate(got):
        i, k = divmod(at, 16)
        assert (r.vec_id, r.component, r.n, r.deviation) == (i, k + 1, n, deviation[i])
        assert r.explained == pytest.approx(share[k], rel=1e-9)
        assert r.identity_error < 1e-9
    z = np.array([r.whitened for r in got]).reshape(-1, 16)
    signs = np.sign((z * white).sum(axis=0))
    assert np.abs(z - signs * white).max() < 1e-7


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [0.5, -3.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0]),
            (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [1.0, 2.0, 3.0])]
    got = run(spark, rows)
    assert [(r.vec_id, r.component) for r in got] == [(1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (None, 1), (None, 2)]
    assert {r.n for r in got} == {3}
    assert len({round(r.whitened, 9) for r in got if r.component == 1 and r.vec_id in (1, None)}) == 1


def test_flat_directions_and_huge_entries(spark):
    got = run(spark, [(i, [float(i), 1.0]) for i in range(5)])
    assert [r.whitened is None for r in got] == [False, True] * 5
    assert got[0].identity_error < 1e-12
    wide = run(spark, [(0, [0.0, 1.0]), (1, [3e38, 0.0]), (2, [1.0, 5.0])])
    assert len(wide) == 6 and {r.deviation is None for r in wide} == {True}
    alone = run(spark, [(0, [0.5, 0.25]), (1, [0.5, 0.25])])
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in alone] == [(1, 0, None, 0.0)] * 4


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []


def test_keys_of_equal_rows_are_equal():
    rows = np.array([[1, -128], [127, 0], [128, 0], [-40000, 1], [2**40, 0]])
    keys = whitening.encoded(rows)
    assert [k[0] for k in keys] == [1, 1, 2, 4, 8]
    assert (whitening.decoded(keys, 2) == rows).all()
