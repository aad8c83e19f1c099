import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.llm import spectrum as S
from riskmart.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, v int, w string, at int, n string"


def singular(seed, values):
    rng = np.random.default_rng(seed)
    d = len(values)
    left, right = (np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(2))
    return left @ np.diag(values) @ right


RNG = np.random.default_rng(5)
MATRICES = {
    "plain": RNG.normal(size=(40, 40)), "wide": RNG.normal(size=(130, 130)), "one": np.array([[-2.0]]), "two": RNG.normal(size=(2, 2)),
    "identity": np.eye(12), "graded": singular(1, 10.0 ** -np.arange(14)), "reversed": np.diag(10.0 ** np.arange(-12, 0)),
    "multiple": singular(2, [3, 3, 3, 2, 2, 1, 1, 1, 1, 1]), "close": singular(3, [*(3 + 1e-9 * np.arange(6)), *np.ones(14)]),
    "rank 3": singular(4, [5, 4, 3] + [0] * 17), "equal": np.full((6, 6), 2.0), "tiny": 1e-150 * RNG.normal(size=(9, 9)),
    "wilkinson": np.diag(np.abs(np.arange(-10, 11)) + 1.0) + np.diag(np.ones(20), 1),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver_against_numpy(name):
    a = MATRICES[name]
    s, v = S.leading(a, 8)
    want = np.linalg.svd(a)[1]
    want = want[want > len(a) * S.EPS * want[0]][:8]
    assert len(s) == len(want) and np.allclose(s, want, rtol=0, atol=1e-13 * want[0])
    assert np.abs(v @ v.T - np.eye(len(s))).max() < 1e-11
    unit = a / want[0]
    assert np.abs((unit.T @ (unit @ v.T)).T - (s / want[0])[:, None] ** 2 * v).max() < 1e-13


def test_small_values_keep_their_digits():
    """dqds on a graded bidiagonal: every value to high relative accuracy."""
    a, b = 10.0 ** -np.arange(0, 16, 2.0), 10.0 ** -np.arange(1, 15, 2.0) / 3
    exact = [float(x) for x in _exact_values(a, b)]
    assert np.allclose(np.sqrt(S.dqds(a ** 2, b ** 2)), exact, rtol=1e-13, atol=0)


def _exact_values(a, b):
    """Singular values by bisection on exact Sturm counts of the qd array."""
    from fractions import Fraction as R
    q, e = [R(x) ** 2 for x in a], [R(x) ** 2 for x in b]

    def below(t):
        count, d = 0, q[0] - t
        for i in range(len(q)):
            count += d + (e[i] if i < len(e) else 0) < 0
            if i + 1 < len(q):
                d = q[i + 1] * d / (d + e[i]) - t if d + e[i] else q[i + 1] - t
        return count

    for k in reversed(range(len(q))):
        lo, hi = R(0), 4 * (max(q) + max(e))
        for _ in range(400):
            mid = (lo + hi) / 2
            mid = R(float(mid)) if lo < R(float(mid)) < hi else mid
            if below(mid) > k:
                hi = mid
            else:
                lo = mid
            if hi - lo <= lo * R(1, 10 ** 15):
                break
        yield float(hi) ** 0.5


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "y") for i, v in rows], SCHEMA).repartition(3)


def rows(seed=1, n=300, d=12):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * 0.6 ** np.arange(d)
    out = [(i, (rng.normal(size=d) @ mix).astype(np.float32).tolist()) for i in range(n)]
    return out + [(900, None), (901, [None] * d), (902, [float("nan")] * d), (903, [float("inf")] + [0.0] * (d - 1)),
                  (None, out[0][1]), (5, out[1][1]), (904, []), (905, [0.5, -0.25])]


def whole(data, d):
    good = [(i, v) for i, v in data if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in (list(v) + [0.0] * d)[:d]] for _, v in good], object)
    return [i for i, _ in good], x


def query(spark, data, folder):
    frame(spark, data).write.parquet(f"{folder}/embeddings.parquet")
    return W.op12_whitening(spark, str(folder)).collect()


def test_query_against_eigenvectors(spark, tmp_path):
    data = rows()
    ids, x = whole(data, 12)
    n = len(ids)
    off = x * n - x.sum(axis=0)
    centred = off.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = query(spark, data, tmp_path)
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert {r.component for r in got} == set(range(1, 9))
    for k in range(8):
        mine = sorted(((str(r.vec_id), r.deviation, r.whitened) for r in got if r.component == k + 1))
        want = sorted(zip(map(str, ids), (off * off).sum(axis=1).tolist(), (centred @ vectors[:, k] / np.sqrt(values[k])).tolist()))
        assert [m[:2] for m in mine] == [w[:2] for w in want]
        a, b = np.array([m[2] for m in mine]), np.array([w[2] for w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        share = {r.explained for r in got if r.component == k + 1}
        assert len(share) == 1 and share.pop() == pytest.approx(values[k] / values.sum(), rel=1e-9)
    assert {r.identity_error for r in got} and max(r.identity_error for r in got) < 1e-9


@pytest.mark.parametrize("data", [[], [(1, None)], [(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(5)], [(1, []), (2, [])]])
def test_no_variance_no_rows(spark, tmp_path, data):
    assert query(spark, data, tmp_path) == []


def test_few_rows_and_blocks_of_one(spark):
    """Fewer rows than dimensions, and factors stacked over many rounds."""
    data = rows(2, 7, 12)[:7]
    v = W.usable(frame(spark, data).repartition(7))
    model = W.fit(v, depth=1, fan=2)
    centred = np.array(whole(data, 12)[1], float)
    centred -= centred.mean(axis=0)
    want = np.linalg.svd(centred)[1][:6] ** 2 / 7
    assert len(model.variances) == 6 and np.allclose(model.variances, want, rtol=1e-9)
    out = W.whitened(v, model)
    assert W.identity_error(out, 6) < 1e-9


def test_huge_entries_stay_exact(spark):
    """Products beyond 64 bits: exact sums, deviations held at the border."""
    data = [(i, v) for i, v in enumerate([[1e9, 0.0], [-1e9, 1.0], [3e38, 2.0], [0.0, -3e38]])]
    v = W.usable(frame(spark, data))
    n, totals = W.sums(v)
    x = [[min(max(int(np.floor(1024 * float(np.float32(c)))), -W.LIMIT), W.LIMIT) + 100_000 for c in r] for _, r in data]
    assert n == 4 and totals == [sum(c) for c in zip(*x)]
    out = {r.vec_id: r for r in W.whitened(v, W.fit(v)).collect()}
    for i, r in enumerate(x):
        assert out[i].deviation == min(sum((4 * a - s) ** 2 for a, s in zip(r, totals)), W.LONG)
        assert np.isfinite(out[i].w).all()
