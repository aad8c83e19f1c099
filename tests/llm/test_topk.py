import duckdb
import numpy as np
import pytest

from riskmart.llm import topk as T
from riskmart.llm.common import stored

SCHEMA = "vec_id long, embedding array<float>, label int, q string, c string"


def brute(rows, k=5):
    good = [(at, i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for at, (i, v) in enumerate(rows)
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, i, a in good:
        if i % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), j) for of, j, b in good if of != at)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def rows(seed, n, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.2, (5, d))
    out = [(i, (centres[i % 5] + rng.normal(0, 0.05, d)).astype(np.float32).tolist()) for i in range(n)]
    return out + [(9000, None), (9050, [None] * d), (9100, [float("nan")] + [0.1] * (d - 1)),
                  (9150, [float("inf")] + [0.1] * (d - 1)), (None, out[0][1]), (9200, out[0][1]),
                  (9201, out[0][1]), (9202, out[0][1]), (9250, [0.5, 0.25]), (9300, [0.0] * d), (9350, [])]


def numbered(spark, data):
    return stored(T.quantised(frame(spark, data)), "topk-test")


@pytest.mark.parametrize("block", [8192, 37, 3])
def test_matches_brute_force(spark, block):
    """Query ids that repeat, with equal and other vectors: a ranking each, and each a candidate of the other."""
    data = rows(1, 400)
    data += [(50, data[7][1]), (50, data[7][1]), (100, data[100][1]), (100, [0.5])]
    v = numbered(spark, data)
    got = T.top_k(v, v.where("vec_id % 50 = 0"), 5, block).collect()
    assert sorted(map(tuple, got)) == brute(data)


def test_stops_early_and_stays_exact():
    rng = np.random.default_rng(3)
    block = np.floor(256 * rng.normal(0, 0.12, (4000, 64)))
    index = T.ImpactIndex(np.arange(4000), block)
    for q in range(0, 4000, 400):
        ids, scores = index.search(block[q], q)
        exact = block @ block[q]
        exact[q] = -np.inf
        want = np.lexsort((np.arange(4000), -exact))[:5]
        assert ids.tolist() == want.tolist() and scores.tolist() == exact[want].tolist()


def test_sql_agrees(spark):
    data = [r for r in rows(2, 220) if r[0] is None or r[0] < 9250]
    data += [(50, data[3][1]), (100, data[100][1])]
    con = duckdb.connect()
    con.register("embeddings", frame(spark, data).toArrow())
    assert sorted(con.execute(T.OP10_SQL).fetchall()) == brute(data)


@pytest.mark.parametrize("data", [[], [(0, [1.0, 2.0])], [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (51, [0.25])], [(0, [])], [(0, [1.0]), (0, [1.0])]])
def test_tiny_tables(spark, data):
    v = numbered(spark, data)
    got = T.top_k(v, v.where("vec_id % 50 = 0")).collect()
    assert sorted(map(tuple, got)) == brute(data)


def test_large_impacts_keep_ties(spark):
    """Impacts above the exact range are rounded up; a vector tied at the threshold is still rescored."""
    rng = np.random.default_rng(9)
    block = np.floor(rng.normal(0, 1, (600, 8)) * 2 ** 19)
    block[100:140] = block[7]
    index = T.ImpactIndex(np.arange(600), block)
    exact = block @ block[7]
    exact[7] = -np.inf
    want = np.lexsort((np.arange(600), -exact))[:5]
    ids, scores = index.search(block[7], 7)
    assert ids.tolist() == want.tolist() and scores.tolist() == exact[want].tolist()
