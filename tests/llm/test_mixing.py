import random

import duckdb
import pytest

from pyspark.sql import functions as F

from riskmart.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, None, s, 0, "x") for d, t, s in rows], SCHEMA)


def fixture(seed=3, n=300):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 400])), rng.choice(["a", "a", "a", "b", "c", "Z", "é", None]))
            for i in range(n)]
    return rows + [(n, None, "a"), (n + 1, "", "only-empty"), (7, "one two", "b"), (None, "x y", "c")]


def brute_targets(rows):
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    free, target, pool = set(names), {}, 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if pool * weight[s] / total >= 2 * sizes[s]]
        if not over:
            target |= {s: pool * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            pool -= 2 * sizes[s]
            free.remove(s)
    return sizes, target


def test_targets_and_taken(spark):
    rows = fixture()
    sizes, target = brute_targets(rows)
    out = M.planned(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    source = {d: s for d, _, s in rows}
    taken, largest = {}, {}
    for r in out:
        s = source[r.doc_id] if r.doc_id not in (7,) else None
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.repeats
    by_size = {}
    for r in out:
        by_size.setdefault((r.source_size, round(r.target, 6)), []).append(r)
    assert sorted(by_size) == sorted({(sizes[s], round(target[s], 6)) for s in sizes})
    for (size, t), rs in by_size.items():
        assert abs(sum(r.taken for r in rs) - t) <= max([1, *(r.size for r in rs)]) / 2 + 1


def test_reruns_and_mix_agree(spark):
    frame = docs(spark, fixture(5))
    first = sorted(map(tuple, M.planned(frame).fillna(-1).collect()))
    assert first == sorted(map(tuple, M.planned(frame.repartition(7)).fillna(-1).collect()))
    mix = M.mixed(frame)
    assert mix.columns == frame.columns
    assert mix.count() == sum(r[4] for r in first)


def test_sql_agrees(spark):
    rows = fixture(9)
    frame = docs(spark, rows)
    con = duckdb.connect()
    con.register("documents", frame.drop("size").toArrow())
    want = con.execute(M.OP7_SQL).fetchall()
    got = M.planned(frame).select("doc_id", "size", "source_size", "target", "taken").collect()
    key = lambda r: (r[0] is None, *[-1 if x is None else x for x in r])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a", "s")]])
def test_tiny_tables(spark, rows):
    out = M.planned(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    assert all(r.target <= 2 * r.source_size for r in out)


def test_many_large_sources_do_not_overflow(spark):
    """Sums and weights whose products need more than 64 bits."""
    sizes = spark.range(5000).select(F.concat(F.lit("s"), F.col("id")).alias("source"), (F.col("id") + 10 ** 13).alias("source_size"),
                                     (F.col("id") % 3 * 1000 + 1).alias("weight"))
    out = M.water_fill(sizes)
    total, clamped = out.agg(F.sum("target"), F.max(F.col("target") / F.col("source_size"))).first()
    want = 1.5 * sum(i + 10 ** 13 for i in range(5000))
    assert abs(total - want) < 1e-6 * want and clamped <= 2


def test_equal_rows_at_the_border(spark):
    """Rows that agree in everything but a column that plays no part: as many are taken once more as the plan says."""
    data = [(1, "a b c", "x", i) for i in range(10)] + [(2, "d e f g", "x", 100), (3, "h", "y", 101)]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string, k int")
    taken = M.planned(frame).groupBy("doc_id").agg(F.sum("repeats")).collect()
    mix = M.mixed(frame).collect()
    assert {r[0]: r[1] for r in taken} == {d: sum(m.doc_id == d for m in mix) for d in (1, 2, 3)}
    per_row = [sum(m.k == k for m in mix) for k in range(10)]
    assert max(per_row) - min(per_row) == 1 and M.mixed(frame).collect() and sorted(per_row) == sorted(
        sum(m.k == k for m in M.mixed(frame).collect()) for k in range(10))
