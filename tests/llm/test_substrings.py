import random

import duckdb
import pytest

from riskmart.llm import substrings as S
from riskmart.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, n_words string, spans string"


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    starts = {}
    for (d, _), ws in zip(rows, words):
        for i in range(len(ws) - window + 1):
            if d is not None:
                key = tuple(ws[i:i + window])
                starts[key] = min(d, starts.get(key, d))
    out = []
    for (d, _), ws in zip(rows, words):
        gone = set()
        for i in range(len(ws) - window + 1):
            if d is not None and starts[tuple(ws[i:i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((d, len(ws), len(gone), b" ".join(w for i, w in enumerate(ws) if i not in gone).decode()))
    return sorted(out, key=str)


def docs(spark, rows):
    return spark.createDataFrame([(d, t, None, "x", "y") for d, t in rows], SCHEMA)


def corpus(seed, window):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É.", "a\xa0b"]
    passages = [rng.choices(vocabulary, k=rng.randint(window, 3 * window)) for _ in range(4)]
    rows = []
    for i in range(90):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choices(vocabulary, k=rng.randint(0, window))
            if rng.random() < 0.6:
                words += rng.choice(passages)
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
        if rng.random() < 0.15:
            rows.append((i + 1000, rows[rng.randrange(len(rows))][1]))
    same = " ".join(["x"] * (4 * window))
    return rows + [(2000, None), (2001, ""), (2002, same), (2003, same), (2003, same), (2004, "p " + same + " q"),
                   (None, same), (5, same), (2004, "other text")]


@pytest.mark.parametrize("window,inner,bucket,size", [(10, 4, 4096, 1 << 21), (10, 4, 3, 1 << 21), (6, 6, 5, 1 << 21), (50, 8, 2, 1 << 21),
                                                      (50, 8, 4096, 1 << 21), (10, 4, 4096, 300)])
def test_matches_brute_force(spark, window, inner, bucket, size):
    rows = corpus(window + bucket, window)
    out = S.deduplicated(docs(spark, rows), window, inner, bucket, bucket_bytes=size)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept or "") for r in out.collect()), key=str)
    assert got == brute(rows, window)
    assert out.select("_row.*").columns == ["lang", "n_words", "spans"]
    assert {r.kept for r in out.collect() if r.doc_id == 2000} == {None}


HELPERS = ["row", "doc", "_row", "_null", "kept", "n_words", "n_removed", "spans", "small", "big", "h", "size", "a", "b", "salt", "digest"]


def test_columns_named_like_helpers(spark):
    """The stage keeps every column, whatever its name, and null texts."""
    rows = corpus(3, 10)
    named = spark.createDataFrame([(d, t, len(t or ""), *range(len(HELPERS))) for d, t in rows],
                                  "doc_id long, text string, n_chars int, " + ", ".join(f"{c} int" for c in HELPERS))
    out = S.without_repeats(named, window=10, inner=4, bucket=5)
    assert out.columns == named.columns
    want = [(d, n, g, k) for d, n, g, k in brute(rows, 10) if g == 0 or g < n]
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(w[0]) for w in want)
    assert all([r[c] for c in HELPERS] == list(range(len(HELPERS))) and r.n_chars == len(r.text or "") for r in got)
    assert {r.text for r in got if r.doc_id == 2000} == {None} and {r.text for r in got if r.doc_id == 2001} == {""}


def test_one_exchange_of_the_texts(spark):
    """The three text passes read one exchange (with other columns too)."""
    for frame in (docs(spark, corpus(5, 10)), docs(spark, corpus(5, 10)).select("doc_id", "text")):
        out = S.deduplicated(stored(frame, "exchange-test"), 10, 4, 5)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("ReusedExchange") >= 2


def test_a_long_repetitive_text(spark):
    """One minimiser, one super-k-mer as long as the text: its windows are never gathered as strings."""
    one, other = " ".join(["0"] * 200_000), " ".join(["0"] * 190_000)
    out = {r.doc_id: r for r in S.deduplicated(docs(spark, [(1, one), (2, other), (3, "x " * 60)]), bucket_bytes=1000).collect()}
    assert (out[1].n_removed, out[2].n_removed, out[3].n_removed) == (0, 190_000, 0)


def test_sql_agrees(spark):
    rows = [r for r in corpus(1, 50) if r[0] is not None and r[0] < 2000]
    rows = list(dict(rows).items())
    con = duckdb.connect()
    con.register("documents", docs(spark, rows).toArrow())
    want = sorted((d, n, g) for d, n, g, _ in con.execute(S.OP8_SQL).fetchall())
    assert want == sorted((d, n, g) for d, n, g, _ in brute(rows, 50))


def test_empty_table(spark):
    assert S.deduplicated(docs(spark, [])).collect() == []
