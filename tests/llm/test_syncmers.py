import hashlib
import random

import pytest
import xxhash

from riskmart.llm import syncmers as S

SCHEMA = "doc_id long, text string, lang string, edited string, _k string"


def run(spark, rows, **k):
    return S.fingerprinted(spark.createDataFrame([(d, t, None, "x", "y") for d, t in rows], SCHEMA), **k).collect()


def long_hash(values, seed=42):
    """Spark's xxhash64 over strings and longs: each value's hash seeds the next."""
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & (2**64 - 1)).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute_anchors(text, k=9, s=2):
    words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
    h = [long_hash([w]) for w in words]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    if len(words) < k:
        return [signed(long_hash(h) << 16 & (2**64 - 1))] if words else []
    out, before = [], None
    for i in range(len(words) - k + 1):
        inner = [long_hash(h[j:j + s]) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            gap = 0 if before is None else min(i - before, 65535)
            out.append(signed((long_hash(h[i:i + k]) << 16 & (2**64 - 1)) | gap))
            before = i
    return out


def brute(rows):
    def key(row):
        t = long_hash([row[1] or ""])
        return (row[0] is not None, row[0] if row[0] is not None else -(t % (1 << 20)), t)
    ordered = sorted(rows, key=key, reverse=True)
    texts = [t or "" for _, t in ordered]
    like = lambda a, b: 1.0 if not a and not b else 2.0 * len(set(a) & set(b)) / (len(set(a)) + len(set(b)))
    hexed = lambda a: " ".join(f"{x & (2**64 - 1):x}" for x in a)
    out = []
    for i, (d, _) in enumerate(ordered):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, new, nxt = map(brute_anchors, (text, edited, after))
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(own), hexed(new),
                    like(own, new), like(own, nxt)))
    return sorted(out, key=str)


def got(rows):
    return sorted(((r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest(), r.fingerprint,
                    r.edited_fingerprint, r.near_edited, r.near_next) for r in rows), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(50)] + ["É", "a\xa0b", "\U0001F600"]
    ids = rng.sample(range(-50, 10 * n), n)
    return [(i, rng.choice([" ", "\n\t"]).join(rng.choices(words, k=rng.choice([0, 1, 8, 9, 10, 40, 200])))) for i in ids]


@pytest.mark.parametrize("bucket", [1024, 4, 1])
def test_matches_brute_force(spark, bucket):
    rows = corpus(bucket, 60) + [(5000, None), (5001, ""), (5002, " \n "), (None, "no id"), (None, "no id two"),
                                 (5003, "twice"), (5003, "twice")]
    assert got(run(spark, rows, bucket=bucket)) == brute(rows)


def test_far_apart_ids(spark):
    rows = [(2**62, "a b c d e f g"), (-2**62, "g f e d c b a"), (0, "a b c d e f x"), (7, None)]
    assert got(run(spark, rows)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "one row of its own text")], [(None, None)]])
def test_tiny_tables(spark, rows):
    assert got(run(spark, rows)) == brute(rows)


def test_likeness_follows_the_edit(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(300))) for i in range(20)] + [(30, "s"), (31, "s")]
    out = {r.doc_id: r for r in run(spark, rows)}
    assert all(0.35 < out[i].near_edited < 0.65 and out[i].near_next == 0 for i in range(1, 20))
    assert out[31].near_next == 1.0 and out[31].fingerprint == out[30].fingerprint


def test_an_outlier_and_a_hot_id_leave_no_large_bucket(spark):
    rows = [(i, f"t {i}") for i in range(1000)] + [(2 ** 50, "far")] + [(700, f"hot {i}") for i in range(600)] + [(None, f"n {i}") for i in range(300)]
    rows += [(900, "same text")] * 50
    frame = spark.createDataFrame([(d, t, None, "x", "y") for d, t in rows], SCHEMA)
    out, _ = S.in_order(frame, 64)
    sizes = [r["count"] for r in out.where("_ghost = 0").groupBy("_b").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 2 * 64
    assert got(run(spark, rows, bucket=64)) == brute(rows)
    assert got(run(spark, rows[:300], bucket=1)) == brute(rows[:300])      # more borders than are looked through at once


def test_anchors_are_sparse(spark):
    """About a quarter of all places, and fingerprints well below the texts."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(4000)]
    rows = [(i, " ".join(rng.choices(words, k=2000))) for i in range(12)]
    out = run(spark, rows)
    anchors = sum(len(r.fingerprint.split()) for r in out)
    assert 0.2 < anchors / (12 * 1992) < 0.3
    assert sum(len(r.fingerprint) for r in out) < 0.7 * sum(len(t) for _, t in rows)


def test_plan_has_no_python(spark, sf_small):
    plan = S.op5_syncmers(spark, sf_small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
