import random

import numpy as np
import pytest
import xxhash

from riskmart.llm import simhash as S

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).translate(
        {c: " " for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d, f"{fps[i]:016x}", least.get(root(i))) for i, (d, _) in enumerate(rows) if d is not None)


def result(spark, rows, **k):
    docs = spark.createDataFrame([(d, t, None, "s", 0) for d, t in rows], SCHEMA)
    return sorted((r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in S.classes(docs, **k).collect()
                  if r.doc_id is not None)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "A", "İx"]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((i, " ".join(words)))
        else:
            rows.append((i, rng.choice(["\n", " "]).join(rng.choices(vocabulary, k=rng.randint(1, 300)))))
    return rows


def test_matches_brute_force(spark):
    rows = corpus(1, 120) + [(500, None), (501, ""), (502, " \t\x0b\x0c "), (503, "One TWO"), (504, "one two"),
                             (504, "one two"), (None, "one two"), (505, "a\xa0b c d e f")]
    assert result(spark, rows) == brute_components(rows)


def test_large_groups_are_dealt_in_parts(spark):
    rows = corpus(2, 80)
    assert result(spark, rows, group=3, blocks=5) == brute_components(rows)


def test_empty_table(spark):
    assert result(spark, []) == []


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_pairs_connect_like_brute_force(radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 6).astype(np.uint64)
    fps, group = [], []
    for g, size in enumerate((1, 2, 63, 64, 65, 200)):
        for _ in range(size):
            fp = int(centres[g])
            for bit in rng.integers(0, 64, rng.integers(0, 6)):
                fp ^= 1 << int(bit)
            fps.append(fp)
            group.append(g)
    a, b = S.close_pairs(np.array(fps, np.uint64), np.array(group), radius)

    def parts(pairs):
        label = list(range(len(fps)))
        def root(i):
            while label[i] != i:
                i = label[i]
            return i
        for i, j in pairs:
            label[max(root(i), root(j))] = min(root(i), root(j))
        return [root(i) for i in range(len(fps))]
    want = [(i, j) for i in range(len(fps)) for j in range(i)
            if group[i] == group[j] and (fps[i] ^ fps[j]).bit_count() <= radius]
    assert all((fps[i] ^ fps[j]).bit_count() <= radius and group[i] == group[j] for i, j in zip(a, b))
    assert parts(want) == parts(list(zip(a.tolist(), b.tolist())))
    assert len(a) < len(fps)


@pytest.mark.parametrize("size", [2, 63, 64, 65])
def test_empty_lanes_are_nobody(size):
    """Fingerprints 0 and 1 are within the radius of an empty lane, but not of other groups or of what lies past the end."""
    far = [(0xFFFF << 40) ^ (i * 0x11111) for i in range(size - 2)]
    fps, group = [], []
    for g, members in enumerate([[2**60 - 1, 2**59 - 1], [0, 1, *far], [2**50 - 1, 2**49 - 1], [0, 1, *far]]):
        fps += members
        group += [g] * len(members)
    a, b = S.close_pairs(np.array(fps, np.uint64), np.array(group), 4)
    assert all((fps[i] ^ fps[j]).bit_count() <= 4 and group[i] == group[j] and i < j for i, j in zip(a.tolist(), b.tolist()))
    firsts = [group.index(g) for g in range(4)]
    assert {(i, i + 1) for i in firsts} <= set(zip(a.tolist(), b.tolist()))


def test_rows_of_one_id_and_text_are_chosen_by_their_other_columns(spark):
    data = [(1, "a b c d", "z", 9), (1, "a b c d", "m", 3), (1, "a b c d", "m", 2), (None, "a b c d", "a", 0), (2, "x", None, None),
            (2, "x", "q", None)]
    for order in (data, data[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, others string, row long").repartition(4)
        got = sorted(tuple(r) for r in S.one_of_each(docs).select("doc_id", "others", "row").collect())
        assert got == [(1, "m", 2), (2, "q", None)]
