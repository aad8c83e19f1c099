import random
import zlib
from collections import Counter

import numpy as np
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from riskmart.llm import packing as P

SCHEMA = "doc_id long, text string, lang string, source string, length string"


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(P.vocabulary_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aA'sSdlé ÉßİıſŉσςΣ\n\t\x85\xa0\x1će1٣.!<|>_中\U0001F600"),
                                  st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_equal_the_tokenizer(text):
    words = P.Words(P.vocabulary_path())
    whole = tokenizers.Tokenizer.from_file(P.vocabulary_path()) if not hasattr(P, "_t") else P._t
    P._t = whole
    assert np.frombuffer(words.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_special_tokens_and_memory(tokenizer):
    words = P.Words(P.vocabulary_path(), memory=3)
    text = "Don't <|endoftext|> a<|endoftext|>b I'LL we've x_1 a b c d e f g a b c d e f g"
    for _ in range(2):
        assert np.frombuffer(words.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_places_every_piece_once(histogram):
    kinds = P.plan(histogram, 60)
    total = Counter()
    for times, kind in kinds:
        assert sum(n * c for n, c in kind.items()) <= 60
        assert sum(c for n, c in kind.items() if 3 * n > 60) <= 2
        for n, c in kind.items():
            total[n] += times * c
    assert total == Counter(histogram)
    # First-fit decreasing never needs more than 11/9 of the best plus one; the best is at least the filled volume.
    bins = sum(times for times, _ in kinds)
    volume = -(-sum(n * c for n, c in histogram.items()) // 60)
    assert bins >= volume


def fewest(sizes, capacity):
    """The least possible number of bins, by trying every place of every piece."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= sizes[i]}):
            k = rooms.index(room)
            put(i + 1, [*rooms[:k], room - sizes[i], *rooms[k + 1:]])
        put(i + 1, [*rooms, capacity - sizes[i]])

    put(0, [])
    return best[0]


def test_plan_against_the_least_possible_number_of_bins():
    rng, over = random.Random(5), Counter()
    for _ in range(400):
        top = rng.choice([15, 30, 60])
        sizes = [rng.randint(1, top) for _ in range(rng.randint(1, 9))]
        over[sum(times for times, _ in P.plan(Counter(sizes), 60)) - fewest(sizes, 60)] += 1
    assert set(over) <= {0, 1} and over[0] >= 380


def check(rows, out, tokenizer, capacity):
    want = Counter()
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k:k + capacity], "<u4")
            want[d, k // capacity, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for r in out)


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_packs_whole_texts(spark, tokenizer, capacity):
    rng = random.Random(capacity)
    rows = [(i, " ".join(rng.choices(["the", "Über", "zxq", "a,b", "1234"], k=rng.choice([1, 3, 30, 400]))))
            for i in range(150)]
    rows += [(500, None), (501, ""), (502, "  \n "), (503, "x"), (503, "x"), (None, "y"), (504, "word " * 5000)]
    docs = spark.createDataFrame([(d, t, None, "s", "x") for d, t in rows], SCHEMA)
    bins, tokens = check(rows, P.packed(docs, capacity).collect(), tokenizer, capacity)
    if capacity >= 64:
        assert bins <= tokens / capacity * 1.03 + 1


def test_empty_table(spark):
    assert P.packed(spark.createDataFrame([], SCHEMA)).collect() == []
