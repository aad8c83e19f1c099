from collections import Counter

import pytest
import tokenizers

import corpus_pipeline as C
from riskmart.llm import mixing, packing
from riskmart.llm import toxicity as tox
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_substrings import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def steps(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        out.append(C.stored(stage(spark, out[-1], sf_small), "test-pipeline"))
    return out


def rows(frame):
    return [tuple(r) for r in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_all_but_the_last_keep_the_columns(steps):
    assert [n for n, _ in C.STAGES] == ["toxicity", "simhash", "substrings", "mixing", "packing"]
    assert all(s.dtypes == steps[0].dtypes for s in steps[:-1])


def test_toxicity_keeps_what_the_operator_accepts(spark, sf_small, steps):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    model = tox.fit(steps[0].where(~tox.held_out(5, 0)), labels.where(~tox.held_out(5, 0)))
    good = {r.doc_id for r in tox.scored(steps[0], model).where("score < 0.5").collect()}
    assert sorted(rows(steps[1])) == sorted(r for r in rows(steps[0]) if r[0] in good)
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    kept = {r[0] for r in rows(steps[1])}
    assert len(toxic - kept) >= 0.8 * len(toxic) and len(kept) >= 0.85 * len(rows(steps[0]))


def test_simhash_keeps_the_smallest_of_each_class(steps):
    before = rows(steps[1])
    leaders = {c for _, _, c in brute_components([r[:2] for r in before])}
    assert sorted(rows(steps[2])) == sorted(r for r in before if r[0] in leaders)


def test_substrings_cut_repeated_windows(steps):
    before = {r[0]: r for r in rows(steps[2])}
    want = {}
    for d, n, gone, kept in brute([r[:2] for r in before.values()], 50):
        if not gone:
            want[d] = before[d]
        elif gone < n:
            want[d] = (d, kept, *before[d][2:4], len(kept))
    assert {r[0]: r for r in rows(steps[3])} == want


def test_mixing_repeats_rows(steps):
    plan = {r.doc_id: r.repeats for r in mixing.planned(steps[3]).collect()}
    want = Counter()
    for r in rows(steps[3]):
        want[r] += plan[r[0]]
    assert Counter(rows(steps[4])) == +want


def test_packing_holds_every_piece(steps):
    whole = tokenizers.Tokenizer.from_file(packing.vocabulary_path())
    bins, tokens = check([r[:2] for r in rows(steps[4])], steps[5].collect(), whole, 2048)
    assert bins <= tokens / 2048 * 1.02 + 1


def test_run_equals_the_stages(spark, sf_small, steps):
    assert Counter(map(tuple, C.run(spark, sf_small).collect())) == Counter(map(tuple, steps[-1].collect()))


def test_awkward_rows(spark, sf_small):
    data = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b", None, "s", 3), (3, "a b", None, "s", 3),
            (None, "a b", "en", None, 3), (None, None, None, None, None), (4, "w " * 30000, "en", "s", 60000)]
    docs = spark.createDataFrame(data, SCHEMA)
    for _, stage in C.STAGES[:-1]:
        docs = C.stored(stage(spark, docs, sf_small), "test-awkward")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert C.packing(spark, docs, sf_small).count() > 0
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in C.STAGES:
        empty = stage(spark, empty, sf_small) if empty.columns[0] == "doc_id" else empty
    assert empty.count() == 0


def test_fingerprint_helper():
    assert brute_fingerprint(None) == 0
