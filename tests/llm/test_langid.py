import random
import zlib

import numpy as np

from riskmart.llm import langid as L

SCHEMA = "doc_id long, text string, lang string, source string, score string, accepted string"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, g, "s", "x", "y") for d, t, g in rows], SCHEMA)


def corpus(n, seed=1):
    rng = random.Random(seed)
    parts = {"de": ["sch", "ung", "ein", "über", "keit"], "en": ["the", "tion", "ing", "ed", "wh"],
             "fr": ["eau", "eux", "qué", "ment", "ier"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(parts))
        words = ["".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 80))]
        rows.append((i, " ".join(words).capitalize(), lang))
    return rows


def test_held_out_accuracy_and_rejection(spark):
    frame = docs(spark, corpus(600))
    model = L.fit(frame.where(~L.held_out(4, 2)))
    out = {r.doc_id: r for r in L.predicted(frame, model).collect()}
    held = [(d, g) for d, _, g in corpus(600) if zlib.crc32(str(d).encode()) % 4 == 2]
    assert sum(out[d].lang_pred == g for d, g in held) >= 0.97 * len(held)
    sure = [(d, g) for d, g in held if out[d].accepted]
    assert len(sure) >= 0.8 * len(held) and sum(out[d].lang_pred == g for d, g in sure) >= 0.97 * len(sure)
    again = {r.doc_id: r for r in L.predicted(frame.repartition(5), L.fit(frame.where(~L.held_out(4, 2)))).collect()}
    assert all(out[d].lang_pred == again[d].lang_pred and abs(out[d].score - again[d].score) < 1e-9 for d in out)


def test_driver_table(spark, sf_small):
    out = L.op4_langid(spark, sf_small).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    held = [r for r in out if r.held_out]
    assert len(out) == len(truth) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)


def test_cases(spark):
    rows = corpus(90) + [(900, None, "en"), (901, "", None), (902, "12 ²½ !!_", "de"), (903, "x", None), (904, "中文", None),
                         (None, "the tion", "en"), (905, "the " * 30000, "en"), (905, "the " * 30000, "en")]
    model = L.fit(docs(spark, rows))
    out = [r for r in L.predicted(docs(spark, rows), model).collect()]
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[902].score == 0 and not by[902].accepted
    assert by[903].lang_pred in model.languages and by[904].lang_pred in model.languages
    assert by[905].lang_pred == "en" and all(0 <= r.score <= 1 for r in out)


def test_nothing_to_learn(spark):
    rows = [(1, "some text", None)]
    assert [r.lang_pred for r in L.predicted(docs(spark, rows), L.fit(docs(spark, rows))).collect()] == ["und"]
    assert L.predicted(docs(spark, []), L.fit(docs(spark, []))).collect() == []


def test_ngrams_stay_in_their_word_and_text():
    texts = [b"ab", b"", b"Cd e", b"f"]
    offsets = np.cumsum([0, *map(len, texts)])
    joined = L.ngrams(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for k in range(2):
        for i, t in enumerate(texts):
            alone = L.ngrams(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[k][0]
            assert joined[k][0][joined[k][1] == i].tolist() == alone.tolist()


def test_every_language_is_learned(spark):
    """Above the number of languages with full samples, and above that of the dimensions."""
    assert L.fit(docs(spark, corpus(300)), languages=2).languages == ["de", "en", "fr"]
    rng = random.Random(3)
    stems = {f"l{k:02d}": [chr(97 + k) + a + b for a in "aeiou" for b in "nrs"] for k in range(20)}
    rows = [(100 * k + i, " ".join(rng.choices(stems[lang], k=40)), lang) for k, lang in enumerate(stems) for i in range(40)]
    model = L.fit(docs(spark, rows), languages=2)
    out = L.predicted(docs(spark, rows), model).collect()
    truth = {d: lang for d, _, lang in rows}
    assert model.languages == sorted(stems) and sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.97 * len(rows)


def test_a_repeated_doc_id_leaves_the_others_in_the_sample(spark):
    """Copies of one id neither fill the ranks of its own language nor the rows of those after it."""
    rows = corpus(300)
    hot = [(0, "ein ung schkeit", "de")] * 3000
    seen = []
    keep, L.train = L.train, lambda found, *a: seen.append(sorted(lang for lang, _, _ in found)) or keep(found, *a)
    try:
        for frame in (rows, rows + hot):
            L.fit(docs(spark, [r for r in frame if r[0] or r in hot] + hot[:1]), per_language=50)
    finally:
        L.train = keep
    assert seen[0] == seen[1] == ["de"] * 50 + ["en"] * 50 + ["fr"] * 50


def test_a_batch_steps_as_its_texts_one_by_one():
    rng = np.random.default_rng(2)
    buckets = [np.sort(rng.choice(300, n, replace=False)) for n in (0, 1, 40, 250, 300)]
    share = [rng.random(len(b)) / max(1, len(b)) for b in buckets]
    embedding, weight, bias = rng.normal(0, 0.1, (500, 16)), rng.normal(0, 0.3, (16, 3)), np.zeros(3)
    target, importance = np.array([0, 1, 2, 0, 1]), rng.random(5) + 0.5
    x = np.array([s @ embedding[b] for s, b in zip(share, buckets)])
    error = L.softmax(x @ weight + bias)
    error[np.arange(5), target] -= 1
    error *= importance[:, None]
    want = embedding.copy()
    for s, b, g in zip(share, buckets, error @ weight.T):
        want[b] -= 0.1 * np.minimum(s * 200, 1)[:, None] * g
    new_weight, new_bias = weight - 0.1 * x.T @ error / 5 * 8, bias - 0.1 * error.mean(axis=0)
    L._step(embedding, weight, bias, buckets, share, target, importance, 0.1)
    assert np.allclose(embedding, want, atol=1e-12) and np.allclose(weight, new_weight, atol=1e-12) and np.allclose(bias, new_bias, atol=1e-12)
