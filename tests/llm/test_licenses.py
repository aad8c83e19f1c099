import math
import random
import re

import pytest

from riskmart.llm import licenses as L

SCHEMA = "doc_id long, text string, lang string, words string, at string"


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base(text):
    words = words_of(text)
    places = {n.label: [i for i in range(len(words)) if words[i:i + len(n.words)] == n.words] for n in L.BASE}
    every = sorted(p for ps in places.values() for p in ps)
    return (len(words), len(every), every[0] if every else None, every[-1] if every else None,
            ",".join(sorted(k for k, ps in places.items() if ps)))


def scan(spark, rows):
    return L.scanned(spark.createDataFrame([(d, t, None, "x", "y") for d, t in rows], SCHEMA)).collect()


def test_base_columns_match_brute_force(spark):
    rng = random.Random(1)
    pool = ["CC", "by", "-", "nc", "all", "Rights", "reserved.", "General", "Public", "License", "é", "the", "rİghts",
            "All rights reserved", "general public license", "cc by", "K", "\n", "general public", "x_y"]
    rows = [(i, rng.choice([" ", "\n", "-"]).join(rng.choices(pool, k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, " .,;"), (903, "cc by " * 3000), (903, "cc by"), (None, "cc by")]
    out = scan(spark, rows)
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out), key=str)
    assert got == sorted(((d, *base(t)) for d, t in rows), key=str)
    for r in out:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.labels == ",".join(sorted(set(r.labels.split(",")))) and 0 <= r.score <= 1


def brute(rows, notices):
    """Every start of every notice, without an index: labels, score and places."""
    docs = [words_of(t) for _, t in rows]
    df = {w: sum(w in d for d in map(set, docs)) for n in notices for w in n.words}
    idf = {w: math.log((len(docs) + 1) / (c + 1)) + 1 for w, c in df.items()}
    out = []
    for words in docs:
        found = []
        for n in notices:
            of, key = n.words, n.key.split()
            total = sum(idf[w] for w in of)
            for s in range(len(words)):
                if words[s + n.key_at:s + n.key_at + len(key)] != key:
                    continue
                share = 0.0
                for i, w in enumerate(of):
                    share += idf[w] / total if s + i < len(words) and words[s + i] == w else 0.0
                share = 1.0 if n.base else min(1.0, share)
                if share >= L.SHARE:
                    found.append((n.label, s, len(of), share))
        out.append((",".join(sorted({f[0] for f in found})), max((f[3] for f in found), default=0.0), sorted(found)))
    return out


def test_labels_and_score_match_brute_force(spark):
    """Whole, damaged, cut and overlapping notices between other words; licence words in other orders."""
    rng = random.Random(6)
    pool = sorted({w for n in L.ALL for w in n.words}) + ["plain", "words", "été"]
    rows = [(1000, None), (1001, ""), (1002, "cc by " * 200)]
    for i in range(250):
        words = rng.choices(pool, k=rng.randint(0, 20))
        for n in rng.choices(L.ALL, k=rng.randint(0, 3)):
            part = [rng.choice(pool) if rng.random() < rng.choice([0, 0.05, 0.3]) else w for w in n.words]
            words += part[rng.choice([0, 0, 0, 1]):] + rng.choices(pool, k=rng.randint(0, 3))
        rows.append((i, " ".join(words)))
    want = dict(zip([d for d, _ in rows], brute(rows, L.ALL)))
    assert len({w[0] for w in want.values()}) > 50
    for r in scan(spark, rows):
        labels, score, found = want[r.doc_id]
        assert r.labels == labels and r.score == pytest.approx(score, abs=1e-12)
        got = sorted((f.label, f.start, f.words, f.share) for f in r.found)
        assert [g[:3] for g in got] == [f[:3] for f in found] and [g[3] for g in got] == pytest.approx([f[3] for f in found])


def test_a_file_looks_up_its_rarest_words_only(spark):
    """Frequent words stay unread where no notice can stand; a word without second key word still reaches it."""
    idf = {w: 5.0 for n in L.BASE for w in n.words} | {"by": 1.0, "general": 2.0, "all": 0.5}
    assert L.reach(idf, L.BASE) == {"cc": 1.0, "license": 5.0, "reserved": 5.0}
    frame = spark.createDataFrame([("by all general".split(),), ("rights reserved by all".split(),), ("cc by all".split(),)],
                                  "words array<string>")
    got = [r[0] and sorted(r[0]) for r in frame.select(L._looked_up(idf, L.BASE)).collect()]
    assert got == [None, ["reserved", "rights"], ["by", "cc"]]


def test_notices(spark):
    rows = [(0, "Foo bar. Licensed under the Apache License, Version 2.0."), (1, "Released under the MIT License."),
            (2, "Licensed under CC BY-NC 4.0."), (3, "This work is licensed under the GNU General Public License, version 3."),
            (4, "All rights reserved."), (5, "an apache helicopter under the license of version 2"), (6, "nothing here"),
            (7, "licensed under THE apache license, version 3.0"), (8, "released and released by the mit")]
    rows += [(i, "plain words and more of the prose in the text") for i in range(10, 60)]
    out = {r.doc_id: r for r in scan(spark, rows)}
    assert [out[i].labels for i in range(9)] == [
        "apache-2.0", "mit", "cc-by,cc-by-nc-4.0", "gpl,gpl-3.0", "reserved", "", "", "apache-2.0", ""]
    assert out[0].score > 0.99 and out[6].score == 0 and L.SHARE <= out[7].score < 1
    assert [(f.label, f.start, f.words) for f in out[0].found] == [("apache-2.0", 2, 8)]


def test_empty_table(spark):
    assert scan(spark, []) == []


def test_plan_has_no_python(spark, sf_small):
    plan = L.op6_licenses(spark, sf_small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
