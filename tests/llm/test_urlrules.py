import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from riskmart.llm import urlrules as U

PAGES = "page_id long, url string, html string, host string, verdict int, rule string, tokens string, items string"
LABELS = "doc_id long, quality int, toxic int, n int, number string"


def parts(url):
    if url is None or "://" not in url:
        return "", "", "", "", ""
    scheme, rest = url.split("://", 1)
    rest, _, fragment = rest.partition("#")
    rest, _, query = rest.partition("?")
    host, slash, path = rest.partition("/")
    return scheme, host, slash + path, query, fragment


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tokens(url):
    out = set()
    for mark, text in zip("shpqf", parts(url)):
        words = re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text))
        out |= {mark + ":" + re.sub("[0-9]+", "#", w) for w in words if w}
    return sorted(out)


def listed(url):
    _, host, path, _, _ = parts(url)
    host, best = ascii_lower(host), None
    for verdict, rule in U.LIST:
        of, below = rule.split("/", 1)
        if (host == of or host.endswith("." + of)) and path.startswith("/" + below) and len(rule) > len(best[0] if best else ""):
            best = (rule, verdict)
    return best


def sure(bad, n, z=U.Z):
    p = bad / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def brute_rules(labelled, min_support, min_count):
    """{token set: (n, bad)} from the power set of every bad basket, with the operator's definition of a rule."""
    bad = [b for b, mark in labelled if mark]
    least = max(min_count, min_support * len(bad))
    where = {t: frozenset(i for i, b in enumerate(bad) if t in b) for b in bad for t in b}
    where = {t: w for t, w in where.items() if least <= len(w) and not all(t in b for b, _ in labelled)}
    same = {}
    for t, w in where.items():
        same.setdefault(w, set()).add(t)
    found = set()
    for b in set(map(tuple, bad)):
        units = [w for w in same if same[w] <= set(b)]
        for k in range(1, len(units) + 1):
            found |= {frozenset().union(*(same[w] for w in some)) for some in itertools.combinations(units, k)}
    out = {}
    for items in found:
        marks = [mark for b, mark in labelled if items <= set(b)]
        if sum(marks) >= least and sure(sum(marks), len(marks)) > len(bad) / len(labelled):
            out[items] = (len(marks), sum(marks))
    return {x: v for x, v in out.items() if not any(y < x and sure(w[1], w[0]) >= sure(v[1], v[0]) for y, w in out.items())}


def random_labelled(seed, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(["casino", "shop", "news"]), rng.choice(["win", "buy", "read"]), rng.choice("abc")]
        url = f"http{rng.choice(['', 's'])}://{words[0]}.example.{rng.choice(['com', 'org'])}/{words[1]}/{words[2]}/{i}"
        chance = 0.9 if words[0] == "casino" and words[1] == "win" else 0.5 if words[2] == "a" else 0.1
        out.append((tokens(url), rng.random() < chance))
    return out


def frame(spark, labelled):
    return spark.createDataFrame(labelled, "tokens array<string>, bad boolean").repartition(3)


@pytest.mark.parametrize("seed,support,count", [(1, 0.05, 2), (2, 0.2, 5), (3, 0.002, 20)])
def test_rules_match_power_set(spark, seed, support, count):
    labelled = random_labelled(seed)
    got = {frozenset(r["items"]): (r.n, r.bad) for r in U.mined(frame(spark, labelled), support, count).collect()}
    assert got == brute_rules(labelled, support, count) and got
    assert any({"h:casino", "p:win"} <= x for x in got)


def test_scores_are_the_surest_rule(spark):
    labelled = random_labelled(4)
    rules = U.mined(frame(spark, labelled), 0.05, 2)
    want = brute_rules(labelled, 0.05, 2)
    got = {tuple(r.tokens): r.risk for r in U.scored(frame(spark, labelled), rules).collect()}
    for basket in {tuple(b) for b, _ in labelled}:
        best = max((sure(b, n) for items, (n, b) in want.items() if items <= set(basket)), default=None)
        assert got.get(basket) == (None if best is None else pytest.approx(best, rel=1e-12))


def test_a_hot_url_of_many_tokens_stays_one_set(spark):
    hot = sorted({f"p:word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)})
    labelled = [(hot, True)] * 300 + random_labelled(5, 200)
    got = U.mined(frame(spark, labelled), 0.05, 5).collect()
    assert any(set(hot) <= set(r["items"]) and r.bad == 300 for r in got) and len(got) < 100


@pytest.mark.parametrize("seed", [6, 7])
def test_wide_baskets_are_mined_whole(spark, monkeypatch, seed):
    """The rules of baskets wider than FP-growth takes are those of the power set."""
    rng = random.Random(seed)
    labelled = random_labelled(seed, 300)
    for i in range(120):
        words = rng.sample("abcdefgh", rng.randint(3, 7))
        labelled.append((sorted({"q:" + w for w in words} | {"h:shop", "p:half"} | ({"p:twin"} if rng.random() < 0.8 else set())),
                         rng.random() < (0.9 if "a" in words and "b" in words else 0.3)))
    labelled += [(["h:shop", "q:z"], True)] * 9 + [(["q:y"], False)] * 5
    want = brute_rules(labelled, 0.05, 4)
    rules = lambda: {frozenset(r["items"]): (r.n, r.bad) for r in U.mined(frame(spark, labelled), 0.05, 4).collect()}
    assert rules() == want and any(len(x) > 2 for x in want)
    monkeypatch.setattr(U, "WIDEST", 3)
    assert rules() == want


def test_rare_tokens_of_a_wide_url_are_mined(spark):
    """Twenty-four frequent tokens stand together on 200 bad pages, and apart; the rarest of them, too, is a rule."""
    wide = [f"q:t{chr(97 + i)}" for i in range(24)]
    labelled = [(wide, True)] * 200 + [(wide[:23], False)] * 300
    labelled += [([t], bad) for i, t in enumerate(wide) for bad in [i < 23, True] for _ in range(40 - i)]
    got = {r.tokens[0]: r.risk for r in U.scored(frame(spark, [([wide[23]], True)]), U.mined(frame(spark, labelled), 0.002, 20)).collect()}
    assert got == {wide[23]: pytest.approx(sure(217, 234), rel=1e-12)}


URLS = [None, "", "no scheme", "http://a.NET", "http://a.net/", "https://B.Example.net/en/1?x#y", "http://example.net/en", "http://www.example.net/en/#f",
        "http://example.com/de/3.html", "http://badexample.com/de/3", "http://x.org/fr/9", "http://org/fr/", "http://x.org?u=/fr/", "a://b://c.net/",
        "http://ÄB.net/é?q", "http://n\new.net/x\ny", "://net/", "http:///net/", "http://net:80/", "http://" + "a." * 5000 + "net/" + "p/" * 20000]


def test_list_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "h", "host", 1, "r", "t", "i") for i, u in enumerate(URLS)], PAGES)
    none = U.mined(frame(spark, []))
    got = {r.page_id: r for r in U.judged(pages, none).collect()}
    for i, url in enumerate(URLS):
        _, host, path, _, _ = parts(url)
        best = listed(url)
        r = got[i]
        assert (r.host, r.path) == (ascii_lower(host), path), url
        assert (r.rule, r.verdict) == (best or (None, "allow")), url
        assert r.html == "h" and r.tokens == "t" and r.risk == 0.0
    assert {r.tokens[0] for r in pages.select(U.tokens_of(F.col("url")).alias("tokens")).where("size(tokens) > 0").collect()}
    found = [r[0] for r in pages.orderBy("page_id").select(U.tokens_of(F.col("url"))).collect()]
    assert found == [tokens(u) for u in URLS]


def query(spark, pages, labels, folder):
    spark.createDataFrame(pages, PAGES).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return U.op13_urls(spark, str(folder)).collect()


def test_query_learns_from_labels(spark, tmp_path):
    """Pages of one word pair stand for bad documents: unlisted pages with it are blocked, listed ones follow the list."""
    hosts = ["free-bets.example.com", "www.free-bets.example.org", "news.example.com", "free.example.com", "bets.example.org"]
    pages = [(i, f"http://{hosts[i % 5]}/en/{i}", None, None, None, None, None, None) for i in range(600)]
    pages += [(900, "http://free-bets.example.net/en/900", *[None] * 6), (901, None, *[None] * 6), (902, "http://free-bets.shop/en/x", *[None] * 6)]
    pages += [pages[0]]
    labels = [(i, 1, int(i % 5 < 2), None, None) for i in range(0, 600) if i % 3] + [(3, None, None, None, None), (None, 0, 1, None, None)]
    got = query(spark, pages, labels, tmp_path)
    assert len(got) == len(pages)
    for r in got:
        if r.page_id < 600:
            assert r.verdict == ("block" if r.page_id % 5 < 2 else "allow") and r.rule is None
    one = {r.page_id: r for r in got}
    assert (one[900].rule, one[900].verdict) == ("example.net/en/", "allow")
    assert (one[901].host, one[901].path, one[901].verdict) == ("", "", "allow")
    assert one[902].verdict == "block" and set(one[902].mined_rule.split()) >= {"h:free", "h:bets"}


def test_empty_tables(spark, tmp_path):
    assert query(spark, [], [], tmp_path) == []
