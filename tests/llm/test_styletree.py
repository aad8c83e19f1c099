import random
import time
from html import escape

import pytest

from riskmart.llm import styletree as S

SCHEMA = "page_id long, url string, html string, text string, host string"


def extract(spark, rows, **k):
    frame = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)
    return {r.page_id: r.text for r in S.extracted(frame, **k).collect()}


def test_round_trip_of_the_driver_pages(spark, sf_small):
    """The pages wrap documents: every extracted text is a heading and a whole document."""
    texts = {"\n".join(" ".join(line.split()) for line in r.text.split("\n") if line.strip())
             for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    out = S.op3_html(spark, sf_small).collect()
    assert len(out) == spark.read.parquet(f"{sf_small}/pages.parquet").count()
    assert all(r.text.partition("\n")[2] in texts and r.n_chars == len(r.text) for r in out)


def test_statistics_remove_shared_branches_without_marked_article(spark):
    rng = random.Random(1)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta".split()) + str(rng.randrange(10**6))
    rows, want = [], {}
    for i in range(40):
        paragraphs = [" ".join(word() for _ in range(20)) for _ in range(rng.randint(1, 5))]
        want[i] = "\n".join(paragraphs)
        body = "".join(f"<p>{escape(p)}</p>" for p in paragraphs)
        rows.append((i, f"https://user@Shop.example:8080/{i}", "<html><body><div class='top'><span>Our shop</span> since 1999</div>"
                     f"<div class=c>{body}</div><div id=legal><p>Always the same line</p><p>And another</p></div></body>"))
    assert extract(spark, rows) == want


def test_marked_noise_and_nested_markup(spark):
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
      <nav><ul><li><a href=x>Menu<li>More</ul></nav><div class="cookie-x cookie">We use cookies</div>
      <main><p>intro outside the article</p><article><header><h1>Head &amp; line</h1></header>
      <p>One<br>two <b>bold <i>deep</p><p class="x">Three &lt;four&gt; &#233;&nbsp;five<div class="ad box">Buy</div>
      <aside>side</aside><script>var t="</p><p>no"</script><!-- <p>gone</p> --><ul><li>a<li>b</ul>
      <form><p>mail?</p></form>tail 3 < 5<section id="comments"><article>First!</article></section>
      <footer>by me</footer></article></main><footer>foot</footer></body></html>"""
    assert extract(spark, [(1, "http://a.example/", html)])[1] == (
        "Head & line\nOne two bold deep\nThree <four> é five\na\nb\ntail 3 < 5")


def test_copies_of_an_article_stay(spark):
    html = "<body><nav>m</nav><article><h1>T</h1><p>same text</p></article></body>"
    plain = "<body><div><p>same text everywhere</p></div></body>"
    rows = [(i, "http://a.example/x", html) for i in range(30)] + [(100 + i, "http://b.example/x", plain) for i in range(30)]
    out = extract(spark, rows)
    assert set(out.values()) == {"T\nsame text", "same text everywhere"} and len(out) == 60


def test_cases(spark):
    rows = [(1, None, None), (2, None, "<p>no host"), (3, "not a url", ""), (4, "http://a.example", "plain & simple"),
            (5, "http://a.example", "<p>cut <a href='x"), (5, "http://a.example", "<p>cut <a href='x"), (None, "x", "<p>a"),
            (6, "http://a.example", "</p></div>x</b><td>y<tr><td>z"), (7, "http://a.example", "<p>" + "w " * 200000)]
    out = extract(spark, rows)
    assert out[1] == out[3] == "" and out[2] == "no host" and out[4] == "plain & simple" and out[5] == "cut"
    assert out[6] == "x\ny\nz" and out[None] == "a" and len(out[7]) == 399999


def test_empty_table(spark):
    assert extract(spark, []) == {}


@pytest.mark.parametrize("n", [2, 16])
def test_importance_of_one_and_many(n):
    import pandas as pd
    rows = pd.DataFrame({"path": [1, 2, 3], "parent": [0, 1, 1], "pages": [n] * 3,
                         "presentation": [0.0, 0.0, 1.0], "content": [float("nan"), 0.0, 1.0]})
    score = S.importances(rows).tolist()
    assert score == [1.0, 0.0, 1.0]
    rows["content"] = [float("nan"), 0.0, 0.4]
    rows["presentation"] = [0.5, 0.0, 0.0]
    assert S.importances(rows).tolist() == pytest.approx([0.36, 0.0, 0.36])


def test_page_own_elements_count_in_their_container(spark):
    """The article stands in an element of one page only, beside a line that all pages share."""
    text = lambda i: " ".join(f"word{i}x{k}" for k in range(30))
    rows = [(i, f"http://a.example/{i}", f"<body><div class=date>day {i}</div><div class=box><p>Always the same line</p>"
             f"<div id=post-{i}><p>{text(i)}</p></div></div><div class=legal><p>Same</p><p>And <a id=x{i}></a>same</p></div></body>")
            for i in range(12)]
    assert extract(spark, rows) == {i: f"day {i}\n{text(i)}" for i in range(12)}


def test_statistics_decide_beside_the_marks(spark):
    """Boilerplate inside an article goes; articles that are teasers do not replace the text; a copied article stays."""
    text = lambda i: " ".join(f"word{i}x{k}" for k in range(30))
    inside = "<body><main><article><h1>T {0}</h1><p>{1}</p><div class=c><p>Same on all pages</p></div></article></main></body>"
    teaser = "<body><div class=c><h2>T {0}</h2><p>{1}</p></div><div class=d><article>One</article><article>Two</article></div></body>"
    copied = "<body><div class=c>Visit {0}</div><article><h1>T</h1><p>the same article</p></article></body>"
    rows = [(100 * k + i, f"http://{k}.example/{i}", html.format(i, text(i)))
            for k, html in enumerate((inside, teaser, copied)) for i in range(12)]
    want = {100 * k + i: f"T {i}\n{text(i)}" for k in (0, 1) for i in range(12)}
    assert extract(spark, rows) == want | {200 + i: "T\nthe same article" for i in range(12)}


def test_text_below_a_form_or_name_opens_again(spark):
    words = "the long text of the page"
    pages = [f"<body class=login><div class=skip>to</div><article><h1>T</h1><p>{words}</p><div class=ad>Buy</div></article></body>",
             f"<body><form><nav>m</nav><main><p>{words}</p></main></form></body>",
             f"<body><p>text</p><p>{words}</p><div class=sidebar><article>teaser</article></div></body>",
             f"<body><p>{words}</p><div class=comments><article>a comment {words}</article></div></body>",
             f"<body><p>{words}</p><aside><article>aside {words}</article></aside></body>"]
    rows = [(i, f"http://h{i}.example/", html) for i, html in enumerate(pages)]
    rows += [(10 + i, f"http://f.example/{i}", f"<body><form><div class=c><p>{words} {i}</p></div><p class=d>Same</p></form></body>")
             for i in range(12)]
    want = {0: f"T\n{words}", 1: words, 2: f"text\n{words}", 3: words, 4: words}
    assert extract(spark, rows) == want | {10 + i: f"{words} {i}" for i in range(12)}


@pytest.mark.parametrize("html", ["<b>" * 120_000 + "<p>x y</p>" * 70_000, "<td>" * 100_000 + "<li>x</b>" * 70_000, "<div>" * 90_000 + "<p>a" * 90_000 + "</div>" * 50_000])
def test_a_megabyte_of_unclosed_elements(html):
    """Time follows the length, not the number of open elements."""
    began = time.time()
    page = S.Page(html)
    assert page.text() and time.time() - began < 20


def _varied_pages(rng, n, host="http://v.example"):
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(50))
    line = lambda k: " ".join(word() for _ in range(k))
    rows, want = [], {}
    for i in range(n):
        paragraphs = [line(rng.randint(4, 300)) for _ in range(rng.randint(1, 9))]
        menu = "".join(f"<li><a href='/{word()}'>{word()}</a></li>" for _ in range(6))
        title = line(4)
        want[i] = "\n".join([title, *paragraphs])
        rows.append((i, f"{host}/{i}", f"<body><div><ul>{menu}</ul></div><div>{line(5)}</div><section><h1>{title}</h1>"
                     + "".join(f"<p>{p}</p>" for p in paragraphs) + f"</section><div class=c>{line(3)}</div><div>{line(6)}</div></body>"))
    return rows, want


def test_shape_decides_without_any_marks(spark):
    """Menus and notices whose words differ on every page are uniform; paragraphs are not."""
    rows, want = _varied_pages(random.Random(3), 60)
    got = extract(spark, rows, marks=False)
    assert all(got[i] == want[i] for i in want)
    # With marks nothing is marked here: the menu goes, single lines of one shape may be bylines and stay.
    kept = extract(spark, rows)
    assert all(set(want[i].split("\n")) <= set(kept[i].split("\n")) for i in want)
    assert all(len(kept[i].split("\n")) == len(want[i].split("\n")) + 3 for i in want)


def test_a_list_that_is_the_text_stays(spark):
    rows = [(i, f"http://l.example/{i}", "<body><p>Top</p><ul>" + "".join(f"<li>entry {i} {k} of the page" for k in range(8)) + "</ul></body>")
            for i in range(20)]
    assert all(len([t for t in text.split("\n") if t.startswith("entry")]) == 8 for text in extract(spark, rows).values())


def test_entropies_match_brute_force(spark):
    from collections import Counter
    from math import log
    rows, _ = _varied_pages(random.Random(8), 23)
    rows += [(100 + i, u, h) for i, u, h in rows[:4]] + [(200, "http://v.example/x", "<body><p>one</p><nav>"), (201, "http://v.example/y", None)]
    frame = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)
    got = {r.path: r for r in S.tree(frame).collect()}
    pages = [S.Page(h) for _, _, h in rows if h]
    on = Counter(p for page in pages for p in {e.path for e in page.elements})
    assert set(got) == {p for p, n in on.items() if n >= S.ENOUGH}
    for path, row in got.items():
        m = on[path]
        styles = Counter(page.styles()[path] for page in pages if path in page.styles())
        entropy = -sum(n / m * log(n / m) for n in styles.values())
        assert row.pages == m and row.presentation == pytest.approx(min(1, entropy / log(min(m, S.STYLES))), abs=1e-9)
        said = Counter((t,) for page in pages for t in {t for e, t in page.blocks if e.path == path})
        if not said:
            assert row.content is None
            continue
        mean = sum(n * log(n) / log(m) for n in said.values()) / sum(said.values())
        assert row.content == pytest.approx(max(0, 1 - mean), abs=1e-9)


def test_children_without_text_have_no_say():
    import pandas as pd
    nan = float("nan")
    rows = pd.DataFrame({"path": [1, 2, 3], "parent": [0, 1, 2], "pages": [8] * 3, "presentation": [0.2, 1.0, 0.0],
                         "content": [nan, 1.0, nan]})
    assert S.importances(rows).tolist() == pytest.approx([1.0, 1.0, 0.0])
