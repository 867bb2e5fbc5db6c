"""Nearest neighbours, page texts and the pipeline."""

from __future__ import annotations

import html
import re
import time

import numpy as np
import pytest

import corpus_pipeline
from postmill.llm import pages, vectors

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>"


def brute(rows: list[tuple], step: int, k: int) -> dict:
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for at, (q, x) in enumerate(good):
        if q % step == 0:
            score = [(-round(float(x @ y / np.sqrt((x @ x) * (y @ y))), 12), i) for j, (i, y) in enumerate(good) if j != at and len(x) == len(y)]
            out[q] = [i for _, i in sorted(score)[:k]]
    return out


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(1, 120)]
    rows += [(i, rows[9][1]) for i in range(200, 230)]  # one common vector
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None, *[0.0] * 6]), (304, [float("nan")] * 8), (305, [float("inf")] * 8)]
    rows += [(306, [1.0] * 3), *[(400 + i, [float(i), 2.0, 3.0]) for i in range(9)], (None, rows[0][1]), (-50, (2 * np.array(rows[9][1])).tolist())]
    return rows


def test_neighbours_are_those_of_all_vectors(spark, table):
    frame = spark.createDataFrame(table, VECTORS)
    rows = sorted(vectors.nearest(frame, step=10).collect())
    found: dict = {}
    for r in rows:
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append(r.vec_id)
    want = brute(table, 10, 5)
    assert found.keys() == want.keys()
    same = sum(len(set(found[q]) & set(want[q])) for q in want) / sum(map(len, want.values()))
    assert same == 1.0
    assert found[200] == want[200] and found[210] == want[210]


def test_recall_over_many_lists(spark, monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(3000, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    monkeypatch.setattr(vectors, "LIST_SIZE", 60)
    monkeypatch.setattr(vectors, "LEAST_CANDIDATES", 200)
    monkeypatch.setattr(vectors, "PART", 50)
    found: dict = {}
    for r in vectors.nearest(spark.createDataFrame(rows, VECTORS), step=30, share=0.3).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows, 30, 5)
    assert sum(len(found[q] & set(want[q])) for q in want) / (5 * len(want)) >= 0.9


def test_candidates_are_abandoned_and_found_in_64_dimensions(spark, monkeypatch):
    """Several blocks of columns and lists, two lengths with lists of their own, one without."""
    rng = np.random.default_rng(6)
    monkeypatch.setattr(vectors, "LIST_SIZE", 50)
    monkeypatch.setattr(vectors, "LEAST_CANDIDATES", 300)
    monkeypatch.setattr(vectors, "PART", 64)
    centres = rng.normal(size=(12, 80))  # bundles of vectors, as embeddings have them
    rows = [
        (10 * i + at, (centres[i % 12, :size] + rng.normal(size=size)).astype(np.float32).tolist())
        for at, (size, n) in enumerate(((64, 1500), (80, 400), (20, 90))) for i in range(n)
    ]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: vectors.F.lit(1) for c in ("list", "h1", "v", "size")})
    found: dict = {}
    for r in vectors.nearest(frame, step=50).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    want = brute(rows, 50, 5)
    assert found.keys() == want.keys()
    assert sum(len(set(found[q]) & set(want[q])) for q in want) / sum(map(len, want.values())) >= 0.9
    x = vectors.unit(rng.normal(size=(900, 64))).astype(np.float32)
    kept, _ = vectors.scan(x[:20], x[20:], 6)
    assert len(kept) < 20 * 880 * 0.7  # the others are given up on the way


def test_few_or_no_vectors(spark, table):
    one = spark.createDataFrame([(0, [1.0, 0.0])], VECTORS)
    assert vectors.op2(one).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in vectors.op2(two).collect()] == [(0, 1, 7, 0.707107)]
    assert vectors.op2(one.limit(0)).count() == 0
    assert vectors.op2(spark.createDataFrame([r for r in table if r[0] in (300, 302, 304)], VECTORS)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar">
<header><h1>Site name</h1><nav><ul><li><a href="/">Home</a><li><a href="/x">More</a></ul></nav></header>
<div id="cookie-notice">We use cookies <button>OK</button></div>
<main><article><h1>Head &amp; line</h1><p>First  para <b>bo</b>ld.<p>Second&nbsp;para<br>goes on &lt;here&gt;.
<div class="advert">Buy this</div><ul><li>One<li>Two</ul><aside>Related</aside><script>var a = "<p>no</p>";</script>
<p>Last &#233;nd.</p><section class="comments"><p>Nice post!</p></section></article></main>
<form><input value=1>Search</form><footer>&copy; 2020</footer></body></html>"""


def test_main_text_of_a_page():
    assert pages.main_text(PAGE, {}) == "Head & line\nFirst para bold.\nSecond para goes on <here>.\nOne\nTwo\nLast énd."


def test_page_without_an_article():
    body = "".join(f"<div class=post><p>Sentence number {k} has quite a few words in it.</p></div>" for k in range(6))
    page = f"<body><div class=menu><a href=a>x</a> <a href=b>y</a></div><div class=content>{body}</div><div class=footer>end</div>"
    text = pages.main_text(page, {})
    assert text.split("\n") == [f"Sentence number {k} has quite a few words in it." for k in range(6)]


@pytest.mark.parametrize(
    "opening",
    [
        "<div class='content-sidebar-wrap'><article>",
        "<div><article class='post no-sidebar'>",
        "<div><article class='post has-comments'>",
        "<article><div class='elementor-widget-container'>",
        "<div class='page-widget'><div>",
    ],
)
def test_names_do_not_drop_the_main_text(opening):
    body = "".join(f"<p>Sentence number {k} has quite a few words in it.</p>" for k in range(6))
    page = f"<body><div class='topMenu'>Some entries of a menu</div>{opening}{body}<p>Let <math><mi>x</mi></math> be.</p><div class=comments><p>Nice post!</p></div>"
    want = [f"Sentence number {k} has quite a few words in it." for k in range(6)] + ["Let x be."]
    assert pages.main_text(page, {}).split("\n") == want


def test_names_that_articles_use_too():
    body = "".join(f"<p>Sentence number {k} has quite a few words in it.</p>" for k in range(6))
    inside = (
        "<p class='social'>Social life of ants.</p><div class='notice-of-results'>Results are noted.</div>"
        "<section id='related-work'><p>Others did it.</p></section><div class='has-comments'>Remarks on it.</div>"
    )
    outside = (
        "<div class='related-posts'><p>More to read</p></div><div id='cookie-notice'>We use cookies</div><div class='share-buttons'>Share it</div>"
        "<div class=notice>Site closed</div><ul class='post-comments'><li>Nice post</ul><div class='ad-top'>Buy</div>"
    )
    want = [f"Sentence number {k} has quite a few words in it." for k in range(6)]
    want += ["Social life of ants.", "Results are noted.", "Others did it.", "Remarks on it."]
    page = f"<body><article>{body}{inside}{outside}</article>"
    assert pages.main_text(page, {}).split("\n") == want
    learned = {"name notice": 0.9}  # labelled pages hold such words within their content
    assert pages.main_text(page, learned).split("\n") == [*want, "Site closed"]


def test_weights_decide_on_the_region():
    first = "".join(f"<p>Sentence number {k} has quite a few words in it.</p>" for k in range(4))
    page = f"<body><article><section>{first}</section><section><pre>some code of many words here</pre></section></article><div>Rights are reserved by all</div>"
    both = pages.main_text(page, {})
    assert both.endswith("some code of many words here") and both.startswith("Sentence")
    low = {"word pre in": 0.0, "<section> in": 0.0, "</section> in": 0.0, "<pre> in": 0.0}
    assert "code" not in pages.main_text(page, low) and "number 3" in pages.main_text(page, low)
    other = {"word p in": 0.0, "word pre in": 0.0, "word div out": 1.0}
    assert pages.main_text(page, other) == "Rights are reserved by all"


def test_learned_shares(spark):
    body = "<p>Some words of the text.</p><div class='notice'>It was noted here.</div>"
    rows = [(k, "u", f"<body><div class='related'>Read more of it</div><article>{body}</article>") for k in range(5)]
    rows += [(9, "u", "<body><p>no mark</p>"), (10, "u", None)]
    shares = pages.learned(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert shares["name notice"] > 0.9 and shares["name related"] < 0.1
    assert shares["word p in"] > 0.9 and shares["word p"] > 0.9 and "word p out" not in shares


N = 100_000


@pytest.mark.parametrize(
    ("page", "words"),
    [
        ("<div>" * N + "</b>" * N + "x", 1),
        ("<svg>" * (2 * N), 0),
        ("<span>" * N + "<p>x" * N, N),
        ("<b>w" * N, 1),
        ("<" + "a" * (10 * N), 0),
        ("<div class=related>w " * (N // 4), 1),
        ("<a href='" * N, 0),
        ("<ul><li>a" * (N // 2), 1),
        ("<!-" * N, 0),
    ],
    ids=["stray ends", "raw", "paragraphs", "inline", "name", "names", "quotes", "lists", "comments"],
)
def test_hostile_pages_take_linear_time(page, words):
    begin = time.process_time()
    text = pages.main_text(page, {})
    assert time.process_time() - begin < 8
    assert len(text.split()) == words


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!-- open", "<script>only", "<nav>menu</nav>", "<a title='x>", "</p></div>"])
def test_pages_without_text(page):
    assert pages.main_text(page, {}) in ("", "<")


def test_region_is_the_best_of_all():
    row = pages.tokens(PAGE)
    first, last = pages.region(row, {})

    def score(token):
        share = pages._default(pages._event(token))
        if token.text is not None:
            return max(share, pages.LEAST_WORD) * len(token.text.split())
        return -max(pages.TAG_COST * (1 - share), pages.LEAST_TAG)

    values = [score(t) for t in row]
    best = max(sum(values[a:b]) for a in range(len(values)) for b in range(a + 1, len(values) + 1))
    assert sum(values[first : last + 1]) == pytest.approx(best)


def test_pages_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in table.collect()}
    for r in pages.op7(table).collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", source[r.page_id], re.S)[1]
        assert "".join(r.text.split()) == "".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", PAGE), (2, "u", PAGE)], "page_id long, url string, html string")
    assert sorted(r.n_chars for r in pages.op7(odd.selectExpr("*", "1 as text")).collect()) == [0, 0, 74, 74]
    assert pages.op7(odd.limit(0)).count() == 0


def test_pipeline_keeps_columns_and_acts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, SF).collect(), docs.schema)
        assert rows.columns == columns, name
        counts.append(rows.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0
    assert rows.groupBy("doc_id").count().where("count > 2").count() == 0
    final = corpus_pipeline.run(spark, SF)
    assert final.columns == [*columns, "shard", "slot"] and final.count() == counts[4]
    assert final.select("shard", "slot").distinct().count() == counts[4]
