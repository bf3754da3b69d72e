"""Toxicity, HTML extraction and language identification."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import html_extract, queries
from touchline.llm.html_extract import Page, content_marginals, extract, fit, main_text
from touchline.llm.language_id import identify
from touchline.llm.toxicity import BlockMaxIndex, held_out, isotonic, keep_clean, score_documents, weigh
from touchline.llm.toxicity import fit as fit_toxicity

SF = "/root/testdata/sf0.01"


# --- toxicity ---------------------------------------------------------------


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    idf = rng.random(30) + 0.1
    vecs = [weigh({int(t): int(rng.integers(1, 4)) for t in rng.choice(30, rng.integers(1, 6), replace=False)}, idf) for _ in range(700)]
    vecs += vecs[:40]
    index = BlockMaxIndex(vecs)
    dense = np.zeros((len(vecs), 30))
    for i, (t, w) in enumerate(vecs):
        dense[i, list(t)] = w
    for i in range(0, len(vecs), 23):
        s = np.round(dense @ dense[i], 9)
        s[i] = 0
        want = sorted(((-a, j) for j, a in enumerate(s) if a > 0))[:9]
        assert [j for _, j in index.nearest(*vecs[i], 9, without=i)] == [j for _, j in want]


def test_isotonic_is_monotone():
    x, y = isotonic([0.1, 0.2, 0.3, 0.4, 0.9], [0, 1, 0, 0, 1])
    assert x == sorted(x) and y == sorted(y) and 0 <= min(y) <= max(y) <= 1


def test_toxicity_on_held_out_rows(spark):
    got = queries.op8_toxicity(spark, SF).select("doc_id", "held_out", "score", "predicted")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    clean = [r for r in rows if r.held_out and r.toxic == 0]
    assert clean and sum(r.predicted for r in clean) / len(clean) <= 0.02
    assert sum(r.predicted == r.toxic for r in rows if r.held_out) / sum(r.held_out for r in rows) >= 0.95


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_toxicity_finds_the_held_out_toxic_rows(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_documents(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert sum(r.predicted for r in toxic if r.held_out) == sum(r.held_out for r in toxic) > 0
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert all(r.terms and len(r.neighbours) == 9 for r in rows if r.toxic == 1 or len(r.terms) > 20)


def test_block_max_search_meets_dense_and_rare_terms():
    rng = np.random.default_rng(4)
    idf = rng.random(400) + 0.1
    pick = lambda: {int(t): int(rng.integers(1, 4)) for t in (*rng.choice(20, 9, replace=False), *rng.choice(np.arange(20, 400), 5, replace=False))}
    vecs = [weigh(pick(), idf) for _ in range(3000)]
    index = BlockMaxIndex(vecs)
    assert 0 < len(index.head) < 400 and len(index.row)
    dense = np.zeros((len(vecs), 400))
    for i, (t, w) in enumerate(vecs):
        dense[i, t] = w
    queries = [weigh(pick(), idf) for _ in range(50)]
    for (t, w), got in zip(queries, index.nearest_of(queries, 9), strict=True):
        s = np.round(dense[:, t] @ w, 9)
        assert [j for _, j in got] == np.lexsort((np.arange(len(s)), -s))[:9].tolist()


def test_toxicity_examples_are_copies_only_when_whole(spark):
    line = "aaa bbb ccc ddd eee fff"
    rows = [(i, f"{line} w{i} v{i} u{i} {'idiot' if i % 2 else 'park'}") for i in range(40)]  # one passage in all
    rows += [(100 + i, rows[1][1].upper() + " ") for i in range(20)] + [(200 + i, "") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2 if i < 100 else 1 if i < 200 else int(i < 210)) for i, _ in rows], "doc_id long, toxic int")
    fold = {r.doc_id for r in docs.filter(held_out()).collect()}
    models = [fit_toxicity(docs.repartition(n), labels) for n in (1, 7)]
    usable = [i for i, _ in rows if i not in fold]
    copies = [i for i in usable if i == 1 or 100 <= i < 200]
    assert len(copies) > 1
    for m in models:
        assert sorted(m["ids"]) == sorted({i for i in usable if i < 100 and i != 1} | {min(copies)}) and m["ids"] == models[0]["ids"]
    empty = [i for i in usable if i >= 200]
    examples = len(models[0]["ids"]) + 2
    p = (1 + sum(models[0]["label"])) / examples
    assert models[0]["prior"] == pytest.approx((sum(i < 210 for i in empty) + p) / (len(empty) + 1))


def test_toxicity_edge_rows(spark):
    say = lambda i: ["idiot", "moron"] if i % 3 == 0 else ["fine", "park"]
    rows = [(i, " ".join(x for k in range(12 + i % 5) for x in (f"w{i}x{k}", say(i)[k % 2])), "x") for i in range(120)]
    rows += [(500, None, "x"), (501, "", "x"), (None, "idiot moron", "x"), (0, rows[0][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_documents(docs, labels).collect()}
    assert got[None].predicted == 1 and got[500].predicted == got[501].predicted == 0 and not got[None].held_out
    assert {i for i in range(120) if got[i].predicted} == set(range(0, 120, 3))
    clean = keep_clean(docs, labels)
    assert clean.columns == docs.columns and clean.count() == 82
    none = labels.limit(0)
    assert {r.score for r in score_documents(docs, none).collect()} == {0.0} and score_documents(docs.limit(0), labels).count() == 0


# --- HTML ---------------------------------------------------------------------

LOREM = "This is a sentence of the article, and it says something plain about the matter, as sentences do."
PAGES = [
    (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=/>Home</a> <a href=/x>News</a></nav><article><h1>Head &amp; line</h1>"
     f"<p>{LOREM}<br><b>Bold</b>ly\n  done.<p>{LOREM}</article><footer>&copy; site &middot; {LOREM}</footer></body></html>",
     f"Head & line {LOREM} Boldly done. {LOREM}"),
    (f"<body><div id='cookie-banner'><p>{LOREM}</p></div><div class='main-content'><h2>Title</h2><p>{LOREM}</p><div class='ad'>{LOREM}</div><p>{LOREM}</p>"
     f"<div class='comments'><p>{LOREM}</p><p>{LOREM}</p></div></div><aside><p>{LOREM}</p></aside><form><p>Search</p></form></body>",
     f"Title {LOREM} {LOREM}"),
    (f"<p>{LOREM}</p><script>var a = '<p>no</p>';</script><p>{LOREM} &lt;x&gt; &#233;</p><!-- <p>gone</p> --><p>cut <a href='x", f"{LOREM} {LOREM} <x> é cut"),
    ("", ""), (None, ""), ("<html><head><title>only</title></head></html>", ""),
]


@pytest.fixture(scope="module")
def model():
    return fit([p for p, _ in PAGES if p])


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_main_text(model, k):
    assert main_text(PAGES[k][0], model)[0] == PAGES[k][1]


SHORT = "Short title here"
LINKS = "".join(f"<li><a href=/x>Item {i}</a></li>" for i in range(6))
LAYOUT_CASES = [
("plain p's", f"<html><body><h1>{SHORT}</h1><p>{LOREM}</p><p>{LOREM}</p></body></html>", f"{SHORT} {LOREM} {LOREM}"),
("div soup", f"<body><div class='top'><ul>{LINKS}</ul></div><div id='content'><p>{LOREM}</p><p>Ok</p><p>{LOREM}</p></div><div id='footer'>{LOREM}</div></body>", f"{LOREM} Ok {LOREM}"),
("header site + article header", f"<body><header><h2>Site name</h2><nav><ul>{LINKS}</ul></nav></header><main><article><header><h1>{SHORT}</h1></header><p>{LOREM}</p></article></main><footer><p>{LOREM}</p></footer></body>", f"{SHORT} {LOREM}"),
("notice div", f"<body><div class='notice'>We use cookies. {LOREM}</div><article><p>{LOREM}</p></article><div class='newsletter-signup'><form>{LOREM}<input></form></div></body>", LOREM),
("aside sidebar in main", f"<body><main><p>{LOREM}</p><aside class='sidebar'><h3>{SHORT}</h3><p>{LOREM}</p><ul>{LINKS}</ul></aside><p>{LOREM}</p></main></body>", f"{LOREM} {LOREM}"),
("comments after", f"<body><article><h1>{SHORT}</h1><p>{LOREM}</p></article><section id='comments'><h2>Comments</h2><div class='comment'><p>{LOREM}</p></div><div class='comment'><p>{LOREM}</p></div></section></body>", f"{SHORT} {LOREM}"),
("comments inside article", f"<body><article><h1>{SHORT}</h1><p>{LOREM}</p><div class='comments'><h2>Comments</h2><div class='comment'><p>{LOREM}</p></div></div></article></body>", f"{SHORT} {LOREM}"),
("lists, tables", f"<body><article><h1>{SHORT}</h1><ul><li>One thing</li><li>Two things</li></ul><table><tr><th>A</th><td>B</td></tr></table><blockquote>{LOREM}</blockquote><pre>x  y</pre></article></body>", f"{SHORT} One thing Two things A B {LOREM} x y"),
("advert between", f"<body><article><p>{LOREM}</p><div class='ad-banner'><p>{LOREM}</p></div><div class='sponsored'>{LOREM}</div><p>{LOREM}</p></article></body>", f"{LOREM} {LOREM}"),
("links in text", f"<body><article><p>See <a href=x>the long link text that goes on</a> and <a href=y>more</a>.</p><p>{LOREM}</p></article></body>", f"See the long link text that goes on and more. {LOREM}"),
("form", f"<body><article><p>{LOREM}</p><form><label>Your name</label><input><button>Send</button><p>{LOREM}</p></form></article></body>", LOREM),
("role", f"<body><div role='navigation'><ul>{LINKS}</ul></div><div role='main'><p>{LOREM}</p></div><div role='complementary'><p>{LOREM}</p></div></body>", LOREM),
("empty article", f"<body><nav><ul>{LINKS}</ul></nav><article></article><footer>{LOREM}</footer></body>", ""),
("only nav", f"<body><nav><ul>{LINKS}</ul></nav><footer>&copy; x</footer></body>", ""),
("short article", f"<body><nav><ul>{LINKS}</ul></nav><article><h1>Hi</h1><p>Yes</p></article><footer>{LOREM}</footer></body>", "Hi Yes"),
("one word article, ads", f"<body><nav><ul>{LINKS}</ul></nav><div class=ad>{LOREM}</div><article><p>Word</p></article><aside>{LOREM}</aside><footer>{LOREM}</footer></body>", "Word"),
("section main", f"<body><div class=menu><ul>{LINKS}</ul></div><section class='main'><h2>{SHORT}</h2><p>{LOREM}</p></section><div class='related'><ul>{LINKS}</ul></div></body>", f"{SHORT} {LOREM}"),
]


@pytest.fixture(scope="module")
def table_model(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").limit(200).collect()
    return fit([r.html for r in rows])


@pytest.mark.parametrize("case", LAYOUT_CASES, ids=[c[0] for c in LAYOUT_CASES])
def test_unseen_layouts(table_model, case):
    assert main_text(case[1], table_model)[0] == case[2]


INSIDE = [
    ("math", f"<p>{LOREM} So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><p>{LOREM}</p>", f"{LOREM} So x=2 holds. {LOREM}"),
    ("quote in an unquoted value", f"<p data-x=it's>First {LOREM}</p><p>We don't {LOREM}</p>", f"First {LOREM} We don't {LOREM}"),
    ("stray quotes", f"<p title=\"a\" \"b class=x'y>{LOREM}</p><p>{LOREM}</p>", f"{LOREM} {LOREM}"),
    ("quoted >", f"<p title=\"a > b\" data-y = 'c > d'>{LOREM}</p>", LOREM),
    ("unclosed quote", f"<p title=\"a>{LOREM}</p><p>{LOREM.replace('article', 'piece')}</p>", f"{LOREM} {LOREM.replace('article', 'piece')}"),
    ("svg without end", f"<p>{LOREM}</p><svg width=1><p>{LOREM}</p><p>{LOREM}</p>", f"{LOREM} {LOREM} {LOREM}"),
    ("svg text", f"<p>{LOREM} <svg><path d='M0 0'/><text>label</text></svg> then</p>", f"{LOREM} label then"),
    ("noscript", f"<noscript><p>{LOREM}</p></noscript><p>{LOREM}</p>", f"{LOREM} {LOREM}"),
    ("object and video", f"<p>{LOREM} <object data=x><param name=y>fallback</object> <video><source src=z>no video</video> end</p>", f"{LOREM} fallback no video end"),
    ("controls", f"<p>{LOREM}</p><p>Pick <select><option>one</option></select><button type=button>Go</button><textarea>typed</textarea> here</p>", f"{LOREM} Pick here"),
    ("select without end", f"<p>{LOREM}</p><select><p>{LOREM}</p>", f"{LOREM} {LOREM}"),
]


@pytest.mark.parametrize("case", INSIDE, ids=[c[0] for c in INSIDE])
def test_nothing_inside_an_article_is_lost(table_model, case):
    page = f"<html><body><nav><ul>{LINKS}</ul></nav><article><h1>{SHORT}</h1>{case[1]}</article><footer>{LOREM}</footer></body></html>"
    if case[0] in ("svg without end", "select without end"):
        page = f"<html><body><nav><ul>{LINKS}</ul></nav><article><h1>{SHORT}</h1>{case[1]}</article></body></html>"
    assert main_text(page, table_model)[0] == f"{SHORT} {case[2]}"


def test_long_attributes_take_linear_time(model):
    import time

    began = time.time()
    main_text("<p " + "a=b c " * 200_000 + "'" + f"><p>{LOREM}</p>" + "<x " * 50_000 + "=\"" * 2000, model)
    assert time.time() - began < 20


def test_messages_give_exact_marginals(model):
    page = Page("<div class=ad><p>one two</p><ul><li><a href=x>three</a></li></ul></div>")
    n, table = len(page.parent), model["node"]
    phi = []
    for i in range(n):
        p = np.ones(4)
        for f in page.features[i]:
            p = p * np.array(table.get(f, [1, 1, 1, 1]))
        if page.tag[i] == "#text":
            p[0] = 0
        elif i and len(page.features[i]) == 1:
            p = p * np.array(table["g:none"])
        phi.append(p)
    total, hit = 0.0, np.zeros(n)
    for code in range(4 ** (n - 1)):
        y = [0] + [code // 4**k % 4 for k in range(n - 1)]
        w = np.prod([model["edge"][y[page.parent[i]]][y[i]] * phi[i][y[i]] for i in range(1, n)])
        total += w
        hit += w * (np.array(y) == 1)
    assert np.allclose(content_marginals(page, model)[1:], (hit / total)[1:])


def brute_page(source: str) -> str:
    """The article element's text, by the generator's own layout of the pages table."""
    import html
    import re

    body = re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
    return " ".join(t for b in blocks if (t := " ".join(html.unescape(re.sub(r"<[^>]*>|<[a-z/]*\Z", "", b)).split())))


def test_extraction_of_the_pages_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op1_html_extraction(spark, SF).collect()
    assert len(got) == len(pages)
    assert [g.page_id for g in got if g.text != brute_page(pages[g.page_id]) or g.n_chars != len(g.text)] == []


def test_extract_edge_rows(spark):
    rows = [(i, "u", p, "t") for i, (p, _) in enumerate(PAGES)] + [(None, None, PAGES[0][0], "t"), (0, "u", PAGES[0][0], "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(df).collect()
    assert len(got) == len(rows) and all(g.text == PAGES[g.page_id or 0][1] for g in got)
    assert extract(df.limit(0)).count() == 0
    deep = "<div>" * 3000 + LOREM + "</div>" * 3000
    assert len(Page(deep).parent) == 3002 and html_extract.main_text(deep, fit([])) is not None


# --- language -------------------------------------------------------------------


def test_language_of_the_pages_table(spark):
    got = queries.op3_language_id(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/pages.parquet").count()
    rows = got.collect()
    assert sum(r.lang == r.declared for r in rows) / len(rows) >= 0.95
    hidden = spark.read.parquet(f"{SF}/pages.parquet").withColumn("html", F.regexp_replace("html", 'lang="[^"]*"', ""))
    told = {r.page_id: r.lang for r in identify(hidden, spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert sum(told[r.page_id] == r.declared for r in rows) / len(rows) >= 0.95


def test_language_edge_rows(spark):
    docs = spark.createDataFrame([(i, t * 5, g) for i, (t, g) in enumerate([("the cat and the dog with that ", "en"), ("der hund und die katze nicht ", "de")] * 20)], "doc_id long, text string, lang string")
    page = lambda t, d="": f"<html{d}><body><p>{t}</p></body></html>"
    rows = [(i, f"http://a.de/{i}", page("und die katze mit der maus")) for i in range(30)]
    rows += [(90, "http://a.de/z", None), (91, None, page("the dog with that cat")), (92, "http://b.com", page("", ' lang="de"')), (None, "http://b.com", ""), (0, "http://a.de/0", rows[0][2])]
    got = [(r.page_id, r.lang) for r in identify(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()]
    assert len(got) == len(rows) and dict(got)[90] == "de" and dict(got)[91] == "en" and dict(got)[92] == "de"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert identify(pages.limit(0), docs).count() == 0
    assert {r.lang for r in identify(pages, docs.limit(0)).collect()} == {None}
