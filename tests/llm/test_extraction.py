"""Main text: the scan against pages written out, the chain against sums over all labellings, the query on held-out pages."""

import random
from html import escape
from itertools import product

import numpy as np
import pytest

from actaspark.llm import queries
from actaspark.llm.dom_blocks import blocks, text_features
from actaspark.llm.extraction import Chain, extract, fit, layouts, learn, main_text, marginals, marked, viterbi
from actaspark.plans.shipping import shipped

SCHEMA = "page_id long, url string, html string, text string, n_chars string, score int"


def said(page):
    return [b.text for b in blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        (" \n<p> </p>", []),
        ("plain  text\n", ["plain text"]),
        ("<p>a<p>b<div>c<p>d</div>e", ["a", "b", "c", "d", "e"]),
        ("<p><b>one<br>two<p>three</b> four</p>five", ["one two", "three four", "five"]),
        ("<script>var t='</p><p>x';</script><style>p{}</style>a<SCRIPT>b</ScRiPt >c", ["ac"]),
        ("a<script>never closed <p>b</p>", ["a"]),
        ("a<!-- <p>b</p> -->c<!-- open", ["ac"]),
        ("&lt;p&gt; &amp;amp; &eacute;&#233;&nbsp;x 1 < 2 & 3", ["<p> &amp; éé x 1 < 2 & 3"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
        ('<p title="a > b">x</p><p title=">y', ["x", '<p title=">y']),
        ("<title>t</title><textarea><p>x</textarea><select><option>o<option>q</select>r", ["o", "q", "r"]),
        ("</p></div><p>a</span></p>", ["a"]),
    ],
)
def test_blocks(page, want):
    assert said(page) == want


def test_ancestors_and_links():
    a, b, c = blocks('<div class="sideBar"><nav><p><a href=x>li</a>nk</p></nav></div><nav><p>x</p></nav><p data-main>y</p>')
    assert a.linked == 0.5 and b.linked == 0 and (a.tag, c.main, b.main) == ("p", True, False)
    assert set(b.features) < set(a.features) and len(a.features) == len(b.features) + 2
    weights = np.random.default_rng(0).normal(size=1 << 16).tolist()
    for x, y in zip(blocks(page := "<div class='a b'><div class='b c'>x<p class=c>y</p></div>z</div><p>w", weights), blocks(page), strict=True):
        assert x.score == pytest.approx(sum(weights[f] for f in y.features))


def test_scan_is_linear_on_hostile_pages():
    for page in ("<a '" * 60_000, "<!--" * 60_000, "<" * 200_000, "<div class=x>" * 30_000 + "deep", "<p><script>" * 40_000, "&" * 200_000, '<p "' * 60_001):
        list(blocks(page))
    assert said("<div>" * 30_000 + "deep" + "</div>" * 30_000) == ["deep"]


def test_chain_against_all_labellings():
    rng = np.random.default_rng(4)
    chain = Chain(np.zeros(1), rng.normal(size=(2, 2)), rng.normal(size=2))
    lengths, scores = np.array([1, 4, 6]), rng.normal(size=(3, 6)) * 2
    p, moves, begin = marginals(scores, lengths, chain)
    all_moves, all_begin = np.zeros((2, 2)), np.zeros(2)
    for k, n in enumerate(lengths):
        best, total, ones = None, 0.0, np.zeros(n)
        for y in product((0, 1), repeat=n):
            score = chain.start[y[0]] + sum(scores[k, t] * y[t] for t in range(n)) + sum(chain.move[y[t - 1], y[t]] for t in range(1, n))
            best = max(best or (score, y), (score, y))
            total, ones = total + np.exp(score), ones + np.exp(score) * np.array(y)
        for y in product((0, 1), repeat=n):
            share = np.exp(chain.start[y[0]] + sum(scores[k, t] * y[t] for t in range(n)) + sum(chain.move[y[t - 1], y[t]] for t in range(1, n))) / total
            all_begin[y[0]] += share
            for t in range(1, n):
                all_moves[y[t - 1], y[t]] += share
        assert viterbi(scores[k, :n].tolist(), chain) == list(best[1])
        assert np.allclose(p[k, :n], ones / total)
    assert np.allclose(moves, all_moves) and np.allclose(begin, all_begin)


def invented(rng, n):
    return [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(6, 60))) + "." for _ in range(n)]


def site_page(rng, i):
    """As one site has them, with its main text."""
    main = [f"Title {i} & more", *invented(rng, rng.randint(1, 6))]
    links = "".join(f"<li><a href=/{k}>{w}</a></li>" for k, w in enumerate(rng.choice(main).split()[:5]))
    body = "".join(f"<p>{escape(t)}" + rng.choice(["</p>", "<br>", ""]) for t in main[1:])
    page = f'<!DOCTYPE html><html><head><title>x</title><script>var t="</p>";</script></head><body><nav><ul>{links}</ul></nav><div class="ad">{rng.choice(invented(rng, 1))}</div><article><h1>{escape(main[0])}</h1>{body}</article><footer>&copy; site &middot; {invented(rng, 1)[0]}</footer>'
    return page, "\n".join(main)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(5)
    own = [marked(site_page(rng, i)[0]) for i in range(100)]
    texts = [[(b.tag, b.text) for b, y in zip(*m, strict=True) if y] for m in own]
    return fit(own + [marked(p) for p in layouts(texts, 500, 1)])


def test_unseen_layouts(model):
    right = wrong = missed = 0
    rng = random.Random(8)
    texts = [[("p", t) for t in invented(rng, 5)] for _ in range(60)]
    weights = model.weights.tolist()
    for page in layouts(texts, 200, seed=77):
        found, labels = marked(page)
        scores = [sum(weights[f] for f in [*b.features, *text_features(b, k)]) for k, b in enumerate(found)]
        for u, v in zip(viterbi(scores, model), labels, strict=True):
            right, wrong, missed = right + (u & v), wrong + (u & (1 - v)), missed + (v & (1 - u))
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_pages_of_other_sites(model):
    p = ["The committee met on Tuesday to discuss the new budget, which had been delayed twice.", "Members agreed that the plan, though costly, would be carried out next year.", "A final vote is expected in March."]
    body = "".join(f"<p>{t}</p>" for t in p)
    comments = '<div id="comments"><h3>2 comments</h3><div class="comment"><p>I never thought that they would agree on this, to be honest.</p></div><div class="comment"><p>Finally, good news from there.</p><a href=#>Reply</a></div></div>'
    pages = [
        f'<body><header><a href=/>Logo</a></header><div id="menu"><a href=/a>Home</a> <a href=/b>News</a></div><div class="post-content"><h2>Budget agreed</h2>{body}</div><div class="sidebar"><h4>Related articles</h4><ul><li><a href=/c>Something else</a></li></ul></div>{comments}<footer>© 2023 All rights reserved.</footer>',
        f'<body><div class="cookie-notice">We use cookies to improve your experience. <button>Accept</button></div><main><article><h2>Budget agreed</h2>{body}<div class="share"><a href=x>Share</a></div></article>{comments}</main><form class="newsletter"><label>Your email</label><button>Subscribe</button></form>',
        f'<body><table><tr><td class="menu"><a href=1>Home</a><br><a href=2>Contact</a><td class="content"><h2>Budget agreed</h2>{body}<td class="ads">Buy now, special offer</table>',
    ]
    for page in pages:
        assert main_text(page, model) == "\n".join(["Budget agreed", *p])


def test_query_on_held_out_pages(spark, tmp_path):
    rng = random.Random(9)
    made = [site_page(rng, i) for i in range(700)]
    rows = [(i, f"u{i}", page, "clash", "clash", 1) for i, (page, _) in enumerate(made)]
    rows += [(None, None, None, None, None, None), (800, None, "", None, None, 1), (3, "u3", made[3][0], None, None, 1), (801, "u", "<nav><ul><li><a>only</a></li></ul></nav>", None, None, 1)]
    texts = invented(rng, 5000)
    long = "".join(f"<p>{t}</p>" for t in texts)
    rows.append((802, "u", f"<html><body><nav><a href=x>y</a></nav><article>{long}</article></body></html>", None, None, 1))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    found = shipped(queries.queries()["op11_crf_main_text"])(spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    by = {r["page_id"]: r for r in found}
    assert by[None]["text"] == by[800]["text"] == by[801]["text"] == ""
    assert by[802]["text"] == "\n".join(texts)
    assert sum(by[i]["text"] == text for i, (_, text) in enumerate(made)) >= 0.99 * len(made)
    assert sum(r["page_id"] == 3 for r in found) == 2 and by[5]["url"] == "u5"


def test_no_pages(spark):
    none = spark.createDataFrame([], SCHEMA)
    chain = learn(none, laid_out=60)
    assert extract(none, chain).collect() == [] and extract(none, chain).columns == ["page_id", "url", "text", "n_chars"]
