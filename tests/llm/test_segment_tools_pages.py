"""Sampled segmentations, tool calls and pages."""

import json
import math
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import htmltext, lattice, segment, toolcalls
from pluvio.llm.lattice import Sampler, Vocabulary
from pluvio.llm.maxflow import source_side
from pluvio.llm.tokens import path_of

PIECES = path_of("piece_bpe_32k.model")


def segmentations(v, text):
    n = v.model.normalize(text)
    weight = {v.model.id_to_piece(int(i)): (int(i), float(x)) for i, x in zip(v.ids, v.weights, strict=True)}
    out = {}

    def go(at, ids, total):
        if at == len(n):
            out[tuple(ids)] = total
            return
        for j in range(at + 1, min(len(n), at + v.longest) + 1):
            if n[at:j] in weight:
                go(j, [*ids, weight[n[at:j]][0]], total + weight[n[at:j]][1])

    go(0, [], 0.0)
    z = np.logaddexp.reduce(list(out.values()))
    return {k: x - z for k, x in out.items()}


def test_samples_follow_the_lattice_without_replacement():
    v = Vocabulary(PIECES)
    own, n, text = Sampler(v), 3000, "the cat"
    exact = segmentations(v, text)
    rows = own.samples([text] * n, np.arange(n, dtype=np.uint64), 3)
    for row in rows:
        ids = [tuple(s.ids.tolist()) for s in row]
        assert len(set(ids)) == 3 and row[0].key > row[1].key > row[2].key
        assert all(s.log_prob == pytest.approx(exact[i], abs=1e-9) for s, i in zip(row, ids, strict=True))
    first = Counter(tuple(r[0].ids.tolist()) for r in rows)
    for ids, lp in exact.items():
        p = math.exp(lp)
        assert abs(first[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
    pairs = Counter((tuple(r[0].ids.tolist()), tuple(r[1].ids.tolist())) for r in rows)
    for (a, b), count in pairs.most_common(3):
        p = math.exp(exact[a] + exact[b]) / (1 - math.exp(exact[a]))
        assert abs(count / n - p) < 5 * math.sqrt(p * (1 - p) / n)
    weights = [sum(math.exp(s.log_prob) / s.inclusion for s in r) for r in rows]
    assert np.mean(weights) == pytest.approx(1.0, abs=0.05)


def test_all_segmentations_if_there_are_few():
    v = Vocabulary(PIECES)
    exact = segmentations(v, "tha")
    rows = Sampler(v).samples(["tha", "", "\U0001F600"], np.arange(3, dtype=np.uint64), 100)
    assert {tuple(s.ids.tolist()) for s in rows[0]} == set(exact) and all(s.inclusion == 1.0 for s in rows[0])
    assert [len(rows[1]), len(rows[1][0].ids)] == [1, 0]


def test_work_on_pieces_is_shared_by_the_texts_of_a_batch(monkeypatch):
    """A character that is no piece is looked up once a batch, not once per occurrence; samples still spell their texts."""
    v, asked = Vocabulary(PIECES), []
    fallback = v.fallback
    monkeypatch.setattr(v, "fallback", lambda code: asked.append(code) or fallback(code))
    texts = ["snow \u2603\U0001F9CA man " * k for k in range(1, 40)] + ["plain", ""]
    rows = Sampler(v).samples(texts, np.arange(len(texts), dtype=np.uint64), 2)
    assert len(asked) == len(set(asked)) > 0
    assert all(v.model.decode(s.ids.tolist()) == v.model.decode(v.model.encode(t)) for t, row in zip(texts, rows, strict=True) for s in row)
    made = segment.lists([s.ids for row in rows for s in row])
    assert made.to_pylist() == [s.ids.tolist() for row in rows for s in row] and segment.lists([]).to_pylist() == []


def test_hashes_are_found_where_a_search_finds_them():
    v, rng = Vocabulary(PIECES), np.random.default_rng(1)
    table = v.known[:len(v.piece)]
    h = np.concatenate([table, table + np.uint64(1), rng.integers(0, 2**64, 20_000, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    place, same = v.find(h)
    want = np.searchsorted(table, h)
    assert (place == want).all() and (same == (np.append(table, 0)[want] == h) & (want < len(table))).all()


def test_units_share_endings_and_those_met_again_stay(monkeypatch):
    """Fewer nodes and fewer units built anew; samples stay the same bit for bit."""
    v, rng = Vocabulary(PIECES), np.random.default_rng(7)
    parts = ["tion", "ment", "wh", "en", "the", "é", "漢", "qz", "ing", ".\n", "-", "  ", "'", "\U0001F9CA"]
    common = ["".join(rng.choice(parts, 4)) for _ in range(40)]
    texts = [" ".join([*rng.choice(common, 30), *("".join(rng.choice(parts, 6)) for _ in range(10))]) for _ in range(60)] + ["漢字" * 4000, "", "x"]

    def drawn(own, together):
        rows = [r for a in range(0, len(texts), together) for r in own.samples(texts[a:a + together], np.arange(a, len(texts), dtype=np.uint64)[:together], 3)]
        return [[(s.ids.tolist(), s.log_prob, s.key, s.inclusion) for s in r] for r in rows]

    whole = Sampler(v)
    want = drawn(whole, len(texts))
    monkeypatch.setattr(lattice, "SHARED", 0)
    apart = Sampler(v)
    assert drawn(apart, 7) == want and apart.lattices.n_nodes > whole.lattices.n_nodes
    monkeypatch.setattr(lattice, "SHARED", 5)
    small, built = Sampler(v), []
    small.lattices.remember = 4000
    add = small.lattices._add
    monkeypatch.setattr(small.lattices, "_add", lambda units, known: built.extend(units) or add(units, known))
    assert drawn(small, 4) == want
    again = Counter(built)
    assert max(again.values()) > 1 and len(built) < 1.5 * len(again)  # some were dropped, most were built once


def test_texts_are_cut_into_units_by_the_same_rule():
    v = Vocabulary(PIECES)
    for text in ("", "\u2581", "\u2581a", "a\u2581b", "\u2581a\u2581b\u2581", "\u2581\u2581a", "\u2581a b", "\u2581a-b\u2581c", "\u2581(a)\n\u2581\u2581", "a+", "\u2581don't."):
        assert v.cut(text) == v.unit.findall(text)


def test_samples_do_not_depend_on_batches_and_decode(spark, monkeypatch):
    texts = ["Hello  world, naïve\n\nx 漢字!", None, "", "a\tb " * 3000, "don't (stop).", "don't (stop)."]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(None, "x y")], "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS rank")
    rows = segment.segmentations(docs, PIECES, k=3)
    one = sorted((r.doc_id or -1, r["rank"], tuple(r.ids), r.perturbed) for r in rows.collect())
    other = segment.segmentations(docs.repartition(4, "doc_id").orderBy(F.desc("doc_id")), PIECES, k=3).collect()
    assert one == sorted((r.doc_id or -1, r["rank"], tuple(r.ids), r.perturbed) for r in other)
    model = Vocabulary(PIECES).model
    for r in segment.decoded(rows, PIECES, ["doc_id"]).collect():
        if r.doc_id is not None:
            assert r.text == model.decode(model.encode(texts[r.doc_id] or ""))
    assert segment.segmentations(docs.limit(0), PIECES).count() == 0


def test_tool_calls(spark):
    tools = {"t": {"a": {"type": "integer", "required": True, "least": 0, "most": 9}, "b": {"type": "string", "one_of": ["x", "y"]},
                   "c": {"type": "number"}, "d": {"type": "array"}}}
    calls = spark.createDataFrame([
        (1, 1, "p", "t", '{"b": "x",\n "a": 3, "c": 2}'), (1, 3, "q", "t", '{"a": "3"}'), (1, 5, "r", None, "{}"), (1, 7, "s", "t", "[1]"), (1, 9, "s", "t", "no"),
        (2, 1, "u", "t", '{"a": 1}'), (2, 2, "v", "t", '{"a": 77, "e": [2, {"z": 1, "y": null}]}'), (2, 3, "w", "t", '{"a": -1, "b": "z", "d": []}'),
        (3, 1, "x", "t", '{"a": 1}'), (3, 2, "y", "t", '{"b": null, "a": 0.5}'), (None, 1, "z", "t", "{}"), (4, 1, None, "t", "{}"),
    ], "conv_id long, turn long, call_id string, name string, arguments string").withColumn("errors", F.lit("clash"))
    results = spark.createDataFrame([(1, 2, "p", "first"), (1, 8, "p", "later"), (1, 4, "lost", "?"), (2, 4, "u", None)],
                                    "conv_id long, turn long, call_id string, content string")
    needs = spark.createDataFrame([(1, "q", "p"), (2, "u", "v"), (2, "v", "w"), (3, "x", "y"), (3, "y", "x"), (1, "q", "nobody"), (1, None, "p")],
                                  "conv_id long, call_id string, needed string")
    rows = toolcalls.linked(calls, results, needs, toolcalls.schemas(spark, tools)).collect()
    got = {(r.conv_id, r.call_id, r.turn): r for r in rows}
    assert len(rows) == 11
    assert [(r.call_id, r.status) for r in sorted((r for r in rows if r.conv_id == 1), key=lambda r: r.place)] == [
        ("p", "linked"), ("q", "pending"), ("lost", "orphan"), ("r", "pending"), ("s", "repeated"), ("s", "repeated")]
    assert [r.call_id for r in sorted((r for r in rows if r.conv_id == 2), key=lambda r: r.place)] == ["w", "v", "u"]
    assert [r.call_id for r in sorted((r for r in rows if r.conv_id == 3), key=lambda r: r.place)] == ["x", "y"]  # a cycle
    errors = {k[1]: r.errors for k, r in got.items()}
    assert errors["p"] == [] and errors["q"] == ["type a"] and errors["r"] == ["unknown tool"] and errors["s"] == ["no object"]
    assert errors["v"] == ["large a", "unknown e"] and errors["w"] == ["small a", "value b"] and errors["y"] == ["type a", "type b"]
    first = got[1, "p", 1]
    assert first.n_results == 2
    assert first.json == '{"arguments":{"a":3,"b":"x","c":2},"call_id":"p","conv_id":1,"errors":[],"name":"t","result":"first","status":"linked","turn":1}'
    assert json.loads(got[2, "v", 2].json)["arguments"] == {"a": 77, "e": [2, {"y": None, "z": 1}]}
    nothing = toolcalls.linked(calls.limit(0), results.limit(0), needs.limit(0), toolcalls.schemas(spark, tools))
    assert nothing.count() == 0


def test_cut_against_all_labellings():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        s, t = rng.integers(0, 6, n).astype(float), rng.integers(0, 6, n).astype(float)
        edges = [(a, b, float(rng.integers(0, 5))) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(keep):
            return (sum(t[k] if keep[k] else s[k] for k in range(n)) + sum(c for a, b, c in edges if keep[a] != keep[b]))

        best = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
        assert cost(source_side(list(s), list(t), edges)) == pytest.approx(best)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class="has-sidebar"><header class="site-header"><a href=/>Home</a>
<p>Slogan of the site, quite long and written like a sentence.</p></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div id="cookie-notice">We use cookies to make things better for you, accept them all please.</div><div class="wrap"><div class="post-content">
<h2>Title &amp; more</h2><p>First para with <a href=x>a link</a> inside&nbsp;it. a < b<div class="advert">Buy now, this is a long advert that looks like
content to be read.</div><p>Second<br>line.<ul><li>One<li>Two</ul><table><tr><td>x<td>y</table></div><aside>Side text that is long enough, isn't it.</aside>
<section id="comments"><article><p>I am a reader and comment here at length, with many words in it.</p></article></section>
<form><label>Name</label><input></form></div><footer><p>(c)</p></footer><script>if(a<b){x="</p>"}</script></body>"""


def test_main_text():
    assert htmltext.main_text(PAGE) == "Title & more First para with a link inside it. a < b Second line. One Two x y"
    article = "".join(f"<p>Paragraph {k} of the article, as it is.</p>" for k in range(400))
    page = f"<body><nav><a>a</a><a>b</a></nav><main>{article}</main><footer>All rights</footer>"
    assert htmltext.main_text(page) == " ".join(f"Paragraph {k} of the article, as it is." for k in range(400))
    for broken in ("", "<", "<p>a <b", "</p></p>", "<script>x", "<!-- x", "<p " + "a='" * 50, "<div>" * 3000):
        htmltext.main_text(broken)
    assert htmltext.main_text("plain text only, without markup.") == "plain text only, without markup."


STORY = "<h1>Rain</h1><p>The first paragraph of a story, long enough to be read as such.</p><p>A second one, <a href=x>with a link</a>.</p>"
STORY_TEXT = "Rain The first paragraph of a story, long enough to be read as such. A second one, with a link ."


@pytest.mark.parametrize("wrapper", [
    'class="content has-sidebar"', 'id="page" class="with-sidebar"', 'class="layout--no-sidebar"', 'class="page hasSidebar"', 'class="search-page"',
    'id="widget-area"', 'class="legal"', 'class="alert-box"', 'class="share form"', 'class="content sidebar-right"', 'id="content-sidebar-wrap"',
    'class="comments-open"', 'class="sidebar"',
])
def test_names_of_wrappers_do_not_empty_a_page(wrapper):
    around = "<nav><a>One</a></nav><div {}>{}<div class='sidebar'><p>What stands beside the story, whatever it is.</p></div></div><footer>(c)</footer>"
    for inside in (f"<article>{STORY}</article>", f"<main>{STORY}</main>", f"<div><div role=main>{STORY}</div></div>"):
        assert htmltext.main_text("<body>" + around.format(wrapper, inside) + "</body>").replace("link.", "link .") == STORY_TEXT
    if "content" in wrapper:
        assert "The first paragraph" in htmltext.main_text(around.format(wrapper, STORY))


def test_what_is_away_stays_away():
    for name in ("comments", "comment-list", "related", "teasers", "sponsored"):
        page = f'<main>{STORY}</main><div class="{name}"><article>{STORY}</article></div>'
        assert htmltext.main_text(page).replace("link.", "link .") == STORY_TEXT
    for wrapper in ("aside", "div hidden", "div class=sidebar", "div role=search class=main", "div class=modal-content", "div class='comments post'", "nav"):
        page = f"<article>{STORY}</article><{wrapper}><p>What stands beside the story, whatever it may be.</p></{wrapper.split()[0]}>"
        assert htmltext.main_text(page).replace("link.", "link .") == STORY_TEXT
    assert htmltext.main_text(f"<div hidden><main>{STORY}</main></div>") == ""
    assert htmltext.main_text(f'<article class="post category-related no-comments">{STORY}</article>').replace("link.", "link .") == STORY_TEXT


def test_pages_of_the_test_table(spark):
    import html as library
    import re

    out = {r.page_id: r for r in htmltext.op10_html_mincut(spark, "/root/testdata/sf0.01").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(out) == len(pages)
    for p in pages:
        inside = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        want = " ".join(library.unescape(re.sub(r"<[^>]+>", " ", inside)).split())
        assert out[p.page_id].text == want and out[p.page_id].n_chars == len(want)
    odd = spark.createDataFrame([(1, None, None), (2, "u", ""), (2, "u", "")], "page_id long, url string, html string").selectExpr("*", "1 AS text")
    assert [r.text for r in htmltext.extract(odd, ["page_id", "url"]).collect()] == ["", "", ""]
    assert htmltext.extract(odd.limit(0), ["page_id"]).count() == 0


@pytest.mark.parametrize("page", [
    '<body><form id="aspnetForm"><div id="content"><p>{}</p><p>{}</p></div></form></body>',
    '<body><div class="search-page"><p>{}</p><p>{}</p></div><div class="footer">imprint</div></body>',
    '<body><nav><a href="/">home</a> some menu</nav><div id="legal-news"><p>{}</p><p>{}</p></div></body>',
    '<body><div id="content"><form><p>{}</p><p>{}</p></form></div></body>',
    '<body><div class="related-news"><p>{}</p><p>{}</p></div></body>',
])
def test_names_of_wrappers_do_not_empty_a_page(page):
    one, two = "First sentence with quite a few words in it, as text has. " * 6, "Second paragraph that goes on in the same way as the first. " * 5
    assert htmltext.main_text(page.format(one, two)) == " ".join(f"{one}{two}".split())


def test_long_comments_do_not_become_the_text():
    article, comment = "The article is short but complete. " * 4, "A reader writes at length about something else entirely. " * 40
    page = f'<body><article><p>{article}</p></article><div class="comments"><p>{comment}</p></div><form class="reply"><p>{comment}</p></form></body>'
    assert htmltext.main_text(page) == article.strip()
    page = f'<body><div id="content"><p>{article}</p><div class="comments"><p>{comment}</p></div></div></body>'
    assert htmltext.main_text(page) == article.strip()


@pytest.mark.parametrize("page", ["<div>a b c" * 90_000, "</b></i></div>x " * 60_000, "<b>" * 20_000 + "<p>a" * 20_000, "<p><b>t</i>" * 60_000])
def test_broken_markup_takes_linear_time(page):
    start = time.process_time()
    htmltext.blocks(page)
    assert time.process_time() - start < 8


def test_samples_of_real_texts_are_the_same_bit_for_bit_when_drawn_alone(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect()]
    own = Sampler(Vocabulary(path_of("piece_bpe_32k.model")))
    seeds = np.arange(len(texts)).astype(np.uint64)
    together = own.samples(texts, seeds, 3)
    for k, (text, rows) in enumerate(zip(texts, together, strict=True)):
        alone = own.samples([text], seeds[k:k + 1], 3)[0]
        assert [(s.log_prob, s.key, s.inclusion, s.ids.tolist()) for s in alone] == [(s.log_prob, s.key, s.inclusion, s.ids.tolist()) for s in rows]
