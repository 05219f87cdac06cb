"""Main text of pages whose text is known."""

import random

import numpy as np

from monthwise.llm import gbt
from monthwise.llm import html_extract as h


def page(rng, form=0):
    words = lambda n: " ".join(rng.choice(["lorem", "ipsum,", "dolor", "sit.", "amet", "caf&eacute;"]) for _ in range(n))
    paras = [words(rng.randint(8, 60)) + "." for _ in range(rng.randint(1, 5))]
    title = words(5)
    nav = "<ul>" + "".join(f"<li><a href='/{i}'>{words(1)}</a></li>" for i in range(5)) + "</ul>"
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paras)
    junk = "<script>var a = '</p>' < 3;</script><!-- <p>no</p> -->"
    if form == 0:
        text = f"<nav>{nav}</nav>{junk}<div class=ad>{words(9)}</div><article>{body}</article><footer>{words(6)}</footer>"
    else:
        text = (f"<div class='top-menu'>{nav}</div>{junk}<div id='main-content'><div class=story>{body}"
                f"<div class='share-links'><a href=x>{words(3)}</a></div></div></div>"
                f"<div class='sidebar'>{nav}<p>{words(12)}</p></div><section id=comments><p>{words(30)}</p></section>"
                f"<div class='cookie-notice'>{words(15)}</div><form><p>{words(4)}</p></form><div class=footer>{words(6)}</div>")
    want = "\n".join(x.replace("&eacute;", "é") for x in [title, *paras])
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{text}</body></html>", want


def trained(seed=1):
    rng = random.Random(seed)
    return h.train([page(rng)[0] for _ in range(120)])


def test_pages_like_the_sample_and_unlike_it():
    rng, model = random.Random(9), trained()
    for form in (0, 1):
        pages = [page(rng, form) for _ in range(60)]
        got = h.extract_all([p for p, _ in pages], model)
        assert np.mean([a == w for a, (_, w) in zip(got, pages)]) >= 0.95, form


def test_blocks_and_references():
    model = trained()
    got = h.extract_all(["<article><p>a &lt;b&gt; &amp;amp; &#233;\n\t c<br>d <i>e</i>f<p>second <b>bold<p>third</article>"], model)
    assert got == ["a <b> &amp; é c d ef\nsecond bold\nthird"]


def test_odd_markup():
    model = trained()
    got = h.extract_all(["", "plain text", "<p>a<p>b", "<", "<div", "<!-- open", "<script>x", "</p></div>", "<a href='x>y",
                         "a < b and c > d", "<div>" * 5000 + "deep"], model)
    assert got[0] == "" and got[1] == "plain text" and got[2] == "a\nb" and got[9] == "a < b and c > d" and got[10] == "deep"


def test_decoding_keeps_no_node_below_a_dropped_one():
    rng = np.random.default_rng(3)
    t = h.parse("<div><section><p>a</p><ul><li>b<li>c</ul></section><p>d</p></div>" * 20)
    for _ in range(20):
        logits = rng.normal(0, 2, len(t.tag))
        keep = h.decode(t, logits)
        assert all(keep[t.parent[i]] for i in range(1, len(keep)) if keep[i])
    # best total among all rooted subtrees of a small tree
    t = h.parse("<div><p>aa</p><div><p>b</p><p>cccc</p></div></div>")
    n = len(t.tag)
    own = np.zeros(n)
    for node, _, x, _ in t.segments:
        own[node] += len(x)
    for _ in range(50):
        logits = rng.normal(0, 2, n)
        w = logits.clip(-6, 6) * (0.25 + np.log1p(own))
        best = max((sum(w[i] for i in range(1, n) if m >> i & 1) for m in range(0, 1 << n, 2)
                    if all(t.parent[i] == 0 or m >> t.parent[i] & 1 for i in range(1, n) if m >> i & 1)))
        keep = h.decode(t, logits)
        assert abs(sum(w[i] for i in range(1, n) if keep[i]) - best) < 1e-9


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = gbt.fit(x[:1500], y[:1500])
    assert ((m.logits(x[1500:]) > 0) == (y[1500:] == 1)).mean() > 0.95


def test_query_form_and_edges(spark):
    rng = random.Random(4)
    rows = [(i, f"http://x/{i}", page(rng)[0], "t", 1) for i in range(60)]
    rows += [(60, None, None, "t", 1), (61, "u", "", "t", 1), (None, "u", rows[0][2], "t", 1), (0, "http://x/0", rows[0][2], "t", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = h.extract_main_text(df, h.fit_model(df)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[60]["text"] == "" and by[61]["text"] == "" and all(r["n_chars"] == len(r["text"]) for r in got)
    assert by[None]["text"] == by[0]["text"] != ""
    empty = df.limit(0)
    assert h.fit_model(empty) is None and h.extract_main_text(empty, None).count() == 0


def test_attributes_of_any_length():
    for size in (100, 70_000, 200_000):
        long = "x" * size
        page = f"<body><article><h1>Title</h1><img alt=\"{long}> LEAK\"><p title='{long}> LEAK'>Some words of the article stand here.</p>" \
               f"<div data-a=\"{long}\" class='{long} > LEAK'>And a second paragraph of it.</div></article></body>"
        text = h.extract_all([page], None)[0]
        assert "LEAK" not in text and "x" * 50 not in text and "Some words of the article stand here." in text


def test_stray_quotes_stay_linear():
    import time
    page = "<body>" + "<p title=\"a>word</p> <b c='d>x</b>" * 30_000 + "</body>"
    t = time.perf_counter()
    h.extract_all([page], None)
    assert time.perf_counter() - t < 20


def test_a_page_of_menus_only_is_empty():
    assert h.extract_all(["<body><ul><li><a href=\"/\">Home</a></li><li><a href=\"/c\">Contact</a></li></ul></body>"], None) == [""]
    assert h.extract_all(["<body><p>Prose with <a href=\"/\">one link</a> in a sentence of some length.</p></body>"], None) == \
        ["Prose with one link in a sentence of some length."]
