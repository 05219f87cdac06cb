"""Operator 5: main text of web pages.

A page becomes a tree of its block elements and of inline elements with a class,
id or role.  Gradient-boosted trees score each node as main text or not, from its
tag group, attribute tokens (its own and its ancestors'), depth, text, link and
punctuation density of the subtree, and its place among its siblings.  Decoding is
hierarchical: a node can be kept only below kept nodes, and the kept tree of the
largest total log-odds is found by one bottom-up pass, so an ancestor and a
descendant never contradict each other.

The trees are fitted on a bounded sample: TRAIN_PAGES pages, the smallest by a hash
of the page id.  There are no hand-made labels, so a node's label is whether an
article or main element holds it without an element of a boilerplate tag or
attribute token between.  Copies of the nodes with tags and attributes blanked
teach the same from densities alone, for pages without such marks.

Extraction is one pass over the pages.  Character references are decoded, white
space inside a block becomes one space, blocks are joined by one line feed; ``br``
counts as white space.

Defined results: null or empty html: empty text; markup that is cut off or wrongly
nested is closed where a browser would roughly close it; when the sample has no
article, or the trees keep nothing of a page, everything but boilerplate tags and
tokens is kept; an empty table gives
an empty result; repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm import gbt
from monthwise.llm.common import bounded_batches, table

TRAIN_PAGES = 400               # bound of the training sample; its pages are fitted whole

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe",
                                                        "template", "svg", "select", "button", "xmp", "noframes")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
                  "ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {                      # a start tag that ends an open element of these, up to the stop tags
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
BOILER_TAGS = frozenset("nav footer header aside form menu dialog head fieldset".split())
MAIN_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_TOKENS = frozenset(
    "nav navbar navigation menu header footer masthead sidebar side aside rail ad ads advert adverts advertisement "
    "sponsor sponsored promo banner notice alert cookie cookies consent gdpr privacy popup modal overlay newsletter "
    "subscribe signup login register search form share sharing social related recommend recommended more widget "
    "breadcrumb breadcrumbs pagination pager toolbar comment comments reply replies respond discussion disqus "
    "contentinfo complementary copyright legal skip tags".split())
MAIN_TOKENS = frozenset("article content main post entry story body text prose".split())


class Tree:
    """Nodes of one page in document order; a parent comes before its children."""

    def __init__(self):
        self.tag, self.parent, self.depth, self.marks = ["#"], [-1], [0], [(0, 0)]
        self.segments: list[tuple[int, int, str, bool]] = []     # node, block, text, in a link

    def add(self, tag, parent, marks):
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.marks.append(marks)
        return len(self.tag) - 1


def _marks(attrs: str) -> tuple[int, int]:
    bad = good = 0
    for m in _ATTR.finditer(attrs):
        for part in _PARTS.findall(m.group(2) or m.group(3) or m.group(4) or ""):
            part = part.lower()
            bad += part in BOILER_TOKENS
            good += part in MAIN_TOKENS
    return bad, good


def parse(page: str) -> Tree:
    tree = Tree()
    stack: list[tuple[str, int]] = [("#", 0)]          # open elements and their nodes
    links = block = 0
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            tree.segments.append((stack[-1][1], block, page[at:stop], links > 0))
        if not m:
            break
        at = m.end()
        if not m.group(2):
            continue
        tag = m.group(2).lower()
        if m.group(1):
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if tag not in BLOCK and any(stack[i][0] in BLOCK for i in range(depth + 1, len(stack))):
                depth = 0                              # an inline end tag does not close blocks
            if depth:
                links -= sum(t == "a" for t, _ in stack[depth:])
                if any(t in BLOCK for t, _ in stack[depth:]):
                    block += 1
                del stack[depth:]
            continue
        if tag == "br":
            tree.segments.append((stack[-1][1], block, " ", False))
            continue
        if tag in VOID:
            block += tag == "hr"
            continue
        if tag in RAW:
            close = RAW[tag].search(page, at)
            at = close.end() if close else end
            continue
        if tag in BLOCK:
            block += 1
            wanted, stops = CLOSES.get(tag, (set(), set()))
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i][0]
                if t in wanted or t == "p":
                    links -= sum(x == "a" for x, _ in stack[i:])
                    del stack[i:]
                    if t in wanted:
                        break
                elif t in stops or not wanted and t in BLOCK:
                    break
        marks = _marks(m.group(3)) if m.group(3) else (0, 0)
        node = stack[-1][1]
        if tag in BLOCK or marks != (0, 0):
            node = tree.add(tag, node, marks)
        if not m.group(3).rstrip().endswith("/") or tag in BLOCK:
            stack.append((tag, node))
            links += tag == "a"
    return tree


FEATURES = ("boiler_tag", "main_tag", "heading", "paragraph", "list", "table", "boiler_tokens", "main_tokens",
            "under_boiler", "under_main", "depth", "subtree_text", "own_text", "text_per_node", "link_density",
            "punctuation", "share_of_page", "siblings", "sibling_place", "share_of_siblings", "children")
_MARKED = [FEATURES.index(x) for x in ("boiler_tag", "main_tag", "heading", "paragraph", "list", "table",
                                       "boiler_tokens", "main_tokens", "under_boiler", "under_main")]


def features(t: Tree) -> np.ndarray:
    n = len(t.tag)
    own, linked, stops = np.zeros(n), np.zeros(n), np.zeros(n)
    for node, _, text, in_link in t.segments:
        size = len(text) - text.count(" ") - text.count("\n")
        own[node] += size
        if in_link:
            linked[node] += size
        stops[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
    parent = t.parent
    sub, sub_link, sub_stop, size, kids = own.tolist(), linked.tolist(), stops.tolist(), [1] * n, [0] * n
    for i in range(n - 1, 0, -1):
        p = parent[i]
        sub[p] += sub[i]
        sub_link[p] += sub_link[i]
        sub_stop[p] += sub_stop[i]
        size[p] += size[i]
        kids[p] += 1
    out = np.zeros((n, len(FEATURES)))
    seen = [0] * n
    total = sub[0] + 1
    under = [(0, 0)] * n
    for i in range(n):
        tag, (bad, good) = t.tag[i], t.marks[i]
        p = parent[i]
        if p >= 0:
            a, b = under[p]
            place = seen[p] / kids[p]
            seen[p] += 1
            rest = sub[i] / (sub[p] + 1)
            peers = kids[p]
        else:
            a = b = 0
            place, rest, peers = 0, 1, 1
        under[i] = (a or tag in BOILER_TAGS or bad > good, b or tag in MAIN_TAGS or good > bad)
        out[i] = (tag in BOILER_TAGS, tag in MAIN_TAGS, tag in HEADINGS, tag == "p", tag in ("ul", "ol", "li", "dl", "dd", "dt"),
                  tag in ("table", "tr", "td", "th"), bad, good, a, b, t.depth[i], np.log1p(sub[i]), np.log1p(own[i]),
                  np.log1p(sub[i] / size[i]), sub_link[i] / (sub[i] + 1), sub_stop[i] / (sub[i] + 1), sub[i] / total,
                  np.log1p(peers), place, rest, kids[i])
    return out


def weak_labels(t: Tree) -> np.ndarray:
    """1 for nodes that an article or main element holds, with no boilerplate between."""
    state = [0] * len(t.tag)
    for i in range(1, len(t.tag)):
        s = state[t.parent[i]]
        bad, good = t.marks[i]
        if t.tag[i] in MAIN_TAGS and s == 0:
            s = 1
        elif s == 1 and (t.tag[i] in BOILER_TAGS or bad > good):
            s = -1
        state[i] = s
    return np.array(state) == 1


def decode(t: Tree, logits: np.ndarray) -> list[bool]:
    """Which nodes to keep: the rooted subtree of the largest sum of log-odds, a
    node's log-odds weighed by its own text."""
    own = [0] * len(t.tag)
    for node, _, text, _ in t.segments:
        own[node] += len(text)
    value = (np.clip(logits, -6, 6) * (0.25 + np.log1p(np.array(own)))).tolist()
    for i in range(len(value) - 1, 0, -1):
        if value[i] > 0:
            value[t.parent[i]] += value[i]
    keep = [True] * len(value)              # the root is the page itself
    for i in range(1, len(value)):
        keep[i] = keep[t.parent[i]] and value[i] > 0
    return keep


def render(t: Tree, keep: list[bool]) -> str:
    out, now, parts = [], -1, []
    for node, block, text, _ in t.segments:
        if block != now:
            if parts:
                out.append(" ".join(_html.unescape("".join(parts)).split()))
            now, parts = block, []
        if keep[node]:
            parts.append(text)
    if parts:
        out.append(" ".join(_html.unescape("".join(parts)).split()))
    return "\n".join(x for x in out if x)


def train(pages: list[str]) -> gbt.Boosted | None:
    rows, labels = [], []
    for page in pages:
        t = parse(page)
        rows.append(features(t)[1:])
        labels.append(weak_labels(t)[1:])
    if not rows:
        return None
    x, y = np.concatenate(rows), np.concatenate(labels).astype(float)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(5)
    blank = x.copy()
    blank[:, _MARKED] = 0
    token = x.copy()                        # the tags turned into tokens, as in pages of div elements
    token[:, FEATURES.index("boiler_tokens")] += token[:, FEATURES.index("boiler_tag")]
    token[:, FEATURES.index("main_tokens")] += token[:, FEATURES.index("main_tag")]
    token[:, [FEATURES.index("boiler_tag"), FEATURES.index("main_tag")]] = 0
    bad = (y == 0) & ((x[:, 0] > 0) | (x[:, 6] > x[:, 7]) | (x[:, 8] > 0))
    moved = token[bad]                      # boilerplate inside the article
    moved[:, FEATURES.index("under_main")] = 1
    like = x[y == 1]                        # and prose below a boilerplate element: notices, comments
    like[:, FEATURES.index("main_tag")] = 0
    like[:, FEATURES.index("main_tokens")] = 0
    mark = rng.random(len(like)) < 0.5
    like[:, FEATURES.index("under_boiler")] = ~mark
    like[:, FEATURES.index("boiler_tokens")] = mark
    like[:, FEATURES.index("under_main")] = rng.random(len(like)) < 0.5
    some = rng.random(len(x)) < 0.5
    parts = [x, token, blank[some], x[bad], moved, like]
    return gbt.fit(np.concatenate(parts), np.concatenate(
        [y, y, y[some], np.zeros(2 * int(bad.sum()) + len(like))]))


def extract_all(pages: list[str], model: gbt.Boosted | None) -> list[str]:
    trees = [parse(p) for p in pages]
    if not trees:
        return []
    x = [features(t) for t in trees]
    # without a model, or where it keeps nothing: all but boilerplate and lists of links
    links = FEATURES.index("link_density")
    plain = [np.where((a[:, 0] > 0) | (a[:, 6] > a[:, 7]) | (a[:, 8] > 0) | (a[:, links] > 0.5), -3.0, 3.0) for a in x]
    if model is None:
        return [render(t, decode(t, z)) for t, z in zip(trees, plain)]
    logits = np.split(model.logits(np.concatenate(x)), np.cumsum([len(a) for a in x])[:-1])
    return [render(t, decode(t, z)) or render(t, decode(t, p)) for t, z, p in zip(trees, logits, plain)]


def fit_model(pages: DataFrame) -> gbt.Boosted | None:
    chosen = pages.select("page_id").where("page_id is not null").distinct() \
        .orderBy(F.xxhash64("page_id"), "page_id").limit(TRAIN_PAGES)
    rows = pages.select("page_id", F.col("html").cast("string").alias("html")).join(chosen, "page_id") \
        .groupBy("page_id").agg(F.min("html").alias("html")).toArrow() \
        .sort_by([("page_id", "ascending")])
    return train([x for x in rows["html"].to_pylist() if x])


def _extractor(model):
    def run(batches):
        for b in batches:
            pages = [x or "" for x in b.column(2).to_pylist()]
            texts = []
            for lo in range(0, len(pages), 64):
                texts += extract_all(pages[lo:lo + 64], model)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return run


def extract_main_text(pages: DataFrame, model: gbt.Boosted | None) -> DataFrame:
    """Per row of ``pages``: page_id, url, text and n_chars."""
    bounded_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(_extractor(model), "page_id long, url string, text string, n_chars long")


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_main_text(pages, fit_model(pages))
