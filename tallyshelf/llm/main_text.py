"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element that is no mere inline mark-up is a node with a hidden label: content or not. A node has a unary
potential, a sum of weights of its features (tag, words of class, id and role, amounts of own text, share of
links), and each parent and child have a pairwise potential, by the parent's and the child's label and the
child's kind. As the graph is a tree, one pass of sum-product messages up and one down give every node's exact
marginal. The weights are fitted by gradient ascent of the labelled pages' likelihood, whose gradient comes
from the same marginals. A text block is kept if its node's marginal of content is a half or more.

Labelled pages are the hand-labelled ones in `LABELLED_PAGES`, and a bounded sample of the corpus' own pages
(`sample_pages`, in the order of a hash of the id) that tell their content themselves: what is in `article` or
`main` but in no element of `NOT_CONTENT_TAGS`, nor of a class or id in `NOT_CONTENT_WORDS`.

Defined cases: null and empty html, and a page without content, give empty text; broken, unclosed or truncated
mark-up is read as far as it goes, and an unclosed button, frame or drawing takes no text with it; white space in a block becomes one space; blocks are joined by an empty
line; nothing is cut, whatever the length; repeated rows and ids give rows of their own; other columns are not
read. With an empty table only the hand-labelled pages are learnt from.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import sample_by_hash, table, text_groups

# Element kinds of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rt rp s samp "
    "small span strike strong sub sup time tt u var wbr object "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded msub msup msubsup munder mover munderover "
    "mtable mtr mtd semantics annotation".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
SKIPPED = frozenset("noscript template select button svg iframe".split())
P_CLOSERS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
NOT_CONTENT_TAGS = frozenset("nav header footer aside form menu dialog head".split())
NOT_CONTENT_WORDS = frozenset(
    "ad ads advert advertisement sponsor sponsored promo comment comments respond replies sidebar side nav navbar "
    "menu breadcrumb breadcrumbs cookie cookies consent notice banner popup modal newsletter subscribe share social "
    "related recommended footer header masthead pagination pager login signup search widget".split()
)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)",
                   re.S)
NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MAX_DEPTH = 200


@dataclass
class Page:
    """A page's nodes in page order (parents first), and its text blocks with the node each belongs to."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    words: list[list[str]] = field(default_factory=lambda: [[]])
    block_node: list[int] = field(default_factory=list)
    block_text: list[str] = field(default_factory=list)
    block_link: list[int] = field(default_factory=list)


@lru_cache(maxsize=1024)
def _tags(*names: str) -> re.Pattern:
    """Any of these tags, closing ones by a slash before the name."""
    return re.compile(rf"<({'|'.join(map(re.escape, names))})(?![^\s/>])[^>]*(?:>|\Z)", re.I)


def parse(source: str) -> Page:
    """The page's tree; elements deeper than MAX_DEPTH are put there.

    Raw text goes up to its closing tag or the end of the page, as in HTML. An element of SKIPPED is left out if it is
    closed before the next one of its kind and before an element around it ends; else only its tag is, not what follows.
    """
    page = Page()
    stack: list[tuple[str, int]] = [("#page", 0)]
    texts: list[str] = []
    links = link_depth = at = 0

    def flush() -> None:
        nonlocal links
        if texts:
            text = " ".join(entities.unescape("".join(texts)).split())
            if text:
                page.block_node.append(stack[-1][1])
                page.block_text.append(text)
                page.block_link.append(min(links, len(text)))
            texts.clear()
            links = 0

    def pop(to: int) -> None:
        nonlocal link_depth
        if any(tag not in INLINE for tag, _ in stack[to:]):
            flush()
        link_depth = max(0, link_depth - sum(tag == "a" for tag, _ in stack[to:]))
        del stack[to:]

    end = len(source)
    while at < end:
        m = TOKEN.search(source, at)
        text = source[at : m.start() if m else end]
        if text:
            texts.append(text)
            if link_depth:
                links += len(text)
        if not m:
            break
        at = m.end()
        name = m[2] or m[6]
        if not name:
            continue
        tag, closing, attributes = name.lower(), m[1] or m[5], m[3] or m[7] or ""
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
            continue
        if tag in RAW:
            close = _tags(f"/{tag}").search(source, at)
            at = close.end() if close else end
            texts.append(" ")
            continue
        if tag in SKIPPED:
            if not attributes.rstrip().endswith("/"):
                around = {f"/{t}" for t, _ in stack[1:] if t != tag}
                close = _tags(tag, f"/{tag}", *sorted(around)).search(source, at)
                if close and close[1].lower() == f"/{tag}":
                    at = close.end()
            texts.append(" ")
            continue
        if tag == "br":
            texts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in P_CLOSERS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if tag in CLOSES:
            ended, limits = CLOSES[tag]
            to = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in limits:
                    break
                if stack[k][0] in ended:
                    to = k
            if to:
                pop(to)
        if tag in INLINE:
            # Inline elements beyond these many open ones have no effect.
            if len(stack) < 4 * MAX_DEPTH:
                link_depth += tag == "a"
                stack.append((tag, stack[-1][1]))
            continue
        flush()
        up = stack[-1][1]
        while page.depth[up] >= MAX_DEPTH:
            up = page.parent[up]
        page.parent.append(up)
        page.depth.append(page.depth[up] + 1)
        page.tag.append(tag)
        named = NAMES.findall(attributes) if "=" in attributes else ()
        page.words.append(sorted({w.lower() for _, a, b, c in named for w in WORD.findall(a or b or c)}))
        stack.append((tag, len(page.tag) - 1))
    flush()
    return page


def _bucket(value: float, *bounds: float) -> int:
    return sum(value >= b for b in bounds)


def features(page: Page) -> list[list[str]]:
    """Names of each node's features."""
    n = len(page.tag)
    own, own_link, stops = [0] * n, [0] * n, [0] * n
    for node, text, link in zip(page.block_node, page.block_text, page.block_link, strict=True):
        own[node] += len(text)
        own_link[node] += link
        stops[node] += text.count(". ") + text.endswith((".", "!", "?"))
    whole, whole_link = own[:], own_link[:]
    for k in range(n - 1, 0, -1):
        whole[page.parent[k]] += whole[k]
        whole_link[page.parent[k]] += whole_link[k]
    barred = [False] * n
    out = []
    for k in range(n):
        names = ["bias", f"tag {page.tag[k]}", *(f"word {w}" for w in page.words[k])]
        if page.tag[k] in NOT_CONTENT_TAGS or not NOT_CONTENT_WORDS.isdisjoint(page.words[k]):
            barred[k] = True
            names.append("barred")
        elif k and barred[page.parent[k]]:
            barred[k] = True
            names.append("in barred")
        names.append(f"own {_bucket(own[k], 1, 25, 80, 250)}")
        if own[k]:
            names += [f"own link {_bucket(own_link[k] / own[k], 0.01, 0.3, 0.7)}", f"stops {_bucket(stops[k], 1, 3)}"]
        names.append(f"all {_bucket(whole[k], 1, 100, 1000)}")
        if whole[k]:
            names.append(f"all link {_bucket(whole_link[k] / whole[k], 0.05, 0.3, 0.7)}")
        out.append(names)
    return out


KINDS = 3


def _kind(tag: str) -> int:
    """Kinds of children that have pairwise potentials of their own: text elements, list and table parts, the rest."""
    return 0 if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote") else 1 if tag in (
        "ul", "ol", "li", "dl", "dt", "dd", "table", "tbody", "tr", "td", "th") else 2


@dataclass
class Forest:
    """The trees of several pages as one: arrays over nodes, and the nodes of each depth."""

    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]
    rows: np.ndarray
    columns: np.ndarray


def forest(pages: list[Page], numbers: dict[str, int], grow: bool = False) -> Forest:
    parent, kind, depth, rows, columns = [], [], [], [], []
    base = 0
    for page in pages:
        parent += [p + base if p >= 0 else -1 for p in page.parent]
        kind += map(_kind, page.tag)
        depth += page.depth
        for k, names in enumerate(features(page)):
            for name in names:
                number = numbers.setdefault(name, len(numbers)) if grow else numbers.get(name)
                if number is not None:
                    rows.append(base + k)
                    columns.append(number)
        base += len(page.tag)
    depths = np.array(depth)
    order = np.argsort(depths, kind="stable")
    levels = np.split(order, np.cumsum(np.bincount(depths))[:-1]) if len(depths) else []
    return Forest(np.array(parent), np.array(kind), levels, np.array(rows, int), np.array(columns, int))


def marginals(trees: Forest, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product over all trees: P(label) of each node, and P(parent's, own label) of each node but roots.

    unary: log potentials [node, label]; pair: log potentials [kind of child, parent's label, own label].
    """
    n = len(trees.parent)
    below = unary.copy()
    message = np.zeros((n, 2))
    for nodes in trees.levels[:0:-1]:
        joint = pair[trees.kind[nodes]] + below[nodes][:, None, :]
        message[nodes] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
        np.add.at(below, trees.parent[nodes], message[nodes])
    above = np.zeros((n, 2))
    both = np.zeros((n, 2, 2))
    for nodes in trees.levels[1:]:
        up = trees.parent[nodes]
        outside = above[up] + below[up] - message[nodes]
        joint = outside[:, :, None] + pair[trees.kind[nodes]]
        above[nodes] = np.logaddexp(joint[:, 0], joint[:, 1])
        joint = joint + below[nodes][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        both[nodes] = joint / joint.sum(axis=(1, 2), keepdims=True)
    belief = above + below
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True), both


@dataclass
class TreeModel:
    numbers: dict[str, int]
    weights: np.ndarray
    pair: np.ndarray

    def content(self, pages: list[Page]) -> np.ndarray:
        """Marginal probability of content, over the nodes of all pages in a row."""
        trees = forest(pages, self.numbers)
        unary = np.zeros((len(trees.parent), 2))
        unary[:, 1] = np.bincount(trees.rows, self.weights[trees.columns], len(trees.parent))
        return marginals(trees, unary, self.pair)[0][:, 1]


def labels_of(page: Page) -> np.ndarray | None:
    """Labels that a page's own mark-up tells; None if it doesn't."""
    if not any(t in ("article", "main") for t in page.tag):
        return None
    out = np.zeros(len(page.tag), int)
    barred = np.zeros(len(page.tag), bool)
    for k in range(1, len(page.tag)):
        up = page.parent[k]
        barred[k] = barred[up] or page.tag[k] in NOT_CONTENT_TAGS or not NOT_CONTENT_WORDS.isdisjoint(page.words[k])
        out[k] = not barred[k] and (out[up] or page.tag[k] in ("article", "main"))
    return out


def hand_labels(page: Page) -> np.ndarray:
    """Labels of a hand-labelled page: the word `yes` in a class starts content, `no` ends it."""
    out = np.zeros(len(page.tag), int)
    for k in range(1, len(page.tag)):
        out[k] = 1 if "yes" in page.words[k] else 0 if "no" in page.words[k] else out[page.parent[k]]
        page.words[k] = [w for w in page.words[k] if w not in ("yes", "no")]
    return out


def fit(pages: list[Page], labels: list[np.ndarray], share: np.ndarray, steps: int = 300, ridge: float = 1e-4) -> TreeModel:
    """Weights that maximise the pages' likelihood, each page weighted by its share."""
    numbers: dict[str, int] = {}
    trees = forest(pages, numbers, grow=True)
    y = np.concatenate(labels)
    weight = np.repeat(share, [len(x) for x in labels])
    weight = weight / weight.sum()
    inner = trees.parent >= 0
    truth = np.zeros((len(y), 2, 2))
    truth[np.flatnonzero(inner), y[trees.parent[inner]], y[inner]] = 1
    w, pair = np.zeros(len(numbers)), np.zeros((KINDS, 2, 2))
    pair[:] = np.log([[0.8, 0.2], [0.2, 0.8]])
    squares = [np.full(w.shape, 1e-6), np.full(pair.shape, 1e-6)]
    for step in range(steps):
        unary = np.zeros((len(y), 2))
        unary[:, 1] = np.bincount(trees.rows, w[trees.columns], len(y))
        one, two = marginals(trees, unary, pair)
        gap = weight * (y - one[:, 1])
        by_node = weight[:, None, None] * (truth - two)
        by_node[~inner] = 0
        slope_pair = np.stack([by_node[trees.kind == k].sum(axis=0) for k in range(KINDS)])
        slopes = [np.bincount(trees.columns, gap[trees.rows], len(w)) - ridge * w, slope_pair - ridge * pair]
        for value, slope, square in zip((w, pair), slopes, squares, strict=True):
            square *= 0.9
            square += 0.1 * slope**2
            value += 0.15 / (1 + step / 50) * slope / np.sqrt(square + 1e-10)
    return TreeModel(numbers, w, pair)


_LONG = "Some sentences of running text, long enough to be a paragraph of an article. They end with stops, and go on. " * 3
_SHORT = "A short line."
LABELLED_PAGES = [
    f"""<body><header class="no"><a href=x>Home</a> <a href=x>News</a></header><nav class="no"><ul><li><a href=x>One</a>
    </li><li><a href=x>Two</a></li></ul></nav><div id="content" class="yes"><h1>Title</h1><p>{_LONG}</p><p>{_SHORT}</p>
    <ul><li>{_SHORT}</li><li>Second point</li></ul><blockquote><p>{_LONG}</p></blockquote><h2>Part</h2><p>{_LONG}</p>
    <div class="ad no">Buy now, cheap offers today.</div><p>{_LONG}</p></div><aside class="sidebar no"><h3>More</h3>
    <p>{_SHORT}</p><ul><li><a href=x>Linked</a></li></ul></aside><div id="comments" class="no"><h3>Comments</h3>
    <div class="comment"><p>{_SHORT}</p></div><div class="comment"><p>{_LONG}</p></div></div>
    <footer class="no"><p>All rights reserved.</p></footer></body>""",
    f"""<body><div class="cookie notice no"><p>We use cookies. {_LONG}</p><button>OK</button></div><div class="header no">
    <a href=x>Logo</a></div><div class="menu no"><a href=x>One</a> <a href=x>Two</a></div><main class="yes"><article>
    <h1>Title</h1><p>{_SHORT}</p><p>{_LONG}</p><table><tr><td>1</td><td>Cell</td></tr></table><pre>x = 1</pre><p>{_LONG}</p>
    <section class="comments no"><h2>Reader comments</h2><ul><li><p>{_LONG}</p></li><li><p>{_SHORT}</p></li></ul>
    <form><label>Name</label><p>Leave a reply.</p></form></section><div class="share social no"><a href=x>Share</a></div>
    <div class="related no"><h3>Related</h3><ul><li><a href=x>A linked title</a></li></ul></div></article></main>
    <div class="footer no"><p>Imprint and terms.</p></div></body>""",
    f"""<body><div class="top banner no"><p>{_SHORT}</p></div><div><div class="post yes"><h2>Title</h2><p>{_LONG}</p>
    <p>{_LONG}</p><div><p>{_SHORT}</p></div></div><div class="promo no"><p>{_SHORT}</p></div><div class="newsletter no">
    <form><p>Subscribe to our letter for news. {_SHORT}</p></form></div></div><div class="side widget no"><p>{_SHORT}</p>
    <p><a href=x>All posts</a></p></div></body>""",
    f"""<body><h1 class="yes">Title</h1><p class="yes">{_LONG}</p><p class="yes">{_LONG}</p><p class="yes">{_SHORT}</p>
    <p class="no"><a href=x>Next</a> <a href=x>Back</a></p></body>""",
    f"""<body><div class="breadcrumb nav no"><a href=x>Home</a> / <a href=x>Blog</a></div><div class="entry yes"><p>{_SHORT}
    </p><p>{_SHORT}</p><p>{_LONG}</p></div><div class="sponsored advertisement no"><p>{_LONG}</p></div><div id="respond"
    class="no"><p>{_SHORT}</p></div><div class="login search modal popup no"><form><p>Sign in.</p></form></div></body>""",
]


def train(samples: list[str]) -> TreeModel:
    """A model of the hand-labelled pages and of those samples that tell their content; each half weighs the same."""
    pages = [parse(p) for p in LABELLED_PAGES]
    labels = [hand_labels(p) for p in pages]
    mine = len(pages)
    for sample in samples:
        page = parse(sample)
        known = labels_of(page)
        if known is not None:
            pages.append(page)
            labels.append(known)
    sizes = np.array([len(x) for x in labels], float)
    share = np.ones(len(pages))
    share[:mine] /= sizes[:mine].sum()
    share[mine:] /= max(sizes[mine:].sum(), 1)
    return fit(pages, labels, share)


TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
GROUP_BYTES = 1 << 20


def _extractor(model: TreeModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches, GROUP_BYTES):
            pages = [parse(t) for t in group["text"].to_pylist()]
            content = model.content(pages)
            base, texts = 0, []
            for page in pages:
                kept = [t for k, t in zip(page.block_node, page.block_text, strict=True) if content[base + k] >= 0.5]
                texts.append("\n\n".join(kept))
                base += len(page.tag)
            yield pa.RecordBatch.from_arrays(
                [
                    group["page_id"].combine_chunks(),
                    group["url"].combine_chunks(),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                schema=TEXTS,
            )

    return run


def extract_main_text(pages: DataFrame, sample_pages: int = 400, model: TreeModel | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("text"),
    )
    if model is None:
        sample = sample_by_hash(rows, "page_id", sample_pages, "page_id", "text")
        model = train([r["text"] for r in sample.select("text").collect()])
    return rows.mapInArrow(_extractor(model), "page_id long, url string, text string, n_chars long")


def q_main_text(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
