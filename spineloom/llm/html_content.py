"""Main text of web pages by a tree-structured graphical model.

The nodes are a page's block elements; each is content or not. A node's own potential comes from its tag, the words of its class,
id and role, and its text's length, links and punctuation (naive Bayes log-odds); an edge's potential from how often
children keep or change their parent's state. Sum-product message passing, upward from the leaves and downward from the
root, gives every node's marginal, and blocks of nodes with a marginal of at least one half are the main text. Edges
have potentials by kind: to a page part (``div``, ``section``, ``aside``, ...), to a plain element inside one (``p``, ``li``,
``h2``, ...), which nearly always shares its parent's state, and to a plain element directly under the body.

Training pages are labelled in two ways: layouts written here, whose elements say whether they are content, and the corpus
pages that mark up their article themselves (``article``, else ``main``), of which at most about ``MOST_PAGES`` are read, chosen by
a hash of the page.

Text: character references are decoded, white space inside a block becomes one space, blocks are joined by one newline; a
line break inside a block is white space. Nothing else is dropped.

Defined results: null and empty pages have no text; markup that does not close is closed where its parent closes; repeated
rows are extracted alike; an empty table gives an empty result; columns of the input are kept but for those the result
adds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spineloom.functions.columns import ref
from spineloom.llm.dom import Node, Page, parse
from spineloom.llm.tables import through_arrow, widened
from spineloom.llm.words import slices

MOST_PAGES = 2000
KEEP = 0.5
#: Added to the counts of a feature in both states, and the most that one feature of names or of text says (log-odds).
SMOOTHING = 0.5
MOST_BY_NAME, MOST_BY_TEXT, MOST_BY_LINKS = 6.0, 0.3, 3.0
#: What the corpus pages weigh together, against the layouts written here: they show few kinds of parts.
CORPUS_WEIGHT = 0.3
#: Lengths of the texts in the layouts written here: content and other parts.
CONTENT_SIZES, OTHER_SIZES = (15, 60, 150, 400, 1200, 2500), (8, 20, 45, 90, 200, 500)

# Elements and class words of page parts. A part stands beside the article, inside it, or in both places.
CONTENT_ROOTS = (
    "article", "main", "article", "article", "main", "article.post", "div.content", "div.post", "div.entry", "section.article", "div.story", "div.body", "div.text",
)
CONTENT_PARTS = ("p", "h1", "h2", "h3", "ul>li", "ol>li", "ul>li>p", "p", "blockquote>p", "pre", "figure>figcaption", "table>tr>td", "section>p", "div>p", "dl>dd", "section>h2", "div>ul>li", "section>blockquote")
OTHER_PARTS = (
    "nav>ul>li", "header>p", "header>ul>li", "footer>p", "aside>p", "aside>ul>li", "form>p", "form>div", "ul.menu>li",
    "div.menu>ul>li", "div.navbar>ul>li", "div.navigation>ul>li", "div.breadcrumb>p", "div.breadcrumbs>ul>li", "div.sidebar>p",
    "div.sidebar>ul>li", "div.widget>p", "div.ad", "div.ads>p", "div.advert>p", "div.advertisement>p", "div.adsense>p",
    "div.banner>p", "div.sponsor>p", "div.sponsored>p", "div.promo>p", "div.cookie>p", "div.cookies>p", "div.consent>p",
    "div.notice>p", "div.popup>p", "div.modal>p", "div.newsletter>p", "div.subscribe>p", "div.signup>form>p", "div.share>ul>li",
    "div.social>ul>li", "div.related>ul>li", "div.recommended>p", "div.pagination>ul>li", "div.tags>ul>li", "div.login>form>p",
    "div.search>form>p", "div.footer>p", "div.header>p", "div.copyright>p", "div.comments>div.comment>p", "section.comments>p",
    "div.comment>p", "ul.comments>li.comment>p", "ol.commentlist>li>p", "div.disqus>p", "div.respond>form>p", "div.reviews>p",
    "div.replies>div.reply>p", "div.disclaimer>p", "dialog>p", "div.toolbar>p",
    "header>h1", "header>h2", "div.header>h1", "aside>h2", "aside>h3", "footer>h3", "footer>table>tr>td", "div.sidebar>h3",
    "div.widget>h3", "div.related>h2", "div.related>h3", "section.comments>h2", "div.comments>h2", "div.comments>h3",
    "div.comment>blockquote>p", "div.comments>ol>li", "div.cookie>h2", "div.newsletter>h3", "form>h2", "form>table>tr>td",
    "form>ul>li", "nav>h2", "nav>dl>dd", "nav>ol>li", "div.ad>figure>figcaption", "div.promo>h3", "aside>section>p",
)


# Elements that structure a text rather than a page.
PLAIN = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr td th caption hr"
    " label legend fieldset button option address center".split()
)
EDGES = ("part", "plain", "body")


def _edge(page: Page, k: int) -> str:
    """The kind of the edge above node k."""
    if page.nodes[k].tag not in PLAIN:
        return "part"
    return "body" if page.nodes[page.nodes[k].parent].tag in ("#page", "html", "body") else "plain"


def _features(node: Node) -> list[str]:
    density = node.linked / node.size if node.size else 0.0
    out = [
        f"tag {node.tag}",
        f"size {min(12, node.size.bit_length())}",
        f"links {0 if not node.linked else 1 + int(3 * min(density, 1.0))}",
        f"stops {min(4, (100 * node.stops // node.size)) if node.size else 5}",
    ]
    return out + [f"name {n}" for n in node.names]


@dataclass(frozen=True)
class Model:
    """Log-odds of features, and log potentials by kind of edge [parent's state][child's state] (0: other, 1: content)."""

    odds: dict[str, float]
    edges: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    @staticmethod
    def from_counts(counts: Counter) -> Model:
        """``counts``: of ("feature", name, state) and ("edge", kind and parent's state, state)."""
        sizes, own, edges = [1.0, 1.0], {}, {kind: [[1.0, 1.0], [1.0, 1.0]] for kind in EDGES}
        for (kind, name, state), n in counts.items():
            if kind == "edge":
                edge, above = name.split()
                edges[edge][int(above)][state] += n
            else:
                own.setdefault(name, [SMOOTHING, SMOOTHING])[state] += n
                if name.startswith("tag "):
                    sizes[state] += n
        # Of each state, the share of nodes with the feature; the states themselves are weighed by the edges.
        odds = {}
        for f, n in own.items():
            kind = f.split()[0]
            most = MOST_BY_NAME if kind in ("tag", "name") else MOST_BY_TEXT
            least = MOST_BY_LINKS if kind == "links" else most
            odds[f] = max(-least, min(most, math.log(n[1] / sizes[1]) - math.log(n[0] / sizes[0])))
        logs = {kind: tuple(tuple(math.log(x / sum(row)) for x in row) for row in t) for kind, t in edges.items()}
        return Model(odds, logs)


def marginals(page: Page, model: Model) -> list[float]:
    """The probability of each node to be content, by one upward and one downward pass."""
    n = len(page.nodes)
    own = [0.0] * n  # log-odds of the node's own potential
    for k, node in enumerate(page.nodes):
        own[k] = sum(model.odds.get(f, 0.0) for f in _features(node))
    edges = [model.edges[_edge(page, k)] if k else () for k in range(n)]
    below = own[:]  # log-odds of the node with everything under it
    sent = [0.0] * n
    for k in range(n - 1, 0, -1):
        x = below[k]
        (e00, e01), (e10, e11) = edges[k]
        # The message to the parent: log of sum over the child's states, for content less for other.
        sent[k] = _log_add(e10, e11 + x) - _log_add(e00, e01 + x)
        below[page.nodes[k].parent] += sent[k]
    belief = below[:]
    belief[0] = -20.0 + below[0]  # the page as a whole is no content
    for k in range(1, n):
        (e00, e01), (e10, e11) = edges[k]
        rest = belief[page.nodes[k].parent] - sent[k]
        belief[k] = below[k] + _log_add(e01, e11 + rest) - _log_add(e00, e10 + rest)
    return [1 / (1 + math.exp(-max(-500.0, min(500.0, b)))) for b in belief]


def _log_add(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log1p(math.exp(min(a, b) - high))


def main_text(html: str | None, model: Model) -> str:
    page = parse(html)
    if not page.blocks:
        return ""
    content = marginals(page, model)
    return "\n".join(text for node, text in page.blocks if content[node] >= KEEP)


def _counted(page: Page, states: list[int], weight: int = 1) -> Counter:
    out: Counter = Counter()
    for k, node in enumerate(page.nodes):
        for f in _features(node):
            out["feature", f, states[k]] += weight
        if k:
            out["edge", f"{_edge(page, k)} {states[node.parent]}", states[k]] += weight
    return out


def _element(path: str, text: str, mark: str) -> str:
    names = [p.partition(".") for p in path.split(">")]
    opened = "".join(f'<{tag}{f" class={name!r}" if name else ""} data-content="{mark}">' for tag, _, name in names)
    return opened + text + "".join(f"</{tag}>" for tag, _, _ in reversed(names))


def layouts() -> Iterator[str]:
    """Labelled pages: every kind of content element and of other part, beside and inside every kind of article."""
    prose = "A sentence of ordinary length, with a comma, says what the page is about. " * 40
    link = '<a href="/x">A link</a> '
    n = len(OTHER_PARTS)
    for k, root in enumerate(CONTENT_ROOTS):
        tag, _, name = root.partition(".")
        for j in range(n):
            inner = [
                _element(part, prose[: CONTENT_SIZES[(k + j + i) % len(CONTENT_SIZES)]], "1")
                for i, part in enumerate(CONTENT_PARTS[j % 3 :: 3])
            ]
            # Five other parts a page: before the article, after it, and every third time one inside.
            others = []
            for i in range(5):
                other = OTHER_PARTS[(j + i * (n // 5)) % n]
                words = link * 2 if other.endswith("li") or (k + i) % 3 == 0 else prose[: OTHER_SIZES[(k + j + i) % len(OTHER_SIZES)]]
                others.append((other, _element(other, words, "0")))
            inside = ""
            if j % 3 == 1:
                inside = others.pop(0)[1]
            parts = [html for _, html in others]
            article = f'<{tag}{f" class={name!r}" if name else ""} data-content="1">{"".join(inner)}{inside}</{tag}>'
            if (j + k) % 6 == 0:  # a page without an element around its article
                article = "".join(inner)
            yield f'<html data-content="0"><body data-content="0">{"".join(parts[:2])}{article}{"".join(parts[2:])}</body></html>'


def layout_counts() -> Counter:
    out: Counter = Counter()
    for html in layouts():
        page = parse(html)
        out.update(_counted(page, [int(n.marked == "1") for n in page.nodes]))
    return out


def own_labels(page: Page, basic: Model) -> list[int] | None:
    """The states of a page that marks up its article, by that element; parts inside that a model of the layouts rules out
    are no content. None for other pages."""
    tags = {n.tag for n in page.nodes}
    root = "article" if "article" in tags else "main" if "main" in tags else None
    if not root:
        return None
    sure = marginals(page, basic)
    states = [0] * len(page.nodes)
    for k, node in enumerate(page.nodes[1:], 1):
        states[k] = int((node.tag == root or states[node.parent] == 1) and sure[k] > 0.05)
    return states


def fit(pages: DataFrame, html_col: str = "html") -> Model:
    basic_counts = layout_counts()
    basic = Model.from_counts(basic_counts)
    key = F.xxhash64(html_col)
    share = min(1.0, MOST_PAGES / max(1, pages.count()))
    chosen = pages.where(F.pmod(key, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select(html_col)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for html in batch.column(0).to_pylist():
                page = parse(html)
                states = own_labels(page, basic)
                if states:
                    total.update(_counted(page, states))
        rows = [(*k, n) for k, n in total.items()]
        columns = zip(*rows, strict=True) if rows else [[], [], [], []]
        types = (pa.string(), pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["kind", "name", "state", "n"])

    counted = chosen.mapInArrow(task, "kind string, name string, state long, n long")
    found = counted.groupBy("kind", "name", "state").agg(F.sum("n").alias("n")).collect()
    own = {(r.kind, r.name, r.state): r.n for r in found}
    size = lambda counts: sum(n for (_, name, _), n in counts.items() if name.startswith("tag "))
    weight = CORPUS_WEIGHT * size(basic_counts) / max(1, size(own))
    return Model.from_counts(basic_counts + Counter({k: n * weight for k, n in own.items()}))


def extract(pages: DataFrame, html_col: str = "html", model: Model | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points); without a model, one is trained first."""
    shared = pages.sparkSession.sparkContext.broadcast(model or fit(pages, html_col))
    kept = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    source = pages.select(*map(ref, kept), ref(html_col).cast("string").alias("__html"))
    schema = widened(source.drop("__html").schema, "text string, n_chars long")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, "__html"):
                texts = [main_text(html, own) for html in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*kept, "text", "n_chars"],
                )

    return through_arrow(source, task, schema)
