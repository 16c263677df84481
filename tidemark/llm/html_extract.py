"""Main text of web pages by a tree-structured graphical model.

The block elements of a page are the nodes of a tree. Each is content, a shell (an element around the content
that is not content itself, as <body>), or beside both. A log-linear model gives a node's own evidence: its tag, the words of
its class and id, how much of its text is links, how long the text is and how much of the page it makes up. No evidence is
taken from the elements above a node: a table of parent-child potentials says how well two states go together on an
edge, and sum-product messages, leaves to root and root to leaves, carry what is known of one node to the others. The
text of nodes whose marginal of content is over one half is the main text.

Weights and potentials are fitted together, by the gradient of the likelihood of labelled pages under the whole tree: the
built-in ones, and up to `pages` pages of the corpus that say with <article> or <main> where their content is (smallest
hashes first, of at most LONGEST bytes; this is the only sampling). They are a few hundred numbers and go to the tasks in the closure.

Defined results: null or empty html gives an empty text; tags cut off at the end of a page are
dropped; references without a name stay as they are; <br> is white space inside its block;
repeated rows and null ids or urls are kept as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sampled

LABELLED_PAGES = 300
LONGEST = 100_000  # bytes of a page to learn from
TOGETHER = 1 << 20  # characters of html whose trees are solved together, one page at least
OWN_WEIGHT = 0.3  # of the pages of the corpus in the fit, against the built-in ones
BESIDE, CONTENT, SHELL = range(3)

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style template noscript head title iframe object svg math canvas".split())
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol option p pre search section select "
    "summary table tbody td textarea tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - set("button body html caption td th tr tbody thead tfoot option legend summary".split())
SIBLINGS = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tr": {"tr", "td", "th"}, "option": {"option"},
}
HOLDS = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}, "option": {"select"}}

AROUND = set("nav aside footer header form menu button select textarea dialog search fieldset".split())
NOISE_WORDS = set(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert warning comment comments reply replies respond discussion disqus sidebar aside menu nav navbar navigation "
    "breadcrumb breadcrumbs footer foot header masthead share sharing social related recommended recommendations newsletter "
    "subscribe signup login search form widget popup modal overlay toolbar pagination pager topbar skip".split()
)
MAIN_WORDS = set("article content main post story entry text body prose".split())
TAGS = (
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure figcaption "
    "nav aside footer header form menu button select textarea dialog search fieldset"
).split()
TAG_AT = {t: k for k, t in enumerate(TAGS)}
WIDTH = len(TAGS) + 16
# A class such as has-sidebar or comments-open tells of the page, not what the element is.
STATE_WORDS = set("has have no not is with without enabled disabled fixed closed open active visible hidden".split())
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Page(HTMLParser):
    """Block elements in page order with their parent, and the texts of their blocks."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.marks = ["html"], [-1], [None]
        self.words, self.states = [frozenset()], [frozenset()]
        self.chars, self.linked = [0], [0]
        self.stack: list[tuple[str, int]] = [("html", 0)]
        self.silent, self.links = 0, 0
        self.blocks: list[tuple[int, str]] = []
        self.parts: list[str] = []
        self.feed(html)
        if self.rawdata.startswith("<"):
            self.rawdata = ""
        self.close()
        self.flush()

    def node(self) -> int:
        return self.stack[-1][1]

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((self.node(), text))
            self.parts = []

    def pop(self, at: int) -> None:
        while len(self.stack) > at:
            tag, _ = self.stack[-1]
            if tag in BLOCKS:
                self.flush()
            self.stack.pop()
            self.silent -= tag in SILENT
            self.links -= tag == "a"

    def close_one_of(self, names: set[str], limits: set[str]) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[at][0]
            if tag in names:
                self.pop(at)
                return
            if tag in limits:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "body" or tag not in SILENT and any(t == "head" for t, _ in self.stack[:3]):
            self.close_one_of({"head"}, set())
        if tag in VOID:
            if tag in ("br", "hr", "img", "wbr"):
                self.parts.append(" " if tag != "wbr" else "")
            return
        if tag in BLOCKS:
            if tag in CLOSES_P:
                self.close_one_of({"p"}, BLOCKS - {"p"})
            if tag in SIBLINGS:
                self.close_one_of(SIBLINGS[tag], HOLDS[tag])
            self.flush()
            if tag == "html":
                return
            values = dict(attrs)
            names = " ".join(filter(None, (values.get("class"), values.get("id"), values.get("role"))))
            self.parents.append(self.node())
            self.tags.append(tag)
            words, states = set(), set()
            for name in names.split():
                found = {w.lower() for w in WORDS.findall(name)}
                (states if found & STATE_WORDS else words).update(found)
            self.words.append(frozenset(words))
            self.states.append(frozenset(states))
            self.marks.append(values.get("data-content"))
            self.chars.append(0)
            self.linked.append(0)
            self.stack.append((tag, len(self.tags) - 1))
        else:
            self.stack.append((tag, self.node()))
            self.silent += tag in SILENT
            self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        # The slash means nothing on elements that are not void.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        for at in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[at][0]
            if open_tag == tag:
                self.pop(at)
                return
            # An inline end tag does not close the block around it.
            if tag not in BLOCKS and open_tag in BLOCKS:
                return

    def handle_data(self, data):
        if self.silent or not data:
            return
        self.parts.append(data)
        size = len(data.strip())
        at = self.node()
        self.chars[at] += size
        self.linked[at] += size * (self.links > 0)

    def features(self) -> np.ndarray:
        """One row per node, of that element alone; text counts hold for all it contains."""
        chars, linked = list(self.chars), list(self.linked)
        holds = [False] * len(self.tags)
        for k in range(len(self.tags) - 1, 0, -1):
            up = self.parents[k]
            chars[up] += chars[k]
            linked[up] += linked[k]
            holds[up] = holds[up] or holds[k] or self.tags[k] in ("article", "main")
        out = np.zeros((len(self.tags), WIDTH))
        plain = max(1, chars[0] - linked[0])
        for k, tag in enumerate(self.tags):
            at = TAG_AT.get(tag)
            if at is not None:
                out[k, at] = 1
            n, share = chars[k], (chars[k] - linked[k]) / plain
            noise, main = bool(self.words[k] & NOISE_WORDS), bool(self.words[k] & MAIN_WORDS)
            out[k, len(TAGS) :] = (
                1,
                noise,
                bool(self.states[k] & NOISE_WORDS),
                main,
                main and noise,
                n > 0 and linked[k] > n / 2,
                n == 0,
                0 < n < 40,
                40 <= n < 200,
                n >= 200,
                tag in AROUND,
                share >= 0.5,
                0.2 <= share < 0.5,
                share < 0.05,
                holds[k],
                holds[0] and not holds[k] and tag not in ("article", "main"),
            )
        return out


def marked_labels(page: Page) -> np.ndarray:
    """The labels of a built-in page. On other pages data-content is somebody's own attribute."""
    marked = np.zeros(len(page.tags), dtype=int)
    for k in range(1, len(page.tags)):
        marked[k] = int(page.marks[k]) if page.marks[k] is not None else marked[page.parents[k]]
    return marked


def own_labels(page: Page) -> np.ndarray | None:
    """What a page itself says: inside <article> or <main> but not in a part around them."""
    if "article" not in page.tags and "main" not in page.tags:
        return None
    inside = np.zeros(len(page.tags), dtype=int)
    for k in range(1, len(page.tags)):
        if page.tags[k] in AROUND or page.words[k] & NOISE_WORDS:
            continue
        inside[k] = page.tags[k] in ("article", "main") or inside[page.parents[k]]
    return inside


def states(content: np.ndarray, page: Page) -> np.ndarray:
    """The state of every node: content as labelled, shells above it, the rest beside."""
    out = np.where(content > 0, CONTENT, BESIDE)
    for k in range(len(out) - 1, 0, -1):
        up = page.parents[k]
        if out[k] != BESIDE and out[up] == BESIDE:
            out[up] = SHELL
    for k, tag in enumerate(page.tags):
        if tag in ("html", "body") and out[k] == BESIDE:
            out[k] = SHELL
    return out


def _labelled_pages() -> list[str]:
    return [html for _, _, html in _labelled_kinds()]


def _labelled_kinds() -> list[tuple[int, int, str]]:
    """Built-in labelled pages as (part beside the content, shell of the content, html).

    Every kind of part stands beside and inside content with and without telling elements, under bodies and
    wrappers whose classes tell of the page's state, around long stories and short ones.
    """
    long = "A sentence of the story that says a good deal about what happened and why it did. " * 4
    short = "A short line."
    story = f"<h1>Title of it</h1><p>{long}</p><p>{short}</p><h2>Part</h2><p>{long}</p><ul><li>One thing</li><li>{long}</li></ul><blockquote>{short}</blockquote>"
    links = "<ul>" + "".join(f"<li><a href='/{k}'>Place {k}</a></li>" for k in range(5)) + "</ul>"
    around = [
        f"<nav>{links}</nav>", f"<div class='menu'>{links}</div>", "<header><h2>Site name</h2><p>Motto of the site</p></header>",
        f"<aside><h3>More</h3><p>{short}</p>{links}</aside>", f"<div class='sidebar'><p>{long}</p></div>",
        f"<div class='ad'>{short}</div>", f"<div id='advert'><p>{long}</p></div>", "<div class='cookie-notice'><p>We use cookies.</p><button>Yes</button></div>",
        "<form><p>Your name</p><input><button>Send</button></form>", f"<section class='comments'><h3>Comments</h3><div><p>{long}</p></div><div><p>{short}</p></div></section>",
        f"<div id='comments'><ul><li><p>{short}</p></li><li><p>{long}</p></li></ul></div>", "<footer><p>Company, all rights</p></footer>",
        f"<div class='related'>{links}</div>", "<div class='newsletter'><p>Subscribe now</p></div>", f"<div class='footer'>{short}</div>",
        f"<section class='comments'>{f"<div class='item'><div><p>{long}</p><p>{long}</p></div></div>" * 4}</section>", f"<aside><p>{short}</p></aside>", f"<footer>{short}</footer>",
    ]
    others = [
        f"<h1>Title of it</h1><p>{short}</p><p>Another line, no longer.</p>", f"<p>{long}</p>", f"<p>{long}</p><p>{short}</p>",
        f"<h1>Title of it</h1><p>{long}</p>", f"<p>{short}</p><ul><li>{short}</li></ul><p>{long}</p>",
    ]
    shells = [
        ("<article data-content=1>", "</article>"), ("<main data-content=1>", "</main>"), ("<div id='content' data-content=1>", "</div>"),
        ("<div class='post' data-content=1>", "</div>"), ("<main data-content=1><article>", "</article></main>"), ("<div data-content=1>", "</div>"),
        ("<div class='article-body share-enabled' data-content=1>", "</div>"), ("<section class='css-1x9 comments-open' data-content=1>", "</section>"),
        ("<article class='entry no-sidebar' data-content=1><div class='inner'>", "</div></article>"),
    ]
    wraps = [
        ("<body>", "</body>"), ("", ""), ("<body class='has-sidebar'>", "</body>"), ("<body><div id='page' class='site header-fixed'>", "</div></body>"),
        ("<body class='single-post menu-closed'><div><div class='row'>", "</div></div></body>"), ("<body class='form-page'><div class='layout sidebar-left'>", "</div></body>"),
    ]
    pages = []
    for k, part in enumerate(around):
        for j, (begin, end) in enumerate(shells):
            other = around[(k + 3 * j + 1) % len(around)]
            inner = re.sub(r"^<(\w+)", r"<\1 data-content=0", part)
            first, last = wraps[(k + j) % len(wraps)]
            pages.append((k, j, f"<body>{part}{begin}{story}{inner}<p>{long}</p>{end}{other}</body>"))
            pages.append((k, j, f"{first}{other}{begin}{story}{end}{part}{last}"))
            least = others[(k + 2 * j) % len(others)]
            pages.append((k, j, f"{first}{begin}{least}{end}{last}"))
            pages.append((k, j, f"{first}{begin}{least}{inner}<p>{short}</p>{end}{other}{last}"))
    return pages


def _add_up(x: np.ndarray) -> np.ndarray:
    """log(sum(exp(x))) over the last axis."""
    top = x.max(axis=-1)
    return top + np.log(np.exp(x - top[..., None]).sum(axis=-1))


def levels(parents: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By depth: the nodes in order of their parent, the parents, and where the children of each begin."""
    depth = np.zeros(len(parents), dtype=np.int64)
    for k, up in enumerate(parents.tolist()):
        if up >= 0:
            depth[k] = depth[up] + 1
    order = np.lexsort((parents, depth))
    out = []
    for nodes in np.split(order, np.cumsum(np.bincount(depth))[:-1]):
        above, starts = np.unique(parents[nodes], return_index=True)
        out.append((nodes, above, starts))
    return out


def messages(own: np.ndarray, parents: np.ndarray, edge: np.ndarray, by_depth: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Log beliefs of every node's states, and of (parent state, own state) of every node that has a parent.

    `own` holds a row of log evidence per node and `edge` the log potential of (parent state, child state). Trees may stand side
    by side; a root has parent -1 and children come after their parent. Messages go up and down by levels.
    """
    by_depth = levels(parents) if by_depth is None else by_depth
    belief, sent = own.copy(), np.zeros_like(own)
    below = own.copy()
    for nodes, above, starts in by_depth[:0:-1]:
        below[nodes] = belief[nodes]
        sent[nodes] = _add_up(edge[None] + below[nodes][:, None, :])
        belief[above] += np.add.reduceat(sent[nodes], starts, axis=0)
    joint = np.zeros((len(own), *edge.shape))
    for nodes, _, _ in by_depth[1:]:
        pairs = edge[None] + (belief[parents[nodes]] - sent[nodes])[:, :, None]
        joint[nodes] = pairs + below[nodes][:, None, :]
        belief[nodes] += _add_up(pairs.transpose(0, 2, 1))
    return belief - _add_up(belief)[:, None], joint


def forest(trees: Sequence[Sequence[int]]) -> np.ndarray:
    """The parents of all trees as one numbering."""
    starts = np.cumsum([0] + [len(t) for t in trees])
    return np.concatenate([np.where(np.array(t) < 0, -1, np.array(t) + at) for t, at in zip(trees, starts)])


@dataclass
class TreeModel:
    weights: np.ndarray  # feature by state
    edge: np.ndarray  # log potential by state of the parent and of the child

    def marginals(self, pages: Sequence[Page]) -> np.ndarray:
        """The probability of every node, page by page, to be content."""
        own = np.concatenate([p.features() for p in pages]) @ self.weights
        return np.exp(messages(own, forest([p.parents for p in pages]), self.edge)[0][:, CONTENT])

    def texts(self, htmls: Sequence[str]) -> list[str]:
        pages = [Page(html) for html in htmls]
        if not pages:
            return []
        content = (self.marginals(pages) > 0.5).tolist()
        out, at = [], 0
        for page in pages:
            out.append("\n".join(text for node, text in page.blocks if content[at + node]))
            at += len(page.tags)
        return out

    def text(self, html: str) -> str:
        return self.texts([html])[0]


def fit(built_in: Sequence[str], pages: Sequence[str] = (), rounds: int = 400, penalty: float = 1e-5) -> TreeModel:
    """Fitted on marked pages and on what other pages say themselves, which weigh OWN_WEIGHT of the marked ones at most.

    Pages of one corpus are often built alike; they tell of that corpus and must not drown the rarer parts. The gradient is that of the likelihood of the labels under the whole tree: for weights features times (label -
    marginal), for potentials pairs counted less pairs expected.
    """
    rows, labels, trees, marked = [], [], [], 0
    for k, html in enumerate([*built_in, *pages]):
        page = Page(html)
        own = marked_labels(page) if k < len(built_in) else own_labels(page)
        if own is None:
            continue
        rows.append(page.features())
        labels.append(states(own, page))
        trees.append(page.parents)
        marked += len(own) * (k < len(built_in))
    x, y, parents = np.concatenate(rows), np.eye(3)[np.concatenate(labels)], forest(trees)
    inner, by_depth = np.flatnonzero(parents >= 0), levels(parents)
    weigh = np.ones(len(y))
    weigh[marked:] = min(1.0, OWN_WEIGHT * marked / max(1, len(y) - marked)) if marked else 1.0
    weigh /= weigh.sum()
    counted = (y[parents[inner]] * weigh[inner, None]).T @ y[inner]
    weights, edge = np.zeros((x.shape[1], 3)), np.log((counted + 1e-4) / (counted + 1e-4).sum(axis=1, keepdims=True))
    speeds = [np.full(weights.shape, 1e-8), np.full(edge.shape, 1e-8)]
    for _ in range(rounds):
        belief, joint = messages(x @ weights, parents, edge, by_depth)
        flat = joint[inner].reshape(len(inner), 9)
        expected = (weigh[inner] @ np.exp(flat - _add_up(flat)[:, None])).reshape(3, 3)
        slopes = [x.T @ ((np.exp(belief) - y) * weigh[:, None]) + penalty * weights, expected - counted + penalty * edge]
        for k, (value, slope) in enumerate(zip((weights, edge), slopes)):
            speeds[k] += slope**2
            value -= 0.5 * slope / np.sqrt(speeds[k])
    return TreeModel(weights, edge)


def train(pages: DataFrame, page_id: str = "page_id", html: str = "html", limit: int = LABELLED_PAGES) -> TreeModel:
    """Fit on the built-in pages and at most `limit` pages of the table that mark their own content."""
    marked = F.lower(F.col(f"`{html}`")).rlike("<(article|main)[\\s>]")
    own = {"html": F.col(f"`{html}`")}
    chosen = sampled(pages.where(marked & (F.octet_length(own["html"]) <= LONGEST)), own, [F.col(f"`{page_id}`"), own["html"]], limit)
    return fit(_labelled_pages(), [r["html"] for r in chosen])


def main_text(pages: DataFrame, model: TreeModel, html: str = "html") -> DataFrame:
    """`pages` without its html, with text and n_chars; columns of these names are replaced."""
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    rows = pages.select(*(f"`{c}`" for c in kept), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("__html"))
    names = [*kept, "text", "n_chars"]
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, waiting, size = [], [], 0
            for html in batch.column(width):
                waiting.append(html.as_py())
                size += len(waiting[-1])
                if size >= TOGETHER:
                    texts += model.texts(waiting)
                    waiting, size = [], 0
            texts += model.texts(waiting)
            columns = [batch.column(k) for k in range(width)]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in kept) + "text string, n_chars long"
    return rows.mapInArrow(run, schema)
