"""Main text of web pages by minimum-cut labelling of blocks."""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import narrow

BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl "
    "dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend "
    "li main menu nav ol option p pre section select summary table tbody td tfoot th thead title "
    "tr ul video".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT_TAGS = frozenset("script style noscript template title head svg canvas iframe object".split())
BOILER_TAGS = frozenset("nav footer aside form button select menu option dialog".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus footer header login menu modal nav navbar navigation newsletter "
    "notice notices pagination popup promo related reply replies respond share sharing sidebar "
    "social sponsor sponsored subscribe toolbar widget widgets".split()
)
CONTENT_NAMES = frozenset("article body content entry main post story text".split())
#: Start tags that may stand in a head; any other block or text element ends it.
HEAD_TAGS = frozenset("html head title style script noscript template object base link meta".split())
#: Names that reach into an article as well.
_INNER = BOILER_NAMES - {"header"}
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")
_IMPLIED = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}}
FEATURES = (
    "one", "boiler_tag", "boiler_name", "in_content_tag", "in_content_name", "link_share",
    "log_words", "stops", "heading", "paragraph", "list_item",
)
#: Means of the weights before any page is seen.
PRIOR = np.array([-0.5, -5.0, -5.0, 4.0, 1.5, -2.5, 0.5, 0.8, 0.5, 1.0, -0.8])


@dataclass
class Block:
    text: str
    parent: int
    values: np.ndarray
    label: int | None


@dataclass
class HtmlOptions:
    """``sample_pages`` bounds the pages that the classifier is fitted on."""

    sample_pages: int = 400
    adjacency: float = 0.4
    proximity: float = 0.3
    ridge: float = 0.02
    prior: np.ndarray = field(default_factory=lambda: PRIOR)


class _Blocks(HTMLParser):
    """Cuts a page into blocks of text, each with its place in the tree."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, int, bool, bool, bool, bool]] = []
        self.paths: list[list[tuple[str, int, bool, bool, bool, bool]]] = []
        self.shapes: list[tuple[str, int]] = []
        self.number = 0
        self.text: list[str] = []
        self.linked = 0
        self.links = 0

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.paths.append(list(self.stack))
            self.shapes.append((text, self.linked))
        self.text, self.linked = [], 0

    def finish(self) -> list[Block]:
        """The blocks, once it is known how much of the page each element holds.

        Names of ``html``, ``body`` and of an element that holds most of the text are about
        the page, not about what is in it.  An element inside ``article`` or ``main``, or
        beside one, is not such an element, however much it holds.
        """
        self._flush()
        held: Counter[int] = Counter()
        landmarks: Counter[int] = Counter()
        rows = list(zip(self.paths, self.shapes, strict=True))
        for path, (text, _) in rows:
            first = next((k for k, e in enumerate(path) if e[0] in CONTENT_TAGS), None)
            for k, e in enumerate(path):
                held[e[1]] += len(text)
                landmarks[e[1]] += len(text) if first is not None and k <= first else 0
            landmarks[0] += len(text) if first is not None else 0
        half = sum(len(text) for _, (text, _) in rows) / 2
        for path, (text, linked) in rows:
            named = [
                e for e in path
                if e[0] not in ("html", "body")
                and (held[e[1]] <= half or landmarks[e[1]] < landmarks[0])
            ]
            self.blocks.append(self._block(text, linked, path, named))
        return self.blocks

    def _block(self, text: str, linked: int, stack: list, named: list) -> Block:
        tags = {e[0] for e in stack}
        content_tag = any(e[0] in CONTENT_TAGS for e in stack)
        boiler_tag = bool(tags & BOILER_TAGS) or ("header" in tags and not content_tag)
        boiler_name = any(e[2] for e in named) if content_tag else any(
            e[2] or e[3] for e in named
        )
        content_name = any(e[4] for e in stack if e[0] not in ("html", "body"))
        inner = next((e for e in reversed(stack) if e[0] not in VOID_TAGS), None)
        tag = inner[0] if inner else ""
        words = text.split(" ")
        values = np.array(
            [
                1.0,
                boiler_tag,
                boiler_name,
                content_tag,
                content_name,
                min(1.0, linked / max(1, len(text))),
                np.log1p(len(words)) / 2,
                min(1.0, sum(text.count(c) for c in ".!?;:,") / len(words) * 4),
                tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
                tag in ("p", "blockquote", "pre"),
                tag in ("li", "td", "th", "dt", "dd"),
            ],
            dtype=float,
        )
        label = 0 if boiler_tag or boiler_name else 1 if content_tag or content_name else None
        return Block(text, inner[1] if inner else -1, values, label)

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD_TAGS:
            self._close_head()
        if tag == "a":
            self.links += 1
        if tag not in BLOCK_TAGS and tag not in SILENT_TAGS:
            return
        self._flush()
        self.links = 0 if tag != "a" else self.links
        if tag in VOID_TAGS:
            return
        closes = _IMPLIED.get(tag)
        if closes and self.stack and self.stack[-1][0] in closes:
            self.stack.pop()
        elif tag in BLOCK_TAGS and self.stack and self.stack[-1][0] == "p":
            self.stack.pop()
        names = set()
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names |= set(_NAME.findall(value.lower()))
        self.number += 1
        self.stack.append(
            (tag, self.number, bool(names & _INNER), bool(names & BOILER_NAMES),
             bool(names & CONTENT_NAMES), tag in SILENT_TAGS)
        )

    def _close_head(self) -> None:
        """Ends an open head whose end tag was left out; one inside a silent element of the
        head, such as ``noscript``, is still there."""
        if self.stack and self.stack[-1][0] == "head":
            self._flush()
            self.stack.pop()

    def handle_endtag(self, tag):
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag not in BLOCK_TAGS and tag not in SILENT_TAGS:
            return
        self._flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                del self.stack[at:]
                break

    def handle_data(self, data):
        if data.strip():
            self._close_head()
        if not any(e[5] for e in self.stack):
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def page_blocks(html: str | None) -> list[Block]:
    """Blocks of a page in page order; whatever the markup, all text is in one block."""
    if not html:
        return []
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    return parser.finish()


def fit_weights(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to the prior weights."""
    w = prior.copy()
    if not len(y):
        return w
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + ridge * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def min_cut(costs: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Whether each node is on the source's side of a minimum cut.

    ``costs[i] > 0`` is the capacity from the source, ``< 0`` that to the sink; edges join
    neighbours both ways.  Shortest augmenting paths by levels.
    """
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, c in enumerate(costs):
        if c > 0:
            add(source, i, float(c), 0.0)
        elif c < 0:
            add(i, sink, float(-c), 0.0)
    for a, b, capacity in edges:
        add(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return np.array([level[i] >= 0 for i in range(n)], dtype=bool)
        nxt = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                full = next(i for i, e in enumerate(path) if room[e] <= 1e-12)
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while nxt[a] < len(out[a]):
                e = out[a][nxt[a]]
                if room[e] > 1e-12 and level[to[e]] == level[a] + 1:
                    break
                nxt[a] += 1
            if nxt[a] < len(out[a]):
                path.append(out[a][nxt[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                nxt[a] += 1
            else:
                break


def main_text(html: str | None, weights: np.ndarray, o: HtmlOptions) -> str:
    """Blocks on the content side of the cut, in page order, one per line."""
    blocks = page_blocks(html)
    if not blocks:
        return ""
    costs = np.clip(np.array([b.values for b in blocks]) @ weights, -12, 12)
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, o.adjacency))
        if b.parent in last:
            edges.append((last[b.parent], i, o.proximity))
        last[b.parent] = i
    kept = min_cut(costs, edges)
    return "\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def train_block_classifier(
    pages: DataFrame, id_col: str, html_col: str, o: HtmlOptions
) -> np.ndarray:
    """Weights from the blocks of a bounded sample of pages.

    The labels are the pages' own: blocks in landmark elements, or in elements named for
    what they hold, tell what text beside them looks like.
    """
    rows = narrow(pages, page_id=id_col, html=html_col).select(
        F.xxhash64("page_id", "html").alias("place"), "html"
    )
    chosen = rows.orderBy("place").limit(o.sample_pages)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for html in batch["html"]:
                found = [b for b in page_blocks(html) if b.label is not None]
                # distinct rows with their number: a page sends few rows
                values = pd.DataFrame([[*b.values.round(1), b.label] for b in found])
                if len(values):
                    n = values.value_counts().reset_index(name="n")
                    yield pd.DataFrame(
                        {
                            "x": n.iloc[:, : len(FEATURES)].to_numpy().tolist(),
                            "y": n.iloc[:, len(FEATURES)].astype(int),
                            "n": n["n"].astype("int64"),
                        }
                    )

    counted = (
        chosen.select("html")
        .mapInPandas(extract, "x array<double>, y int, n bigint")
        .groupBy("x", "y")
        .agg(F.sum("n").alias("n"))
        .orderBy("x", "y")
        .toPandas()
    )
    if not len(counted):
        return o.prior.copy()
    x, y = np.array(counted["x"].tolist()), counted["y"].to_numpy(dtype=float)
    # each distinct block counts with the root of its number: copies do not rule
    times = np.sqrt(counted["n"].to_numpy(dtype=float)).round().astype(int)
    return fit_weights(np.repeat(x, times, axis=0), np.repeat(y, times), o.prior, o.ridge)


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    options: HtmlOptions | None = None,
) -> DataFrame:
    """``page_id, url, text``: the article of every page.

    A classifier gives each block its cost for either side; neighbours in the page and
    among the children of one element are joined by smoothness edges; the minimum cut
    separates content from the rest.  Character references are decoded, white space in a
    block becomes one space, blocks are joined by line ends.  Null and empty pages, and
    pages without an article, give the empty text.
    """
    o = options or HtmlOptions()
    weights = train_block_classifier(pages, id_col, html_col, o)

    @F.pandas_udf("string")
    def extract(batch: pd.Series) -> pd.Series:
        return pd.Series([main_text(html, weights, o) for html in batch], dtype=object)

    rows = narrow(pages, page_id=id_col, url=url_col, html=html_col)
    return rows.select("page_id", "url", extract("html").alias("text"))
