"""Main text of web pages by a tree-structured graphical model.

Every block of a page and every run of text is a binary variable, content or not. Unary potentials come from tags, names in
class and id, text length, share of links and punctuation; parent-child potentials connect the nodes. Sum-product
messages go up to the root and down again, exactly, for all pages of a batch at once, level by level; runs with a
marginal of one half or more are the main text, in page order.

The potentials are fitted by maximum likelihood, with the same messages, to labelled pages. Their layouts are made by
rules (``layouts.py``), their words are taken from a bounded sample of the pages given (``SAMPLE`` pages).

Null and empty pages, and pages without content, give empty text. Repeated rows are treated alike. Page ids and urls
are passed on as they are; pages of any length are read whole (those the words are sampled from have at most 100,000
characters, which matters for the fit alone). An empty table gives no rows. Only page_id, url and html are read, whatever other columns there
are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm import dom, layouts
from meterline.llm.common import small_batches

#: Pages whose words fill the labelled layouts at most, labelled pages, and steps of the fit.
SAMPLE, LABELLED, STEPS = 200, 700, 200
RATE, PENALTY = 0.25, 1e-3

_TAGS = sorted(dom.BLOCKS) + ["#text"]
_TAG = {t: i for i, t in enumerate(_TAGS)}
#: What names in class, id and role say; each group is one feature.
_NAMES = [
    r"nav|menu|breadcrumb|pagination|pager|toolbar|tabs", r"header|masthead|topbar|top-bar|branding|logo", r"footer|copyright|colophon|contentinfo|legal",
    r"sidebar|side-bar|aside|complementary|rail|widget", r"\bads?\b|advert|sponsor|promo|banner|adsby|dfp|outbrain|taboola",
    r"cookie|consent|gdpr|notice|alert|popup|modal|overlay|dialog|warning", r"newsletter|subscri|signup|sign-up|login|register|form|search|paywall",
    r"share|social|follow|like|tweet", r"related|recommend|more-|trending|popular|teaser|also|read-next", r"comment|repl(?:y|ies)|disqus|respond|discussion|reader",
    r"hidden|sr-only|visually", r"article|post|entry|story", r"content|main|body|text|prose", r"meta|byline|author|date|tag|categor", r"caption|credit",
]
_NAMED = [re.compile(n) for n in _NAMES]
_CUES = re.compile(
    r"^(?:advert\w*|sponsored|related|share|comments?|\d+ comments?|repl(?:y|ies)|subscribe|newsletter|sign up|log ?in|menu|search|cookies?|we use cookies|copyright|©|all rights|follow us|read (?:more|next|also)|more (?:from|stories)|most (?:read|popular)|tags?|leave a)",
    re.I,
)
_LENGTHS, _SHARES = np.array([3, 8, 20, 50, 120]), np.array([0.05, 0.3, 0.6, 0.9])
_OFFSETS = np.cumsum([0, 2, len(_TAGS), len(_TAGS), len(_NAMES), 6, 5, 6, 5, 8, 0, 4])
WIDTH, EDGES = int(_OFFSETS[-1]), 3


def node_features(nodes: list[dom.Node]) -> tuple[list[list[int]], list[int]]:
    """Active features of each node, and the kind of the edge to its parent."""
    n = len(nodes)
    words, chars, linked, first = [len(v.words) for v in nodes], [v.chars for v in nodes], [v.linked for v in nodes], [""] * n
    paragraphs = [0] * n
    for i in range(n - 1, 0, -1):
        v = nodes[i]
        if v.text:
            first[i] = " ".join(v.words[:3])
        words[v.up] += words[i]
        chars[v.up] += chars[i]
        linked[v.up] += linked[i]
        paragraphs[v.up] += v.tag == "p"
        first[v.up] = first[i] or first[v.up]
    active, kinds = [], []
    o = _OFFSETS
    for i, v in enumerate(nodes):
        length = int(np.searchsorted(_LENGTHS, words[i], side="right"))
        share = int(np.searchsorted(_SHARES, linked[i] / max(1, chars[i]), side="right"))
        f = [int(o[0] + v.text), int(o[2 if v.text else 1] + _TAG[nodes[v.up].tag if v.text else v.tag])]
        named = False
        if v.marks:
            for k, pattern in enumerate(_NAMED):
                if pattern.search(v.marks):
                    f.append(int(o[3] + k))
                    named |= k < 11
        f.append(int(o[6 if v.text else 4] + length))
        f.append(int(o[7 if v.text else 5] + share))
        cue = _CUES.match(first[i]) is not None if first[i] else False
        if cue:
            f.append(int(o[8] + v.text))
        if v.text:
            last = v.words[-1][-1]
            f.append(int(o[8] + 2 + (last in ".!?…\"'”»")))
            if any("©" in w for w in v.words[:4]):
                f.append(int(o[8] + 4))
        else:
            f.append(int(o[10] + min(3, paragraphs[i])))
            if any(c in v.tag for c in ("nav", "aside", "footer", "form")):
                f.append(int(o[8] + 5))
                named = True
        active.append(f)
        kinds.append(0 if v.text else 2 if named else 1)
    return active, kinds


@dataclass
class Forest:
    """The nodes of many pages in arrays; ``level`` holds the nodes of each depth."""

    node: np.ndarray
    feature: np.ndarray
    up: np.ndarray
    kind: np.ndarray
    level: list[np.ndarray]

    @classmethod
    def of(cls, pages: list[list[dom.Node]]) -> Forest:
        node, feature, up, kind, depth, base = [], [], [], [], [], 0
        for nodes in pages:
            active, kinds = node_features(nodes)
            for i, f in enumerate(active):
                node += [base + i] * len(f)
                feature += f
            up += [base + v.up if v.up >= 0 else -1 for v in nodes]
            depth += [v.depth for v in nodes]
            kind += kinds
            base += len(nodes)
        depth = np.array(depth, int)
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1))
        return cls(np.array(node, int), np.array(feature, int), np.array(up, int), np.array(kind, int), np.split(order, cuts))

    def marginals(self, theta: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of content per node, and joint probabilities (parent, child) per node but the roots."""
        n = len(self.up)
        unary = np.zeros((n, 2))
        unary[:, 1] = np.bincount(self.node, theta[self.feature], n)
        up_message, below = np.zeros((n, 2)), unary.copy()
        for nodes in self.level[:0:-1]:
            m = np.logaddexp.reduce(edges[self.kind[nodes]] + below[nodes][:, None, :], axis=2)
            up_message[nodes] = m
            for y in (0, 1):
                below[:, y] += np.bincount(self.up[nodes], m[:, y], n)
        belief = below.copy()  # of a node: everything but, until the way down, what its parent says
        joint = np.zeros((n, 2, 2))
        for nodes in self.level[1:]:
            above = belief[self.up[nodes]] - up_message[nodes]
            pair = above[:, :, None] + edges[self.kind[nodes]] + below[nodes][:, None, :]
            belief[nodes] = np.logaddexp.reduce(pair, axis=1)
            pair -= np.logaddexp.reduce(pair.reshape(len(nodes), 4), axis=1)[:, None, None]
            joint[nodes] = np.exp(pair)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), joint


def labels_of(nodes: list[dom.Node]) -> np.ndarray:
    """Labels from the marks of a labelled page: of a run by the nearest marked block, of a block by most of its text."""
    n = len(nodes)
    own = np.zeros(n, int)
    share = np.zeros((n, 2))
    for i, v in enumerate(nodes):
        own[i] = int(v.label) if v.label else own[v.up] if v.up >= 0 else 0
        if v.text:
            share[i, own[i]] = v.chars
    for i in range(n - 1, 0, -1):
        share[nodes[i].up] += share[i]
    return np.array([own[i] if v.text or not share[i].any() else int(share[i, 1] > share[i, 0]) for i, v in enumerate(nodes)])


def fit(pages: list[str], steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Potentials of most likelihood for labelled pages (Adam on the exact gradient)."""
    trees = [dom.read(p) for p in pages]
    forest = Forest.of(trees)
    y = np.concatenate([labels_of(t) for t in trees])
    child = np.flatnonzero(forest.up >= 0)
    seen = np.zeros((EDGES, 2, 2))
    np.add.at(seen, (forest.kind[child], y[forest.up[child]], y[child]), 1)
    theta = np.zeros(WIDTH + 4 * EDGES)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        p, joint = forest.marginals(theta[:WIDTH], theta[WIDTH:].reshape(EDGES, 2, 2))
        g = np.bincount(forest.feature, (y - p)[forest.node], WIDTH)
        expected = np.stack([joint[child][forest.kind[child] == k].sum(0) for k in range(EDGES)])
        gradient = np.concatenate([g, (seen - expected).ravel()]) / len(y) - PENALTY * theta
        m += 0.1 * (gradient - m)
        v += 0.01 * (gradient**2 - v)
        theta += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:WIDTH], theta[WIDTH:].reshape(EDGES, 2, 2)


def extract(pages: list[str], theta: np.ndarray, edges: np.ndarray) -> list[str]:
    trees = [dom.read(p) for p in pages]
    forest = Forest.of(trees)
    p, _ = forest.marginals(theta, edges)
    out, base = [], 0
    for nodes in trees:
        out.append("\n".join(" ".join(v.words) for i, v in enumerate(nodes) if v.text and p[base + i] >= 0.5))
        base += len(nodes)
    return out


def fitted(pages: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Potentials fitted to layouts filled with words of a bounded sample of the pages, the smallest by a hash."""
    mark = F.xxhash64(F.coalesce("html", F.lit("")))
    sample = pages.where(F.length("html").between(1, 100_000)).select("html", mark.alias("m")).orderBy("m").limit(SAMPLE).toArrow()
    words = [w for page in sample["html"].to_pylist() for v in dom.read(page) if v.text for w in v.words]
    return fit(layouts.labelled_pages(words, LABELLED))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    small_batches(pages.sparkSession)
    theta, edges = fitted(pages)
    kinds = dict(pages.dtypes)

    def run(batches):
        for batch in batches:
            texts = extract([h or "" for h in batch.column(2).to_pylist()], theta, edges)
            size = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), size], ["page_id", "url", "text", "n_chars"])

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
