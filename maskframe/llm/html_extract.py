"""Main-text extraction with a tree-structured graphical model over the DOM.

A page becomes a tree of block elements; the runs of text between block boundaries are its leaves. Every node is in one of
three states: boilerplate, main content, or (elements only) a mixture of both. Potentials join each node to its parent (by
the node's tag) and to what is seen at the node (words of class, id and role, length, share of links, punctuation). All
are learned by counting over labelled pages. Sum-product messages go up and then down the tree, all pages of a batch level by
level at once, and give exact marginals; a text run whose marginal favours content is kept.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskframe.llm.common import ready

#: the value of an attribute: quotes open only after the equals sign, an unquoted value ends at white space or >
VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:{VALUE}|[^>])*+)>", re.S)
UNFINISHED = re.compile(r"<[a-zA-Z/!?]")
NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role|data-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*)""", re.I)
PART = re.compile(r"[a-z]+|[A-Z]+[a-z]*")
SPACE = re.compile(r"\s+")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: their content is never text of the page
RAW = frozenset("script style noscript template svg iframe object canvas math audio video head title textarea select option".split())
BLOCK = frozenset("html body address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: a start tag of the key ends an open element of the values, up to the nearest element of LIMIT
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
LIMIT = frozenset("ul ol menu dl table html body".split())
RUN = "#text"
BOILER, CONTENT, MIXED = range(3)


class Page:
    """The tree of one page as lists by node: parent (-1 at the top), tag, feature names, label (-1 unknown), text."""

    __slots__ = ("feats", "labels", "parents", "tags", "texts")

    def __init__(self, source: str, labelled: bool = False):
        self.parents, self.tags, self.feats, self.labels, self.texts = [-1], ["html"], [()], [-1], [None]
        stack: list[tuple[str, int]] = [("html", 0)]  # open elements; inline ones carry their block's node
        pieces: list[str] = []
        linked = links = 0  # open links; characters inside links in this run

        def flush() -> None:
            nonlocal links
            if pieces:
                raw = "".join(pieces)
                text = SPACE.sub(" ", html.unescape(raw)).strip()
                if text:
                    self._run(stack[-1][1], text, links / max(len(raw), 1))
                pieces.clear()
                links = 0

        def text(part: str) -> None:
            nonlocal links
            if part:
                pieces.append(part)
                if linked:
                    links += len(part)

        # no tag is complete after the last >; what begins as one there is not text
        at, n, last = 0, len(source), source.rfind(">") + 1
        never: set[str] = set()  # elements whose end does not come any more
        while at < n:
            m = TOKEN.search(source, at, last) if at < last else None
            if m is None:
                m = UNFINISHED.search(source, max(at, last))
                text(source[at : m.start()] if m else source[at:])
                break
            text(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<!--") and not m[0].endswith("-->"):
                    break
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "p" and not any(t == "p" for t, _ in stack):
                    flush()
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        if any(t in BLOCK for t, _ in stack[i:]):
                            flush()
                        linked -= sum(t == "a" for t, _ in stack[i:])
                        del stack[i:]
                        break
                continue
            if tag in RAW:
                if not m[3].endswith("/"):
                    end = None if tag in never else re.compile(rf"</{re.escape(tag)}\b[^>]*+>", re.I).search(source, at, last)
                    if end is None:
                        never.add(tag)
                    body = re.compile(r"<body\b", re.I).search(source, at) if tag == "head" else None
                    at = end.end() if end else body.start() if body else n if tag != "head" else at
                pieces.append(" ")
                continue
            if tag == "br":
                pieces.append(" ")
                continue
            if tag in ("html", "body") and any(t == tag for t, _ in stack):
                continue
            if tag in BLOCK:
                flush()
                if tag == "hr":
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    t = stack[i][0]
                    if t == "p" or t in CLOSES.get(tag, ()):
                        linked -= sum(x == "a" for x, _ in stack[i:])
                        del stack[i:]
                        if t in CLOSES.get(tag, ()) and tag not in ("tr", "tbody", "tfoot"):
                            break
                    elif t in LIMIT or (t in BLOCK and tag not in CLOSES):
                        break
                stack.append((tag, self._element(stack[-1][1], tag, m[3], labelled)))
            elif tag not in VOID:
                if tag == "a":
                    linked += 1
                stack.append((tag, stack[-1][1]))
        flush()

    def _element(self, parent: int, tag: str, attributes: str, labelled: bool) -> int:
        feats, label = [], -1
        if attributes:
            for name, value in NAMED.findall(attributes):
                value = value.strip("\"'")
                if name.lower() == "data-label":
                    if labelled and value in ("0", "1"):
                        label = int(value)
                else:
                    feats += [f"name {w.lower()}" for w in PART.findall(value)]
        self.parents.append(parent)
        self.tags.append(tag)
        self.feats.append(tuple(dict.fromkeys(feats)))
        self.labels.append(label)
        self.texts.append(None)
        return len(self.parents) - 1

    def _run(self, parent: int, text: str, links: float) -> None:
        n = len(text)
        marks = sum(map(text.count, ".,;:!?"))
        self.parents.append(parent)
        self.tags.append(RUN)
        self.feats.append((f"size {min(n.bit_length(), 10) // 2}", f"links {min(2, int(links * 2.5))}", f"marks {min(3, marks)}", f"in {self.tags[parent]}"))
        self.labels.append(-1)
        self.texts.append(text)


def states(page: Page) -> np.ndarray:
    """States of a labelled page: a run has the label of the nearest marked element above it (boilerplate without one); an
    element is a mixture if runs of both kinds are below it, and else what its runs are (without any, its own label)."""
    n = len(page.parents)
    own = np.zeros(n, np.int64)
    for i in range(1, n):
        own[i] = page.labels[i] if page.labels[i] >= 0 else own[page.parents[i]]
    runs = np.zeros((n, 2), np.int64)
    for i in range(n - 1, 0, -1):
        if page.tags[i] == RUN:
            runs[i, own[i]] += 1
        runs[page.parents[i]] += runs[i]
    return np.where((runs > 0).all(1), MIXED, np.where(runs.any(1), runs.argmax(1), own))


@dataclass
class Model:
    """Log-potentials: ``edge[tag]`` [parent state, own state], ``seen[feature]`` by state, ``first`` of the root."""

    edge: dict[str, np.ndarray]
    seen: dict[str, np.ndarray]
    first: np.ndarray

    def marginals(self, pages: list[Page]) -> list[np.ndarray]:
        """By page, the probability of content of each node."""
        sizes = [len(p.parents) for p in pages]
        n, base = sum(sizes), np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)
        parent = np.fromiter((x for p in pages for x in p.parents), np.int64, n)
        top = parent < 0
        parent = np.where(top, -1, parent + base)
        default, none, number, table = self.edge[""], np.zeros(3), {}, []
        kind = np.fromiter((number.setdefault(t, len(number)) for p in pages for t in p.tags), np.int64, n)
        edges = np.stack([self.edge.get(t, default) for t in number])
        cache: dict[tuple, int] = {}
        for p in pages:
            for f in p.feats:
                if f not in cache:
                    cache[f] = len(table)
                    table.append(sum((self.seen.get(x, none) for x in f), none))
        local = np.stack(table)[np.fromiter((cache[f] for p in pages for f in p.feats), np.int64, n)]
        local[kind == number.get(RUN, -1), MIXED] = -40.0
        local[top] += self.first
        depth = np.zeros(n, np.int64)
        levels = [np.nonzero(top)[0]]
        below = np.nonzero(~top)[0]
        while len(below):  # parents come before their children, so a level is where the parent's depth is known
            at = below[depth[parent[below]] == len(levels) - 1] if len(levels) > 1 else below[top[parent[below]]]
            depth[at] = len(levels)
            levels.append(at)
            below = below[depth[below] == 0]
        inside, up = local.copy(), np.zeros((n, 3))
        for at in reversed(levels[1:]):
            up[at] = np.logaddexp.reduce(edges[kind[at]] + inside[at][:, None, :], axis=2)
            for k in range(3):
                inside[:, k] += np.bincount(parent[at], up[at, k], n)
        outside = np.zeros((n, 3))
        for at in levels[1:]:
            rest = outside[parent[at]] + inside[parent[at]] - up[at]
            outside[at] = np.logaddexp.reduce(edges[kind[at]] + rest[:, :, None], axis=1)
        belief = inside + outside
        belief -= np.logaddexp.reduce(belief, axis=1)[:, None]
        return np.split(np.exp(belief[:, CONTENT]), np.cumsum(sizes)[:-1])

    def texts(self, sources: list[str | None]) -> list[str]:
        pages = [Page(s or "") for s in sources]
        if not pages:
            return []
        return ["\n".join(t for t, x in zip(p.texts, own, strict=True) if t is not None and x >= 0.5) for p, own in zip(pages, self.marginals(pages), strict=True)]


def fit(labelled: DataFrame, smooth: float = 0.5, weight: float = 0.5) -> Model:
    """Learns the potentials by counting over ``labelled`` (html with data-label="1" on elements of main content and "0" on
    boilerplate inside them; null pages are left out). Only counts by tag, feature and state reach the driver.

    ``smooth`` is added to every count; ``weight`` tempers what is seen at a node, whose features say the same thing twice.
    """

    def count(batches):
        for b in batches:
            c: dict[tuple, int] = {}
            for s in b["html"]:
                p = Page(s or "", labelled=True)
                x = states(p)
                for i in range(len(x)):
                    up = int(x[p.parents[i]]) if i else -1
                    for key in (("edge", p.tags[i], up, int(x[i])), *(("seen", f, -1, int(x[i])) for f in p.feats[i])):
                        c[key] = c.get(key, 0) + 1
            yield pd.DataFrame([(*k, v) for k, v in c.items()], columns=["what", "name", "up", "x", "n"])

    rows = ready(labelled).select("html").filter("html IS NOT NULL").mapInPandas(count, "what string, name string, up int, x int, n long").groupBy("what", "name", "up", "x").agg(F.sum("n").alias("n")).collect()
    edge: dict[str, np.ndarray] = {}
    seen: dict[str, np.ndarray] = {}
    total, first = np.zeros((3, 3)), np.zeros(3)
    for r in rows:
        if r["what"] == "seen":
            seen.setdefault(r["name"], np.zeros(3))[r["x"]] += r["n"]
        elif r["up"] < 0:
            first[r["x"]] += r["n"]
        else:
            edge.setdefault(r["name"], np.zeros((3, 3)))[r["up"], r["x"]] += r["n"]
            total[r["up"], r["x"]] += r["n"]
    back = (total + smooth) / (total + smooth).sum(1, keepdims=True)
    tables = {t: np.log((c + 2 * back) / (c + 2 * back).sum(1, keepdims=True)) for t, c in edge.items()}
    tables[""] = np.log(back)
    of = np.stack(list(seen.values())).sum(0) + 1 if seen else np.ones(3)
    share = {f: np.log((c + smooth) / of) - np.log((c.sum() + 3 * smooth) / of.sum()) for f, c in seen.items()}
    return Model(tables, {f: weight * v for f, v in share.items()}, np.log((first + smooth) / (first + smooth).sum()))


# Hand-labelled page skeletons. "1" marks main content, "0" boilerplate inside it; S, L and W stand for a sentence, a long
# paragraph and a few words, drawn at random.
SKELETONS = (
    '<html><head><title>W</title></head><body><nav><ul>@<li><a href="#">W</a></li>@</ul></nav><div class="ad">S</div><article data-label="1"><h1>W</h1>@<p>L</p>@<p>S</p></article><footer>&copy; W. S</footer></body></html>',
    '<html><body><nav><ul>@<li><a href="#">W</a></li>@</ul></nav><div class="ad">S</div><article data-label="1"><h1>W</h1>@<p><b>S</b><br>@</article><footer>S</footer></body></html>',
    '<html><body><nav><ul>@<li><a href="#">W</a></li>@</ul></nav><div class="ad">W</div><article data-label="1"><h1>S</h1><p>W</p>@<p>S</p>@</article><footer>W</footer>',
    '<html><body><header class="site-header"><a href="#">W</a><div class="menu top-menu">@<a href="#">W</a> @</div></header><main><article class="post entry" data-label="1"><header><h1>W</h1></header>@<p>L</p>@<h2>W</h2><ul>@<li>S</li>@</ul></article><section id="comments" class="comments"><h3>W</h3>@<div class="comment"><p>L</p></div>@</section></main><aside class="sidebar"><h3>W</h3>@<li><a href="#">W</a></li>@</aside><footer class="site-footer"><p>S</p></footer></body></html>',
    '<html><body><div id="header" class="masthead"><ul class="navigation navbar">@<li><a href="#">W</a></li>@</ul></div><div id="content" class="main-content"><div class="article-body story" data-label="1"><h1>W</h1><p>L</p><div class="advert advertisement sponsored promo" data-label="0"><p>S</p></div>@<p>L</p>@<blockquote><p>S</p></blockquote></div><div class="related recommended"><h4>W</h4>@<a href="#">S</a>@</div></div><div id="footer"><p>W</p><p>S</p></div></body></html>',
    '<html><body><div class="cookie-notice cookie consent banner"><p>S</p><button>W</button></div><div class="breadcrumb breadcrumbs">@<a href="#">W</a>@</div><main data-label="1"><h1>W</h1>@<p>L</p>@<table><tr><th>W</th><td>W</td></tr><tr><td>S</td><td>W</td></tr></table><p>S <a href="#">W</a> S</p></main><form class="newsletter subscribe signup"><label>W</label><input><button>W</button><p>S</p></form><footer><p>S</p></footer></body></html>',
    '<html><body><div class="wrapper container"><div class="sidebar widget" id="sidebar"><h3>W</h3><ul>@<li><a href="#">W</a></li>@</ul><p>S</p></div><div class="content"><div class="post" data-label="1"><h2>W</h2>@<p>L</p>@<pre>S</pre><ol>@<li>S</li>@</ol></div><div id="respond" class="comment-respond reply"><form><p>W</p></form></div><ol class="commentlist comment-list">@<li class="comment"><p>L</p></li>@</ol></div></div><div class="copyright legal footer"><p>S</p></div></body></html>',
    '<html><body><div role="banner"><h2>W</h2></div><div role="navigation">@<a href="#">W</a> @</div><div role="main"><article data-label="1"><h1>W</h1><p>S</p><p>L</p><figure><figcaption>S</figcaption></figure><aside data-label="0"><p>S</p></aside>@<p>S</p>@</article></div><div role="complementary"><p>S</p>@<li><a href="#">W</a></li>@</div><div role="contentinfo"><p>S</p></div></body></html>',
    '<html><body><p class="skip"><a href="#">W</a></p><div class="notice alert warning message"><p>S</p></div><section class="page text" data-label="1"><h1>W</h1>@<p>L</p>@<div class="share social share-buttons" data-label="0">@<a href="#">W</a>@</div><p>S</p></section><section class="related-posts more"><h3>W</h3>@<p><a href="#">S</a></p>@</section><div class="popup modal login"><p>S</p><form><p>W</p></form></div><footer><ul>@<li><a href="#">W</a></li>@</ul><p>S</p></footer></body></html>',
    '<html><body><div class="header top"><p>W</p></div><article data-label="1"><div><h1>W</h1><div><p>L</p><div><p>S</p>@<p>L</p>@</div></div><dl><dt>W</dt><dd>S</dd></dl></div><form data-label="0"><p>S</p></form><nav data-label="0">@<a href="#">W</a>@</nav><div class="ads ad-slot ad" data-label="0">S</div></article><div class="comments discussion"><p>S</p>@<article class="comment"><header>W</header><p>L</p></article>@</div><footer><div>S</div></footer></body></html>',
    '<html><body>@<p data-label="1">L</p>@<p data-label="1">S</p></body></html>',
    '<html><body><div data-label="1"><h1>W</h1>@<p>L</p>@</div><div><a href="#">W</a> <a href="#">W</a> <a href="#">W</a></div></body></html>',
    '<html><body><header><h1>W</h1><nav>@<a href="#">W</a>@</nav><p>S</p></header><main><section data-label="1"><h2>W</h2>@<p>L</p>@</section><section data-label="1"><h2>W</h2><p>S</p>@<p>L</p>@</section></main><section class="user-comments reviews" id="comments"><h2>W</h2>@<p>L</p>@</section><aside><h2>W</h2><p>S</p><p>L</p></aside><footer>@<p>S</p>@</footer></body></html>',
)


def labelled_pages(spark: SparkSession, copies: int = 24, seed: int = 11) -> DataFrame:
    """``copies`` pages from each hand-labelled skeleton, texts and repetitions drawn at random (the bound of the fit)."""
    rng = np.random.Generator(np.random.PCG64(seed))

    def words(n: int) -> str:
        return " ".join("".join(rng.choice(list("aeioustnrl"), rng.integers(2, 9))) for _ in range(n))

    def sentence(lo: int, hi: int) -> str:
        w = words(int(rng.integers(lo, hi)))
        return w[0].upper() + w[1:] + "."

    def fill(m: re.Match) -> str:
        if m[0] == "W":
            return words(int(rng.integers(1, 5)))
        return sentence(3, 18) if m[0] == "S" else " ".join(sentence(4, 16) for _ in range(int(rng.integers(2, 9))))

    rows = []
    for s in SKELETONS:
        for _ in range(copies):
            out = re.sub(r"@([^@]*)@", lambda m: m[1] * int(rng.integers(0, 6)), s)
            rows.append((re.sub(r"(?<![A-Za-z\"=-])[SLW](?![A-Za-z\"=-])", fill, out),))
    return spark.createDataFrame(rows, "html string")


def extract(pages: DataFrame, model: Model, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the string column ``out``: the main text of the whole ``html``, one line per block in page order,
    character references decoded, white space inside a block one space; empty if there is none.

    Null and empty pages give an empty text; broken or cut markup is read as far as it goes; other columns and repeated
    rows stay as they are (a column of the name ``out`` is replaced); no shuffle.
    """
    held = pages.sparkSession.sparkContext.broadcast(model)

    def main(sources: pd.Series) -> pd.Series:
        parts = []
        own, size = [], 0
        for s in sources:  # some pages at a time: bounded memory
            own.append(s)
            size += len(s or "")
            if size > 4_000_000 or len(own) >= 512:
                parts += held.value.texts(own)
                own, size = [], 0
        return pd.Series(parts + held.value.texts(own), dtype="object")

    return ready(pages).withColumn(out, F.pandas_udf(main, "string")(F.col(html)))
