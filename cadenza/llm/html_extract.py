"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into blocks (runs of text between block-level tags; scripts, styles, comments and the
head are not text). Each block has features of its ancestors (tag names and known words of their class
and id), of its text (length, link share, closing mark, notice signs) and of its place. Class and id words of html
and body, and the words and form tags of elements around the page's article or main element, speak of the whole
page and are no features; nor is, for a heading, a header element inside an article or main element, as
such headings are titles of the text and not of the site. The field has two
labels, main and furniture, and transition weights between neighbours; it is trained by maximum
likelihood on labelled pages and decoded by Viterbi.

Labelled pages: a bounded sample of the given pages (``train_pages``, by a hash of the id) that mark their
article in the markup, each also laid out anew in several page templates (other containers, sidebars,
notices, forms, reader comments) whose labels are known. Whole pages are learned: a page of over ``PIECE`` blocks is cut into
chains of that length, and a text of over ``RUN`` words gives several texts for the made pages. Training runs on the driver over
the feature numbers of that sample; the weights (one float per feature) are broadcast, and all pages are parsed and decoded in
the tasks.

A head without an end tag ends at the first text or start tag that cannot stand in a head. Other elements whose
content is not text (``RAW_TAGS``) end at their end tag or, unclosed, at the next block or the end of the block around
them; only an unclosed script or style runs to the end of the page, as in the HTML standard. Text of math is text.

White space inside a block becomes one space; character references are decoded; main blocks are joined
by a newline. Null and empty pages, and pages without main blocks, give an empty text. Without any
labelled page the templates hold made-up words. Every row gives one row; extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import small_batches

PIECE = 60  # blocks of a chain that is learned
RUN = 120  # words of a text in a made page
# HTML element classes.
BLOCK_TAGS = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre search section select summary "
    "table tbody td tfoot th thead title tr ul").split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea iframe svg object canvas audio video title".split())
HEAD_TAGS = frozenset("base basefont bgsound html link meta noscript script style template title".split())
# Elements that a start tag of the key closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPES = frozenset("article aside body div footer form header main nav section table ul ol dl menu td".split())
# Words in class and id values that say what an element is for.
ROLES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs",
    "head": "header banner masthead topbar hero logo", "foot": "footer foot copyright colophon bottom legal imprint",
    "side": "sidebar side aside widget widgets rail related recommended more teaser tags tagcloud",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner-ad dfp",
    "note": "cookie cookies consent gdpr notice notification alert popup modal overlay privacy disclaimer",
    "talk": "comment comments discussion disqus reply replies respond reader feedback",
    "form": "form login signin signup register subscribe subscription newsletter search contact",
    "share": "share sharing social toolbar tools meta byline author-box print buttons rating",
    "main": "article content post entry main story body text copy maincontent articlebody postcontent prose",
}
ROLE_OF = {w: role for role, words in ROLES.items() for w in words.split()}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)"
                    r"((?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)*)(?:>|\Z)", re.S)  # a quote opens a value only after =
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_NOTICE = re.compile(r"©|\(c\)|all rights reserved|cookie|privacy policy|subscribe|newsletter|log ?in|sign ?up", re.I)


def _roles(attrs: str) -> tuple:
    if not attrs:
        return ()
    found = []
    for name, a, b, c in _ATTR.findall(attrs):
        value = (a or b or c).lower()
        if name.lower() == "role":
            found += [{"navigation": "menu", "banner": "head", "contentinfo": "foot", "complementary": "side",
                       "main": "main", "article": "main", "search": "form"}.get(value, "")]
            continue
        for token in value.split():
            if token in ROLE_OF:
                found.append(ROLE_OF[token])
            else:
                found += [ROLE_OF[w] for w in _WORD.findall(token) if w in ROLE_OF]
    return tuple(r for r in found if r)


def _raw_end(page: str, at: int, tag: str, stack: list, loose: dict[str, int]) -> int:
    """Where reading goes on after the start tag (it ends at ``at``) of a raw element in the elements of ``stack``."""
    if tag in ("script", "style", "title", "textarea"):  # their content is no markup
        close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
        if close:
            return close.end()
        if tag in ("script", "style"):
            return len(page)
    nests = tag in ("object", "template", "svg")
    depth = 1
    inner: dict[str, int] = {}  # blocks opened inside
    first = -1  # the first block inside
    html_in = 0  # depth of elements of svg that may hold blocks
    while m := _TOKEN.search(page, at):
        at = m.end()
        if m.group(1) is None:
            continue
        name = m.group(1).lower()
        if page[m.start() + 1] == "/":
            if name == tag:
                depth -= 1
                if not depth:
                    return at
            elif inner.get(name):
                inner[name] -= 1
            elif name in ("head", "body", "html") or any(e[0] == name for e in reversed(stack)):
                return first if first >= 0 else m.start()
            elif name in ("foreignobject", "desc"):
                html_in -= 1
        elif name == tag and not nests:
            return first if first >= 0 else m.start()
        elif m.group(2).endswith("/"):
            continue
        elif name == tag:
            depth += 1
        elif name in ("foreignobject", "desc"):
            html_in += 1
        elif name in ("script", "style"):
            at = _raw_end(page, at, name, stack, loose)
        elif name in BLOCK_TAGS and name not in RAW_TAGS:
            if first < 0:
                first = m.start()
                if (tag == "svg" and html_in <= 0) or loose.get(tag, 0) > 9:  # svg holds no blocks
                    return first
            if name not in VOID_TAGS:
                inner[name] = inner.get(name, 0) + 1
    loose[tag] = loose.get(tag, 0) + 1  # after ten searches to the end of the page the next block is the end
    return first if first >= 0 else len(page)


def blocks(page: str | None) -> list[tuple[str, list[str]]]:
    """(text, features) of every leaf block in page order."""
    if not page:
        return []
    out: list = []
    stack: list[tuple[str, tuple]] = []  # (tag, roles)
    parts: list[str] = []
    links = 0
    in_link = False
    in_head = False
    loose: dict[str, int] = {}
    at = 0

    def flush():
        nonlocal parts, links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, links, list(stack)))
        parts, links = [], 0

    while m := _TOKEN.search(page, at):
        if m.start() > at:
            piece = page[at:m.start()]
            if in_head and not piece.isspace():
                in_head = False
            if not in_head:
                parts.append(piece)
                if in_link:
                    links += len(piece)
        at = m.end()
        tag = m.group(1)
        if tag is None:
            if page.startswith("<![CDATA[", m.start()) and not in_head:
                parts.append(html.escape(m.group()[9:-3]))
            continue
        tag = tag.lower()
        end = page[m.start() + 1] == "/"
        if end:
            if tag in ("head", "body", "html"):
                in_head = False
            if tag in BLOCK_TAGS:
                flush()
            elif tag == "a":
                in_link = False
            if tag in BLOCK_TAGS or tag == "a":
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                    if tag not in SCOPES and stack[i][0] in SCOPES:
                        break  # a stray end tag does not close what holds it
            continue
        attrs = m.group(2) or ""
        if tag == "head":
            in_head = all(e[0] == "html" for e in stack) and not out and not "".join(parts).strip()
            continue
        if tag not in HEAD_TAGS:
            in_head = False
        if tag in RAW_TAGS:
            if not attrs.endswith("/"):
                at = _raw_end(page, at, tag, stack, loose)
            continue
        if tag == "br" or tag == "wbr":
            parts.append(" " if tag == "br" else "")
            continue
        if tag in BLOCK_TAGS:
            flush()
            if stack and stack[-1][0] == "p":
                stack.pop()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in CLOSES.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table", "select", "menu"):
                    break
            if tag not in VOID_TAGS:
                stack.append((tag, () if tag in ("html", "body") else _roles(attrs)))
        elif tag == "a":
            in_link = True
    if at < len(page) and not (in_head and page[at:].isspace()):
        parts.append(page[at:])
    flush()
    wide = _page_wide(out)
    return [(text, _features(text, links, path, i, len(out), wide)) for i, (text, links, path) in enumerate(out)]


def _page_wide(out: list) -> set[int]:
    """Identities of the elements around a main element or the page's article: the longest one inside main (anywhere,
    if the page has no main) that is not marked as furniture itself."""
    around: dict = {}  # main and article elements: identity -> (tag, roles, elements around it)
    size: dict = {}
    for text, _, path in out:
        for k, e in enumerate(path):
            if e[0] in ("main", "article"):
                if id(e) not in around:
                    around[id(e)] = (*e, [id(x) for x in path[:k]])
                size[id(e)] = size.get(id(e), 0) + len(text)
    mains = {i for i, (tag, _, _) in around.items() if tag == "main"}
    articles = [i for i, (tag, roles, up) in around.items()
                if tag == "article" and (not mains or mains.intersection(up)) and ("main" in roles or not roles)]
    found = mains | ({max(articles, key=size.__getitem__)} if articles else set())
    return {x for i in found for x in around[i][2]}


def _features(text: str, links: int, path: list, i: int, n: int, wide: set[int]) -> list[str]:
    f = ["1"]
    if path and path[-1][0] in HEADINGS:
        inside = next((k for k, e in enumerate(path) if e[0] in ("article", "main")), len(path))
        path = [e for k, e in enumerate(path) if k < inside or e[0] != "header"]
    names = {e[0] for e in path if e[0] != "form" or id(e) not in wide} - {"html", "body", "div"}
    f += ["in " + t for t in names]
    roles = {r for e in path if id(e) not in wide for r in e[1]}
    f += ["is " + r for r in roles]
    own = path[-1][0] if path else ""
    f.append("own " + own)
    unmarked = not roles and not names & {"nav", "header", "footer", "aside", "form", "article", "main"}
    if unmarked:
        f.append("unmarked")
    words = text.count(" ") + 1
    size = 0 if words < 4 else 1 if words < 10 else 2 if words < 25 else 3 if words < 60 else 4
    share = min(1.0, links / max(1, len(text)))
    dense = 0 if share < 0.2 else 1 if share < 0.6 else 2
    f += [f"words {size}", f"links {dense}", f"words {size} links {dense}"]
    f.append("stop" if text[-1] in ".!?…\"”»" else "open")
    if unmarked and _NOTICE.search(text):  # an article may speak of such things
        f.append(f"notice {size > 2}")
    if "|" in text or "›" in text or "»" in text:
        f.append("bars")
    f.append("first" if i == 0 else "last" if i == n - 1 else "mid")
    return f


# ---------------------------------------------------------------- field
def _lattice(pages: list[list[list[int]]], n_features: int):
    """Pages of feature numbers as padded arrays: (P, T, K) numbers (pad: n_features) and lengths."""
    t = max(len(p) for p in pages)
    k = max(len(b) for p in pages for b in p)
    x = np.full((len(pages), t, k), n_features, np.int32)
    for i, p in enumerate(pages):
        for j, b in enumerate(p):
            x[i, j, :len(b)] = b
    return x, np.array([len(p) for p in pages])


def train_field(pages: list[list[list[int]]], labels: list[list[int]], n_features: int, steps: int = 120,
                rate: float = 0.15, l2: float = 0.02):
    """Weights (n_features + 1, 2) and transitions (2, 2) by Adam on the mean negative log-likelihood."""
    x, lens = _lattice(pages, n_features)
    p, t, _ = x.shape
    y = np.zeros((p, t), int)
    for i, lab in enumerate(labels):
        y[i, :len(lab)] = lab
    live = np.arange(t) < lens[:, None]
    w, tr = np.zeros((n_features + 1, 2)), np.zeros((2, 2))
    moments = [np.zeros_like(a) for a in (w, w, tr, tr)]
    rows = np.arange(p)
    pairs = live[:, 1:]
    seen = np.zeros_like(tr)
    np.add.at(seen, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    total = live.sum()
    for step in range(1, steps + 1):
        e = w[x].sum(axis=2)
        alpha, beta = np.zeros((p, t, 2)), np.zeros((p, t, 2))
        alpha[:, 0] = e[:, 0]
        for j in range(1, t):
            alpha[:, j] = e[:, j] + np.logaddexp(alpha[:, j - 1, :1] + tr[0], alpha[:, j - 1, 1:] + tr[1])
        for j in range(t - 2, -1, -1):
            nxt = beta[:, j + 1] + e[:, j + 1]
            b = np.logaddexp(tr[:, 0] + nxt[:, :1], tr[:, 1] + nxt[:, 1:])
            beta[:, j] = np.where((j + 1 < lens)[:, None], b, 0.0)
        z = np.logaddexp(*alpha[rows, lens - 1].T)
        marginal = np.exp(alpha + beta - z[:, None, None]) * live[..., None]
        gold = np.zeros_like(marginal)
        gold[np.nonzero(live) + (y[live],)] = 1.0
        gw = np.zeros_like(w)
        d = marginal - gold
        for label in (0, 1):
            gw[:, label] = np.bincount(x.ravel(), np.repeat(d[..., label].ravel(), x.shape[2]), n_features + 1)
        edge = np.exp(alpha[:, :-1, :, None] + tr + (e + beta)[:, 1:, None, :] - z[:, None, None, None]) * pairs[..., None, None]
        gt = edge.sum(axis=(0, 1)) - seen
        for a, g, m, v in ((w, gw, 0, 1), (tr, gt, 2, 3)):
            g = g / total + l2 * a / len(pages)
            moments[m] = 0.9 * moments[m] + 0.1 * g
            moments[v] = 0.99 * moments[v] + 0.01 * g * g
            a -= rate * (moments[m] / (1 - 0.9 ** step)) / (np.sqrt(moments[v] / (1 - 0.99 ** step)) + 1e-8)
        w[n_features] = 0.0
    return w, tr


def viterbi(e: list[tuple[float, float]], tr) -> list[int]:
    (a, b), (c, d) = tr
    back = []
    x, y = e[0]
    for f, g in e[1:]:
        p, q = x + a >= y + c, x + b >= y + d
        back.append((0 if p else 1, 0 if q else 1))
        x, y = (x + a if p else y + c) + f, (x + b if q else y + d) + g
    out = [0 if x >= y else 1]
    for step in reversed(back):
        out.append(step[out[-1]])
    return out[::-1]


# ---------------------------------------------------------------- labelled pages
_FURNITURE_ROLES = ("is menu", "is head", "is foot", "is side", "is ad", "is note", "is talk", "is form", "is share")
_FURNITURE_TAGS = ("in nav", "in footer", "in aside", "in form")


def weak_labels(bl: list[tuple[str, list[str]]]) -> list[int] | None:
    """Labels of a page that marks its article; None if it does not."""
    if not any("in article" in f or "in main" in f for _, f in bl):
        return None
    return [int(("in article" in f or "in main" in f) and not any(r in f for r in _FURNITURE_ROLES + _FURNITURE_TAGS)) for _, f in bl]


_MAIN = ('<article>%s</article>', '<main>%s</main>', '<div id="content">%s</div>', '<div class="post-content">%s</div>',
         '<section class="entry">%s</section>', '<div class="article-body"><section>%s</section></div>',
         '<div class="wrap"><div>%s</div></div>', '<table><tr><td>%s</td></tr></table>', '%s',
         '<main><article class="story">%s</article></main>', '<section>%s</section>', '<div role="main">%s</div>')
_OUTSIDE = ('<nav><ul>{li}</ul></nav>', '<div class="menu"><ul>{li}</ul></div>', '<ul class="breadcrumbs">{li}</ul>',
            '<header><h2>{s}</h2><p>{s}</p></header>', '<div id="header"><h1>{s}</h1></div>', '<header><nav>{a}</nav></header>',
            '<aside><h3>{s}</h3><p>{t}</p></aside>', '<div class="sidebar"><h3>{s}</h3><ul>{li}</ul><p>{t}</p></div>',
            '<div class="ad">{t}</div>', '<div class="advert"><p>{t}</p></div>', '<div class="sponsored">{t}</div>',
            '<div id="cookie-notice"><p>{t}</p><button>{s}</button></div>', '<div class="notice">{t}</div>',
            '<form><label>{s}</label><p>{t}</p><input><button>{s}</button></form>',
            '<div class="newsletter"><h3>{s}</h3><p>{t}</p></div>', '<div class="related"><h3>{s}</h3><ul>{li}</ul></div>',
            '<section class="comments"><h3>{s}</h3><p>{t}</p><p>{t}</p></section>',
            '<div id="comments"><div class="comment"><p>{t}</p></div><div class="comment"><p>{s}</p></div></div>',
            '<article class="comment"><p>{t}</p></article>', '<div class="share">{a}</div>', '<div><a href="#">{s}</a></div>')
_BELOW = ('<footer>&copy; {s}</footer>', '<footer><p>{t}</p><ul>{li}</ul></footer>', '<div id="footer"><p>&copy; {s}</p></div>',
          '<div class="copyright">&copy; 2020 {s}. All rights reserved.</div>', '<footer><nav>{a}</nav><p>{s}</p></footer>')

# Page-wide wrappers: of pages with an article or main element, and of any page.
_AROUND = ('<form action="/page.aspx">%s</form>', '<div class="page no-sidebar comments-open">%s</div>',
           '<div id="menu-wrapper"><form id="form1">%s</form></div>', '<section class="with-sidebar sticky-header">%s</section>')
_BODY = ('<html><body class="single-post no-sidebar comments-open">', '<html class="has-menu sticky-header"><body>',
         '<html><body id="page-comments" class="cookie-notice newsletter">')


def _fill(template: str, rng: random.Random, texts: list[str]) -> str:
    def short():
        w = rng.choice(texts).split()
        return html.escape(" ".join(w[:rng.randint(1, 6)]))

    def link():
        return f'<a href="/x">{short()}</a>'

    return template.replace("{li}", "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 7)))) \
        .replace("{a}", " ".join(link() for _ in range(rng.randint(2, 5)))) \
        .replace("{s}", short()).replace("{t}", html.escape(rng.choice(texts)))


def _laid_out(rng: random.Random, texts: list[str]) -> tuple[str, set]:
    """A page in a random template, and the texts of its main blocks."""
    title = " ".join(rng.choice(texts).split()[:rng.randint(2, 9)])
    body, main = [], set()

    def say(text: str, form: str):
        body.append(form % html.escape(text))
        main.add(" ".join(text.split()))

    if rng.random() < 0.8:
        say(title, "<h1>%s</h1>")
    for _ in range(rng.randint(1, 8)):
        r = rng.random()
        text = " ".join(rng.choice(texts).split()) + f" {rng.randint(0, 9999)}."
        if r < 0.7:
            say(text, "<p>%s</p>")
        elif r < 0.78:
            say(" ".join(text.split()[:4]), rng.choice(("<h2>%s</h2>", "<h3>%s</h3>", "<h4>%s</h4>")))
        elif r < 0.86:
            body.append("<ul>")
            for _ in range(rng.randint(2, 5)):
                say(" ".join(rng.choice(texts).split()[:rng.randint(3, 20)]) + f" {rng.randint(0, 9999)}", "<li>%s</li>")
            body.append("</ul>")
        elif r < 0.92:
            say(text, rng.choice(("<blockquote>%s</blockquote>", "<pre>%s</pre>", "<dl><dd>%s</dd></dl>",
                                  "<figure><figcaption>%s</figcaption></figure>", "<table><tr><td>%s</td></tr></table>")))
        else:
            say(text, "<div>%s</div>")
        if rng.random() < 0.1:  # a short line in the text
            say(rng.choice(("All rights reserved.", "Licensed under the licence.", "See also", "No.", "1.")) + f" {rng.randint(0, 9999)}", "<p>%s</p>")
        if rng.random() < 0.15:
            body.append(_fill(rng.choice(_OUTSIDE[8:]), rng, texts))
    head = [_fill(rng.choice(_OUTSIDE), rng, texts) for _ in range(rng.randint(0, 4))]
    tail = [_fill(rng.choice(_OUTSIDE), rng, texts) for _ in range(rng.randint(0, 3))]
    if rng.random() < 0.85:
        tail.append(_fill(rng.choice(_BELOW), rng, texts))
    frame = rng.choice(_MAIN)
    page = "".join(head) + frame % "".join(body) + "".join(tail)
    if rng.random() < 0.25 and ("<article" in frame or "<main" in frame):
        page = rng.choice(_AROUND) % page
    start = rng.choice(_BODY) if rng.random() < 0.25 else "<html><body>"
    return start + page + "</body></html>", main


def training_pages(sample: list[str], made: int, seed: int = 11) -> tuple[list, list]:
    """Blocks and labels of the sample's marked pages and of ``made`` pages in random templates."""
    rng = random.Random(seed)
    pages, labels, texts = [], [], []
    for page in sample:
        bl = blocks(page)
        lab = weak_labels(bl) if bl else None
        if lab:
            pages.append([f for _, f in bl])
            labels.append(lab)
            texts += [t for (t, _), x in zip(bl, lab, strict=True) if x]
    if not texts:
        texts = [" ".join("".join(rng.choice("abdeimnorst") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(3, 60))) for _ in range(200)]
    texts = [" ".join(w[i:i + RUN]) for w in map(str.split, texts) for i in range(0, len(w), RUN)]
    for _ in range(made):
        page, main = _laid_out(rng, texts)
        bl = blocks(page)
        if bl:
            pages.append([f for _, f in bl])
            labels.append([int(t in main) for t, _ in bl])
    return pages, labels


def train(pages: DataFrame, train_pages: int = 150, made: int = 450):
    """(feature numbers, weights, transitions)."""
    every = max(1, pages.count() // max(1, train_pages))
    sample = [r["html"] for r in pages.where((F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0) & F.col("html").isNotNull())
              .select("html").limit(train_pages).collect()]
    feats, labels = training_pages(sample, made)
    return fit(feats, labels)


def fit(feats: list, labels: list):
    """(feature numbers, weights, transitions) of labelled pages, whole and in chains of at most ``PIECE`` blocks."""
    chains = [(f[i:i + PIECE], y[i:i + PIECE]) for f, y in zip(feats, labels, strict=True) for i in range(0, len(f), PIECE)]
    numbers: dict[str, int] = {}
    ids = [[[numbers.setdefault(k, len(numbers)) for k in b] for b in f] for f, _ in chains]
    w, tr = train_field(ids, [y for _, y in chains], len(numbers))
    return numbers, w, tr


def extract_text(page: str | None, model) -> str:
    numbers, w, tr = model
    bl = blocks(page)
    if not bl:
        return ""
    e = []
    for _, f in bl:
        x = y = 0.0
        for k in f:
            i = numbers.get(k)
            if i is not None:
                x += w[i][0]
                y += w[i][1]
        e.append((x, y))
    return "\n".join(t for (t, _), lab in zip(bl, viterbi(e, tr), strict=True) if lab)


def extract(pages: DataFrame, model, html_col: str = "html"):
    """Column expression with the main text."""
    small_batches(pages.sparkSession)
    numbers, w, tr = model
    shared = pages.sparkSession.sparkContext.broadcast((numbers, w.tolist(), tr.tolist()))  # a few hundred features

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([extract_text(p if isinstance(p, str) else None, shared.value) for p in s], dtype=object)

    return run.asNondeterministic()(F.col(html_col))  # one call for all that reads it


def page_report(pages: DataFrame) -> DataFrame:
    model = train(pages.select("page_id", "html"))
    base = pages.select("page_id", "url", "html")
    return base.select("page_id", "url", extract(base, model).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
