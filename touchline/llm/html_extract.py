"""Main-text extraction by a tree-structured graphical model over the DOM.

A page becomes a tree: its elements, and below them one leaf for each run of
inline text of a block.  Every node has a hidden label: structure (wraps
content and other things), content, chrome (menus, footers, forms), or prose
that is not content (comments, notices, adverts).  Node potentials are
smoothed likelihoods of the node's features (tag, groups of class / id / role
words, text length, link density, closing punctuation); edge potentials are
the parent-child label probabilities.  Sum-product messages go upward from the
leaves and downward from the root; a leaf whose marginal says content is kept.

Training (bounded): labelled pages are layouts, marked below, filled with text
of at most ``sample`` pages of the table, and those sample pages that mark
their content by an article or main element.  Potentials are counts.

Text: scripts, styles, templates, form controls, the head, comments and tags are no
text; what formulas, drawings, media and noscript hold is text like other text;
character references are decoded; white space inside a block is one blank;
blocks are trimmed and joined by one blank in page order; nothing is dropped
from a kept block.  A null page, an empty one, or one without content gives "".
Broken markup is read as browsers do (open paragraphs end at the next block, a
cut-off tag is no text, a quote opens a value only behind "=").  Texts of any length are read whole; repeated rows
give equal results; empty tables give empty results.  Only page_id, url and
html are read.  Trees of any depth: nothing recurses.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import rows_batch, thinned

STRUCTURE, CONTENT, CHROME, PROSE = 0, 1, 2, 3
LABELS = 4
#: Words of a leaf from which a boilerplate region counts as prose.
PROSE_WORDS = 12
#: Longer pages are not drawn into the training sample (they are extracted like all others).
LONGEST_SAMPLE = 200_000
# Tag classes of HTML, and words of class, id and role attributes by what they mark.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title".split())  # their content is no markup, up to the closing tag
CONTROLS = frozenset("select button datalist".split())  # form controls: gone with their content, where they are closed
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var label br wbr img noscript iframe object canvas audio video picture svg g text tspan textpath math mi mn mo ms mtext "
    "mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts semantics "
    "annotation path circle ellipse rect line polyline polygon defs use symbol stop lineargradient radialgradient clippath mask filter "
    "foreignobject desc source track param embed".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split()
)
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
APART = {"nav": "menu", "aside": "side", "footer": "footer", "form": "form"}  # tags that say what such words say
SCOPES = frozenset("ul ol dl table html body div section article".split())
GROUPS = {
    "content": "article content main post entry story body text prose maincontent articlebody",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs toc tabs pager pagination navbox skip",
    "header": "header masthead banner topbar branding logo hero",
    "footer": "footer foot bottom copyright legal contentinfo colophon imprint",
    "side": "sidebar side aside related widget rail complementary recommended trending popular more tags",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay dialog newsletter subscribe paywall message warning",
    "advert": "ad ads adv advert advertisement adverts sponsor sponsored promo promotion banner-ad dfp outbrain taboola commercial",
    "form": "form search login signup register contact-form searchbox input",
    "comment": "comment comments reply replies disqus discussion respond commentlist thread feedback",
    "share": "share sharing social follow like tweet",
    "hidden": "hidden sr-only visually-hidden print-only noprint",
}
WORDS = {w: g for g, words in GROUPS.items() for w in words.split()}
TOKEN = re.compile(
    # a quote opens a value only directly behind "="; elsewhere it is a character like others
    r"<!--.*?-->|<!--|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=(?!\s*+[\"']))*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
#: Behind the last ">" of a page: an open comment or declaration, or a cut-off tag.
TAIL = re.compile(r"<!--.*|<[!?].*|</?[a-zA-Z][^<>]*\Z", re.S)
MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
GONE = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


class Page:
    """The tree of a page: parent of every node (nodes in document order), features, and the leaves' texts."""

    def __init__(self, source: str) -> None:
        self.parent, self.tag, self.features, self.attributes = [-1], ["#root"], [("t:#root",)], [""]
        self.leaf_text: dict[int, str] = {}
        self._parse(source)

    def _node(self, parent: int, tag: str, features: tuple, attributes: str = "") -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.features.append(features)
        self.attributes.append(attributes)
        return len(self.parent) - 1

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#root", 0)]  # open elements; inline ones keep their block's node
        run: list[str] = []
        linked, links = 0, 0
        at, n = 0, len(source)
        closed = source.rfind(">") + 1

        def flush() -> None:
            nonlocal linked
            text = " ".join(html_lib.unescape("".join(run)).split())
            if text:
                node = self._node(stack[-1][1], "#text", leaf_features(text, linked))
                self.leaf_text[node] = text
            run.clear()
            linked = 0

        while at < n:
            m = (at < closed and TOKEN.search(source, at, closed)) or TAIL.search(source, max(at, closed))
            chunk = source[at : m.start()] if m else source[at:]
            if chunk:
                run.append(chunk)
                if links:
                    linked += len(chunk)
            if not m:
                break
            if m.re is TAIL or m[0] == "<!--":
                break
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            closing, attributes = (m[1] or m[4]) == "/", m[3] or m[6] or ""
            if name == "head":
                if not closing:
                    end = re.compile(r"</head\s*>|<body\b", re.I).search(source, at)
                    at = (end.start() if end[0].lower().startswith("<b") else end.end()) if end else at
                continue
            if name in RAW:
                if not closing and not attributes.rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                    at = end.end() if end else n
                run.append(" ")
                continue
            if name in CONTROLS:
                end = None if closing else re.compile(rf"</{name}\s*>", re.I).search(source, at)
                at = end.end() if end else at
                run.append(" ")
                continue
            if name in INLINE:
                if name in ("br", "wbr", "img"):
                    run.append(" " if name == "br" else "")
                elif name == "a":
                    links = max(0, links + (-1 if closing else 1))
                continue
            flush()
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
                links = 0
                continue
            if name in CLOSES_P and any(t == "p" for t, _ in stack[-3:]):
                while stack[-1][0] != "p":
                    stack.pop()
                stack.pop()
            if name in ENDS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in ENDS[name]:
                        del stack[k:]
                        break
                    if stack[k][0] in SCOPES:
                        break
            links = 0
            if name not in VOID and not attributes.rstrip().endswith("/"):
                stack.append((name, self._node(stack[-1][1], name, element_features(name, attributes), attributes)))
        flush()


def element_features(tag: str, attributes: str) -> tuple[str, ...]:
    groups = {APART[tag]} if tag in APART else set()
    for m in MARKS.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        for word in re.split(r"[\s_-]+|(?<=[a-z])(?=[A-Z])", value):
            if (g := WORDS.get(word.lower().rstrip("0123456789"))) is not None:
                groups.add(g)
        if (g := WORDS.get(value.strip().lower())) is not None:
            groups.add(g)
    if attributes and GONE.search(attributes):
        groups.add("hidden")
    return ("t:" + tag, *sorted("g:" + g for g in groups))


def leaf_features(text: str, linked: int) -> tuple[str, ...]:
    words, share = text.count(" ") + 1, linked / max(len(text), 1)
    return (
        "l:" + str(min(words.bit_length(), 6)),
        "d:" + ("0" if share == 0 else "1" if share < 0.4 else "2" if share < 0.8 else "3"),
        "e:" + ("1" if text[-1] in ".!?…:;\"”»)" else "0"),
    )


# --- labelled pages (fixed values): y=1 content, y=0 boilerplate; {p} a paragraph, {s} a short text, {a} links
LAYOUTS = (
    "<body><nav>{a}</nav><article y=1><h1>{s}</h1><p>{p}</p><p>{p}</p><p>{s}</p></article><footer>{s}</footer></body>",
    "<body><header><div class=logo>{s}</div><ul class=menu>{a}</ul></header><div class=ad>{p}</div><main y=1><h1>{s}</h1><p>{p}</p>"
    "<h2>{s}</h2><p>{p}</p><ul><li>{s}</li><li>{p}</li></ul><section id=comments y=0><h3>{s}</h3><div class=comment><p>{p}</p></div>"
    "<div class=comment><p>{p}</p></div><form><p>{s}</p></form></section></main><aside>{a}<p>{p}</p></aside><footer><p>{p}</p></footer></body>",
    "<body><div id=wrapper><div class=header>{s}</div><div class=navbar>{a}</div><div class=content><div class=post y=1><h2>{s}</h2>"
    "<p>{p}</p><blockquote><p>{p}</p></blockquote><p>{p}</p><div class=share y=0>{a}</div></div><div class=sidebar><h3>{s}</h3><p>{p}</p>{a}"
    "</div></div><div class=footer>{s}{a}</div></div></body>",
    "<body><div class='cookie-notice'><p>{p}</p></div><div class=page><div y=1><p>{p}</p><p>{p}</p><p>{s}</p><table><tr><td>{s}</td><td>{s}</td>"
    "</tr></table></div><div class='related posts'><p>{p}</p>{a}</div></div><div id=newsletter><form><p>{p}</p></form></div></body>",
    "<body><div role=banner>{s}</div><div role=navigation>{a}</div><div role=main y=1><h1>{s}</h1><div>{p}</div><div>{p}</div><pre>{p}</pre>"
    "<div class=advertisement y=0>{p}</div><p>{p}</p></div><div role=complementary><p>{p}</p></div><div role=contentinfo>{p}</div></body>",
    "<body><table><tr><td class=menu>{a}</td><td y=1><p>{p}</p><p>{p}</p><h3>{s}</h3><p>{p}</p></td></tr></table><p class=copyright>{s}</p></body>",
    "<body><p y=1>{p}</p><p y=1>{p}</p><p y=1>{s}</p><div y=1>{p}</div></body>",
    "<body><section y=1><h1>{s}</h1><p>{p}</p><figure><figcaption>{s}</figcaption></figure><p>{p}</p><dl><dt>{s}</dt><dd>{p}</dd></dl></section>"
    "<section class=comments><p>{p}</p><p>{p}</p></section><div class=promo><p>{p}</p></div><div class=popup>{s}</div><form class=search>{s}"
    "</form></body>",
    "<body><article y=1><header><h1>{s}</h1></header><p>{p}</p><p>{p}</p><aside class=pullquote y=0>{p}</aside><div class=ad y=0>{s}</div><p>{p}</p>"
    "<footer y=0>{s}</footer></article><div class=sponsored>{p}</div></body>",
    "<body><header><h2>{s}</h2><nav>{a}</nav></header><main y=1><h1>{s}</h1><ul><li>{s}</li><li>{s}</li><li>{s}</li></ul><p>{p}</p><form y=0>"
    "<p>{s}</p><p>{p}</p></form><ol><li>{s}</li><li>{p}</li></ol></main><footer><p>{s}</p></footer></body>",
    "<body><header><h1>{s}</h1><p>{s}</p></header><article y=1><h2>{s}</h2><ul><li>{s}</li><li>{s}</li><li>{s}</li><li>{s}</li></ul><p>{p}</p>"
    "<form y=0>{s}<p>{p}</p></form></article><nav>{a}</nav><form><p>{p}</p></form></body>",
)


def filled_layouts(texts: list[str], turns: int = 6, seed: int = 5) -> list[str]:
    rng = np.random.default_rng(seed)
    long_ = [t for t in texts if t.count(" ") >= 12] or ["one of many plain sentences that say a few things about the matter at hand, and end."]
    short = [" ".join(t.split()[:6]) for t in long_]
    pick = lambda pool: html_lib.escape(pool[int(rng.integers(len(pool)))])
    links = lambda _: "<ul>" + "".join(f"<li><a href=x>{pick(short)}</a></li>" for _ in range(5)) + "</ul>"
    out = []
    for _ in range(turns):
        for layout in LAYOUTS:
            page = re.sub(r"\{p\}", lambda _: pick(long_), layout)
            out.append(re.sub(r"\{a\}", links, re.sub(r"\{s\}", lambda _: pick(short), page)))
    return out


def region_labels(page: Page, marked: bool) -> list[int] | None:
    """Labels of a page's nodes from its marks (layouts) or its article / main element (sample pages)."""
    n = len(page.parent)
    label = [CHROME] * n
    region = list(range(n))  # the topmost node of the same kind
    for i in range(1, n):
        p = page.parent[i]
        label[i] = label[p]
        if marked:
            if (m := re.search(r"\by=([01])", page.attributes[i])) is not None:
                label[i] = CONTENT if m[1] == "1" else CHROME
        elif page.tag[i] in ("article", "main"):
            label[i] = CONTENT
        elif label[i] == CONTENT and (page.tag[i] in APART or any(f[:2] == "g:" and f != "g:content" for f in page.features[i])):
            label[i] = CHROME
        region[i] = region[p] if label[i] == label[p] and p and page.tag[p] != "body" and page.tag[p] != "html" else i
    if CONTENT not in label:
        return None
    for i in range(n - 1, 0, -1):  # what wraps content is structure
        if label[i] in (CONTENT, STRUCTURE) and label[page.parent[i]] == CHROME:
            label[page.parent[i]] = STRUCTURE
    label[0] = STRUCTURE
    prose = {region[i] for i, t in page.leaf_text.items() if label[i] == CHROME and t.count(" ") >= PROSE_WORDS}
    return [PROSE if y == CHROME and region[i] in prose else y for i, y in enumerate(label)]


def fit(sample_pages: list[str]) -> dict:
    """Potentials (plain values): edge[parent label][label], node[feature][label]."""
    parsed = [Page(p) for p in sample_pages]
    texts = [t for p in parsed for t in p.leaf_text.values()]
    labelled = [(p, y) for p in parsed if (y := region_labels(p, False)) is not None]
    labelled += [(p, region_labels(p, True)) for p in map(Page, filled_layouts(texts, max(6, 2 * len(labelled) // len(LAYOUTS))))]
    edge = np.full((LABELS, LABELS), 0.5)
    for y in (CONTENT, CHROME, PROSE):
        edge[y, STRUCTURE] = edge[y, CONTENT] = 1e-3
    edge[CONTENT, CONTENT] = 0.5
    counts: dict[str, np.ndarray] = {}
    for page, y in labelled:
        for i in range(1, len(y)):
            edge[y[page.parent[i]], y[i]] += 1
            for f in page.features[i]:
                counts.setdefault(f, np.zeros(LABELS))[y[i]] += 1
            if page.tag[i] != "#text" and len(page.features[i]) == 1:
                counts.setdefault("g:none", np.zeros(LABELS))[y[i]] += 1
    kinds: dict[str, np.ndarray] = {}
    for f, c in counts.items():
        kinds[f[:2]] = kinds.get(f[:2], np.zeros(LABELS)) + c
    least = {"t:": 0.1, "g:": 0.02}  # pseudo-counts: group words seldom lie
    node = {f: ((c + least.get(f[:2], 0.5)) / (kinds[f[:2]] + 20 * least.get(f[:2], 0.5))).tolist() for f, c in counts.items()}
    for f in node:  # a leaf's length, links and ending say much the same: together they count as half
        if f[:2] in ("l:", "d:", "e:"):
            node[f] = np.sqrt(node[f]).tolist()
    for g in GROUPS:  # a group unseen in training says what its name says
        node.setdefault("g:" + g, [0.05, 0.05, 1e-4, 1e-4] if g == "content" else [1e-3, 1e-4, 0.05, 0.05])
    return {"edge": (edge / edge.sum(axis=1, keepdims=True)).tolist(), "node": node}


def content_marginals(page: Page, model: dict) -> list[float]:
    """P(content) of every node by one upward and one downward pass of sum-product messages."""
    (e00, e01, e02, e03), (e10, e11, e12, e13), (e20, e21, e22, e23), (e30, e31, e32, e33) = model["edge"]
    potential, none = model["node"], model["node"].get("g:none")
    n, parent, tags = len(page.parent), page.parent, page.tag
    up = [[1.0, 1.0, 1.0, 1.0] for _ in range(n)]  # node potential times the children's messages
    sent = [(1.0, 1.0, 1.0, 1.0)] * n
    for i in range(n - 1, 0, -1):
        a, b, c, d = up[i]
        features = page.features[i]
        for f in features:
            if (w := potential.get(f)) is not None:
                a, b, c, d = a * w[0], b * w[1], c * w[2], d * w[3]
        if tags[i] == "#text":
            a = 0.0
        elif len(features) == 1 and none is not None:
            a, b, c, d = a * none[0], b * none[1], c * none[2], d * none[3]
        top = max(a, b, c, d) or 1.0
        a, b, c, d = a / top, b / top, c / top, d / top
        up[i] = [a, b, c, d]
        m0 = e00 * a + e01 * b + e02 * c + e03 * d
        m1 = e10 * a + e11 * b + e12 * c + e13 * d
        m2 = e20 * a + e21 * b + e22 * c + e23 * d
        m3 = e30 * a + e31 * b + e32 * c + e33 * d
        top = max(m0, m1, m2, m3)
        m0, m1, m2, m3 = m0 / top + 1e-200, m1 / top + 1e-200, m2 / top + 1e-200, m3 / top + 1e-200
        sent[i] = (m0, m1, m2, m3)
        p = up[parent[i]]
        p[0], p[1], p[2], p[3] = p[0] * m0, p[1] * m1, p[2] * m2, p[3] * m3
        top = max(p)
        if top < 1e-50:
            p[0], p[1], p[2], p[3] = p[0] / top, p[1] / top, p[2] / top, p[3] / top
    belief = [(1.0, 0.0, 0.0, 0.0)] * n
    out = [0.0] * n
    for i in range(1, n):
        q, m, u = belief[parent[i]], sent[i], up[i]
        x, y, z, v = q[0] / m[0], q[1] / m[1], q[2] / m[2], q[3] / m[3]  # the parent without this child's message
        top = max(x, y, z, v) or 1.0
        x, y, z, v = x / top, y / top, z / top, v / top
        a = (x * e00 + y * e10 + z * e20 + v * e30) * u[0]
        b = (x * e01 + y * e11 + z * e21 + v * e31) * u[1]
        c = (x * e02 + y * e12 + z * e22 + v * e32) * u[2]
        d = (x * e03 + y * e13 + z * e23 + v * e33) * u[3]
        total = (a + b + c + d) or 1.0
        belief[i] = (a / total, b / total, c / total, d / total)
        out[i] = b / total
    return out


def main_text(source: str | None, model: dict) -> tuple[str, int, float]:
    """(text, blocks kept, smallest marginal among them)."""
    if not source:
        return "", 0, 0.0
    page = Page(source)
    marginal = content_marginals(page, model)
    kept = [i for i in page.leaf_text if marginal[i] >= 0.5]  # in page order
    return " ".join(page.leaf_text[i] for i in kept), len(kept), min((marginal[i] for i in kept), default=0.0)


TEXTS = "page_id long, url string, text string, n_chars long, n_blocks int, confidence double"
TEXTS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_blocks", pa.int32()), ("confidence", pa.float64())])


def extract(pages: DataFrame, sample: int = 200) -> DataFrame:
    """Every page: page_id, url, text, n_chars, n_blocks, confidence."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    usable = src.filter((F.col("page_id").isNotNull()) & (F.length("html") <= LONGEST_SAMPLE))
    chosen = usable.filter(thinned(F.col("page_id"), usable.count(), sample)).orderBy(F.xxhash64("page_id"), F.xxhash64("html")).limit(sample).select("html")
    model = pages.sparkSession.sparkContext.broadcast(fit(sorted(r["html"] for r in chosen.collect())))

    def run(batches):
        m = model.value
        for b in batches:
            out = []
            for page, url, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                text, blocks, sure = main_text(source.as_py(), m)
                out.append((page, url, text, len(text), blocks, sure))
            yield rows_batch(out, TEXTS_ARROW)

    return src.mapInArrow(run, TEXTS)
