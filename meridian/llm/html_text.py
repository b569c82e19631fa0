"""Main-text extraction by a tree-structured graphical model over the DOM.

Each block element of a page, and each run of text in one, is a node that is
main text or not. A node's features (tag, hints in its class, id and role,
share of linked text) shape the potential between it and its parent.
Sum-product message passing, once upward and once downward, gives every
node's exact marginal; the runs of text that are main text with over half
the probability are kept. The potentials are counted from labelled pages
(``labelled_pages``) on the driver.

Inside a run, white space becomes one space; runs are joined by one line
break in page order. Scripts, styles, templates, form fields and comments in
the markup are never text. Character references are decoded.

Defined results: null, empty and blank pages, and pages without main text,
give ''; unclosed and stray tags are mended as browsers do for paragraphs and
lists; repeated rows give repeated results; other columns are not used.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import ship

# HTML element names
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("""head title script style template noscript noframes svg math iframe object canvas audio video
    select option optgroup datalist textarea button""".split())
# a start tag on the left ends an open element on the right, up to the container
ENDS_P = BLOCKS - frozenset("body caption html legend li dd dt summary tbody td tfoot th thead tr".split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}

# elements whose names say as much as a class does
APART = frozenset("header footer nav aside form menu dialog".split())

# Words of class, id and role attributes, by what they hint at
HINTS = {
    "ad": "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion doubleclick",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs toolbar skip topbar search",
    "edge": "header masthead footer foot copyright legal contentinfo colophon bottom top",
    "side": "sidebar side aside widget widgets rail related recommended recommendations popular trending more complementary",
    "note": "cookie cookies consent gdpr notice notification alert popup modal overlay dialog subscribe newsletter signup paywall disclaimer",
    "form": "form login signin register contact feedback",
    "talk": "comment comments respond reply replies discussion disqus review reviews thread responses",
    "share": "share sharing social follow tweet facebook twitter meta byline tags tag author hidden",
    "main": "article content main post entry story body text blog page prose maincontent articlebody",
}
HINT_OF = {w: kind for kind, words in HINTS.items() for w in words.split()}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def hint(attrs: dict[str, str | None]) -> str:
    """What an element's names hint at: the first kind found that isn't main
    text, else ``main``, else ``none``."""
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", ""):
        return "share"
    kinds = [HINT_OF[w.lower()] for key in ("class", "id", "role", "itemprop") for w in _NAME.findall(attrs.get(key) or "")
             if w.lower() in HINT_OF]
    return next((k for k in kinds if k != "main"), "main" if kinds else "none")


class Page(HTMLParser):
    """The nodes of a page, parents first: ``parent``, ``tag`` (``#run`` for a
    run of text), ``hints``, ``texts``, ``length`` and ``linked`` characters."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.hints, self.label = [-1], ["#page"], ["none"], [None]
        self.texts: list[str | None] = [None]
        self.length, self.linked = [0], [0]
        self.open: list[tuple[str, int]] = [("#page", 0)]  # (tag, node of the nearest block)
        self.silent = self.links = 0
        self.buffer: list[str] = []
        self.buffer_linked = 0
        self.feed(html)
        self.close()
        self.flush()
        for i in range(len(self.parent) - 1, 0, -1):
            self.length[self.parent[i]] += self.length[i]
            self.linked[self.parent[i]] += self.linked[i]

    def node(self, tag: str, kind: str, label, text: str | None = None) -> int:
        self.parent.append(self.open[-1][1])
        self.tag.append(tag)
        if kind == "none" and tag in APART:
            kind = tag
        around = self.hints[self.open[-1][1]]  # what the ancestors hint at counts as well
        self.hints.append(around if kind == "none" and around.startswith("in ") else
                          f"in {around}" if kind == "none" and around not in ("none", "main") else kind)
        self.label.append(label)
        self.texts.append(text)
        self.length.append(len(text) if text else 0)
        self.linked.append(0)
        return len(self.parent) - 1

    def flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        if text:
            n = self.node("#run", "none", None, text)
            self.linked[n] = min(self.buffer_linked, len(text))
        self.buffer, self.buffer_linked = [], 0

    def pop_to(self, depth: int) -> None:
        for tag, _ in self.open[depth:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.open[depth:]

    def find(self, tags, stop=()) -> int:
        for d in range(len(self.open) - 1, 0, -1):
            if self.open[d][0] in tags:
                return d
            if self.open[d][0] in stop:
                return 0
        return 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS or tag in ENDS:
            if tag in BLOCKS:
                self.flush()
            if tag in ENDS_P and (d := self.find({"p"}, {"td", "th", "button", "object"})):
                self.pop_to(d)
            if tag in ENDS and (d := self.find(*ENDS[tag])):
                self.pop_to(d)
        if tag == "br":
            self.buffer.append(" ")
        if tag in VOID:
            return
        at = self.open[-1][1]
        if tag in BLOCKS:
            names = dict(attrs)
            at = self.node(tag, hint(names), names.get("data-main"))
        self.open.append((tag, at))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # HTML knows no self-closing elements but the void ones

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        if d := self.find({tag}):
            self.pop_to(d)

    def handle_data(self, data):
        if not self.silent:
            self.buffer.append(data)
            if self.links:
                self.buffer_linked += len(data.strip())

    def features(self, i: int) -> tuple:
        n = self.length[i]
        share = self.linked[i] / n if n else 0.0
        links = 0 if share < 0.2 else 1 if share < 0.6 else 2
        if self.tag[i] == "#run":
            return (("run", links),)
        return (("tag", self.tag[i]), ("hint", self.hints[i]), ("links", links))


class Model:
    """Potentials between a node and its parent, counted from labelled pages:
    how often a child of a main (or other) parent is main (or other), and how
    often such a child has each of its features. So an ``article`` speaks for
    a change to main text, an ``aside`` for a change back, and a ``p`` for
    neither."""

    SMOOTH = 0.01

    def __init__(self, pages: list[str]):
        seen: dict[tuple, Counter] = {}
        states = [(p, c) for p in (0, 1) for c in (0, 1)]
        moves: Counter = Counter()
        for html in pages:
            page = Page(html)
            y = [0]
            for i in range(1, len(page.parent)):
                own = page.label[i]
                y.append(y[page.parent[i]] if own is None else int(own))
                state = (y[page.parent[i]], y[i])
                moves[state] += 1
                for f in page.features(i):
                    seen.setdefault(f, Counter())[state] += 1
        kinds: dict[str, list[tuple]] = {}
        for f in seen:
            kinds.setdefault(f[0], []).append(f)
        self.move = [math.log((moves[s] + 1) / (moves[s[0], 0] + moves[s[0], 1] + 2)) for s in states]
        self.odds: dict[tuple, list[float]] = {}
        self.rare: dict[str, list[float]] = {}
        for kind, features in kinds.items():
            total = [sum(seen[f][s] for f in features) + self.SMOOTH * (len(features) + 1) for s in states]
            self.rare[kind] = [math.log(self.SMOOTH / t) for t in total]
            for f in features:
                self.odds[f] = [math.log((seen[f][s] + self.SMOOTH) / t) for s, t in zip(states, total)]

    def potential(self, features: tuple) -> tuple[float, ...]:
        """Weights of (parent, child) = (0, 0), (0, 1), (1, 0), (1, 1)."""
        out = list(self.move)
        for f in features:
            for k, v in enumerate(self.odds.get(f) or self.rare[f[0]]):
                out[k] += v
        top = max(out)
        return tuple(math.exp(v - top) for v in out)

    def marginals(self, page: Page) -> list[float]:
        """The probability that a node is main text, given the whole page."""
        n, parent = len(page.parent), page.parent
        known: dict[tuple, tuple] = {}
        pot = [(1.0, 0.0, 0.0, 0.0)] * n
        for i in range(1, n):
            f = page.features(i)
            pot[i] = known.get(f) or known.setdefault(f, self.potential(f))
        below0, below1 = [1.0] * n, [1.0] * n   # what the children say
        up0, up1 = [1.0] * n, [1.0] * n         # what a node tells its parent
        for i in range(n - 1, 0, -1):
            a, b, c, d = pot[i]
            u0, u1 = a * below0[i] + b * below1[i], c * below0[i] + d * below1[i]
            t = u0 + u1 or 1.0
            up0[i], up1[i] = u0 / t, u1 / t
            p = parent[i]
            x, y = below0[p] * u0 / t, below1[p] * u1 / t
            t = x + y or 1.0
            below0[p], below1[p] = x / t, y / t
        from0, from1 = [1.0] * n, [0.0] * n     # what a node's parent tells it
        out = [0.0] * n
        for i in range(1, n):
            p = parent[i]
            # all that the parent knows but from this child
            x, y = from0[p] * below0[p] / max(up0[i], 1e-300), from1[p] * below1[p] / max(up1[i], 1e-300)
            a, b, c, d = pot[i]
            d0, d1 = x * a + y * c, x * b + y * d
            t = d0 + d1 or 1.0
            from0[i], from1[i] = d0 / t, d1 / t
            x, y = from0[i] * below0[i], from1[i] * below1[i]
            out[i] = y / (x + y or 1.0)
        return out

    def text(self, html: str) -> str:
        page = Page(html)
        if len(page.parent) == 1:
            return ""
        belief = self.marginals(page)
        return "\n".join(t for t, b in zip(page.texts, belief) if t is not None and b > 0.5)


def labelled_pages() -> list[str]:
    """Pages whose elements are marked as main text (``data-main="1"``) or not
    (``"0"``); children are as their parent unless marked. Every kind of main
    part stands among changing kinds of other parts."""
    words = "the river runs past old stone houses where people sell bread and apples in the early morning light".split()

    def sentence(k: int, n: int) -> str:
        return " ".join(words[(k + 3 * i) % len(words)] for i in range(n)).capitalize() + "."

    def para(k: int) -> str:
        return "<p>" + " ".join(sentence(k + i, 6 + (k + i) % 9) for i in range(1 + k % 8)) + "</p>"

    def links(k: int, tag: str = "ul") -> str:
        return f"<{tag}>" + "".join(f'<li><a href="/{i}">{words[(k + i) % len(words)]}</a></li>' for i in range(3 + k % 4)) + f"</{tag}>"

    def inner(k: int) -> str:
        parts = [f"<h1>{sentence(k, 5)}</h1>", para(k), para(k + 1), "<p>Yes. So.</p>", "<p>Short line</p>", f"<h2>{sentence(k, 3)[:-1]}</h2>", para(k + 4),
                 f"<blockquote><p>{sentence(k, 12)}</p></blockquote>", f"<ul><li>{sentence(k, 7)}</li><li>{sentence(k + 1, 5)[:-1]}</li></ul>",
                 f"<table><tbody><tr><td>{words[k % 7]}</td><td>{sentence(k, 4)[:-1]}</td></tr></tbody></table>", f"<pre>{sentence(k, 9)}</pre>",
                 f"<figure><figcaption>{sentence(k, 6)}</figcaption></figure>", f'<p>{sentence(k, 5)} <a href="/x">{sentence(k, 2)}</a></p>',
                 f'<div>{para(k + 2)}</div>', f"<section><h3>{sentence(k, 4)[:-1]}</h3>{para(k + 3)}</section>", f"<ol><li>{sentence(k, 9)}</li></ol>",
                 f"<dl><dt>{words[k % 9]}</dt><dd>{sentence(k, 8)}</dd></dl>"]
        chosen = parts[:5] + [para(k + i) for i in range(k % 7)] + [parts[5 + (k * 5 + 7 * i) % (len(parts) - 5)] for i in range(k % 5)]
        return "".join(chosen)

    def other(k: int) -> list[str]:
        p, s = para(k), sentence(k, 7)
        return [f'<nav data-main="0">{links(k)}</nav>', f'<header data-main="0"><h1>{s[:-1]}</h1><p>{sentence(k, 5)}</p></header>',
                f'<div class="ad" data-main="0">{s}</div>', f'<div class="advert banner" data-main="0">{p}</div>',
                f'<aside data-main="0"><h3>{s[:-1]}</h3>{p}</aside>', f'<div id="sidebar" data-main="0">{links(k)}{p}</div>',
                f'<footer data-main="0">&copy; {s}</footer>', f'<footer data-main="0"><p>{s}</p>{links(k)}</footer>',
                f'<div class="cookie-notice" data-main="0"><p>{s}</p></div>', f'<div class="popup" data-main="0">{s}</div>',
                f'<form data-main="0"><p>{s}</p><label>{words[k % 8]}</label><input></form>', f'<form class="newsletter" data-main="0">{s}</form>',
                f'<section id="comments" data-main="0"><h2>Comments</h2><div class="comment">{p}</div><div class="comment">{para(k + 5)}</div></section>',
                f'<div class="comments" data-main="0"><ul><li>{s}</li><li>{sentence(k, 14)}</li></ul></div>',
                f'<div class="related" data-main="0">{links(k)}</div>', f'<div class="share social" data-main="0">{links(k)}</div>',
                f'<div class="menu" data-main="0">{links(k)}</div>', f'<ul class="breadcrumbs" data-main="0"><li><a href="/">{words[k % 5]}</a></li></ul>',
                f'<div class="header" data-main="0">{s}</div>', f'<div class="footer" data-main="0"><p>{s}</p></div>',
                f'<div class="login form" data-main="0">{s}</div>', f'<section class="comments" data-main="0"><article class="comment"><p>{s}</p></article><article>{p}</article></section>',
                f'<div class="cookie-banner" data-main="0">{p}{para(k + 1)}</div>', f'<div class="sidebar" data-main="0">{s} {sentence(k, 4)}</div>',
                f'<div class="notice" data-main="0">{s}</div>', f'<aside data-main="0">{s} {sentence(k, 5)}</aside>', f'<form data-main="0">{s[:-1]}</form>', f'<dialog data-main="0"><p>{s}</p></dialog>', f'<menu data-main="0">{links(k)}</menu>']

    mains = ["<article data-main='1'>{}</article>", "<article data-main='1'>{}</article>", "<article id='post-7' data-main='1'>{}</article>", "<main data-main='1'><article>{}</article></main>", "<main data-main='1'>{}</main>",
             "<div class='content' data-main='1'>{}</div>", "<div id='wrapper'><div class='post-body' data-main='1'>{}</div></div>",
             "<section class='entry' data-main='1'>{}</section>", "<div data-main='1'>{}</div>", "<div><article class='story' data-main='1'>{}</article></div>"]
    pages = []
    for k in range(96):
        around, extra = other(k), other(k + 1)
        pick = [around[(k + 5 * i) % len(around)] for i in range(5)]
        body = inner(k)
        if k % 3:  # some part of the other kind inside the main part
            cut = body.index("</p>") + 4
            part = extra[k % len(extra)]
            body = body[:cut] + part + body[cut:] + extra[(k + 9) % len(extra)]
        if k % 24 == 23:
            page = f'<html><body data-main="1">{body if k % 48 == 23 else sentence(k, 20)}{pick[0]}</body></html>'
        else:
            page = f'<html><body>{pick[0]}{pick[1]}{mains[k % len(mains)].format(body)}{pick[2]}{pick[3]}{pick[4]}</body></html>'
        pages.append(page)
    return pages


def _extract_batches(model: Model):
    def run(batches):
        for batch in batches:
            texts = [model.text(h.as_py() or "") for h in batch.column("_html")]
            keep = [n for n in batch.schema.names if n != "_html"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(texts, pa.string())], names=[*keep, "text"])
    return run


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row of ``pages``: ``_id``, ``url``, ``text``, ``n_chars``."""
    src = pages.select(F.col(page_id).alias("_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("_html"))
    schema = T.StructType([src.schema["_id"], src.schema["url"], T.StructField("text", T.StringType())])
    return src.mapInArrow(_extract_batches(Model(labelled_pages())), schema).withColumn("n_chars", F.length("text").cast("long"))


ship(__name__)
