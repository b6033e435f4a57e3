"""Main text of HTML pages by a graphical model on the tree of their elements.

Every block element and every run of text in one is a variable: does it hold content?
Potentials of the single nodes come from tags, names, lengths and links, potentials of
parent and child from training. Sum-product messages, up the tree and down again, give
each run's marginal. The weights are trained from labelled pages.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame

from tidemark.llm.frames import map_texts

# Fixed values of HTML: elements without an end tag, with plain text inside, that stand in a
# line of text, and whose text is never shown as part of an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PLAIN = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "noembed", "xmp")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset("head button select option datalist canvas audio video object map".split())
#: An open element of the second kind ends where one of the first starts.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody"),
}
#: What keeps an end tag, or an implied end, from reaching further up.
_SCOPE = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}
_WALLS = frozenset(("table", "td", "th", "html", "body"))

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PLAIN_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in PLAIN}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node(NamedTuple):
    parent: int
    tag: str  # "#" for a run of text
    names: tuple[str, ...]
    text: str
    linked: int  # characters inside links


def parse(page: str) -> list[Node]:
    """Block elements and runs of text in page order; node 0 is the page itself."""
    nodes = [Node(-1, "#page", (), "", 0)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements, with their node
    inline: list[str] = []  # open elements inside the current run
    parts: list[str] = []
    linked = dropped = 0

    def end_run() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                nodes.append(Node(stack[-1][1], "#", (), text, linked))
            parts.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal dropped
        end_run()
        dropped -= sum(tag in DROPPED for tag, _ in stack[at:])
        del stack[at:]
        inline.clear()

    at = 0
    while at < len(page):
        hit = _TAG.search(page, at)
        text = page[at : hit.start() if hit else len(page)]
        if text and not dropped:
            parts.append(text)
            if "a" in inline:
                linked += len(text)
        if not hit:
            break
        at = hit.end()
        if not hit.group(2):
            continue
        ending, tag, rest = hit.group(1), hit.group(2).lower(), hit.group(3)
        if ending:
            if tag in INLINE:
                if tag in inline:
                    del inline[len(inline) - 1 - inline[::-1].index(tag) :]
            else:
                for n in range(len(stack) - 1, 0, -1):
                    if stack[n][0] == tag:
                        close(n)
                        break
                    if stack[n][0] in _WALLS and tag not in _WALLS and tag not in ("table", "tr", "tbody", "thead"):
                        break
            continue
        if tag in _PLAIN_END:
            if not rest.endswith("/"):
                stop = _PLAIN_END[tag].search(page, at)
                at = stop.end() if stop else len(page)
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag not in VOID:
                inline.append(tag)
            continue
        # a block starts: it ends the run, an open paragraph, and what it cannot stand in
        end_run()
        for n in range(len(stack) - 1, 0, -1):
            if stack[n][0] == "p":
                close(n)
                break
            if stack[n][0] in _WALLS:
                break
        for n in range(len(stack) - 1, 0, -1):
            if stack[n][0] in _ENDS.get(tag, ()):
                close(n)
                break
            if stack[n][0] in _SCOPE.get(tag, _WALLS):
                break
        if tag in VOID:
            continue
        if tag == "body":  # ends the head even where its end tag is missing
            for n in range(len(stack) - 1, 0, -1):
                if stack[n][0] == "head":
                    close(n)
        names = []
        for name, *values in _ATTRIBUTE.findall(rest) if rest else ():
            value = "".join(values)
            name = name.lower()
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                names += [w.lower() for w in _NAME.findall(value)]
            elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower():
                names.append("hidden")
        nodes.append(Node(stack[-1][1], tag, tuple(names), "", 0))
        stack.append((tag, len(nodes) - 1))
        inline.clear()
        dropped += tag in DROPPED
    end_run()
    return nodes


#: Tags that say nothing about what stands further down.
_NEUTRAL = frozenset("#page # html body div p span h1 h2 h3 h4 h5 h6 li tr tbody td table".split())
_STOPS = re.compile(r"[.!?:;,…。]")


def features(nodes: list[Node]) -> list[list[str]]:
    """Names of what holds for each node, given the whole tree."""
    size, links, runs, inside = [0] * len(nodes), [0] * len(nodes), [0] * len(nodes), [False] * len(nodes)
    holds = [False] * len(nodes)  # an article or main element below
    for n in range(len(nodes) - 1, -1, -1):
        node = nodes[n]
        if node.tag == "#":
            size[n], links[n], runs[n] = len(node.text), min(node.linked, len(node.text)), 1
        holds[n] |= node.tag in ("article", "main")
        if node.parent >= 0:
            size[node.parent] += size[n]
            links[node.parent] += links[n]
            runs[node.parent] += runs[n]
            holds[node.parent] |= holds[n]
    some = holds[0]
    found = []
    under: list[tuple[str, ...]] = []
    for n, node in enumerate(nodes):
        inside[n] = node.tag in ("article", "main") or node.parent >= 0 and inside[node.parent]
        above = under[node.parent] if node.parent >= 0 else ()
        own_names = [w for w in (node.tag, *node.names) if w not in _NEUTRAL and w not in above]
        under.append((*above, *dict.fromkeys(own_names)) if own_names else above)
        share = links[n] / size[n] if size[n] else 0.0
        dense = f"link{min(3, int(4 * share))}"
        length = f"size{min(9, size[n].bit_length())}"
        if node.tag == "#":
            parent = nodes[node.parent].tag
            stops = min(3, len(_STOPS.findall(node.text)) * 40 // (len(node.text) + 20))
            own = ["run", f"run-{length}", f"run-{dense}", f"in-{parent}", f"stops{stops}", f"{length}-{dense}"]
            own += [f"under-{w}" for w in above]
        else:
            own = ["element", f"tag-{node.tag}", f"all-{length}", f"all-{dense}", f"runs{min(4, runs[n].bit_length())}"]
            own += [f"name-{w}" for w in dict.fromkeys(node.names)]
        if some:
            own.append("within" if inside[n] else "around" if holds[n] else "outside")
        found.append(own)
    return found


class Model(NamedTuple):
    """Log-odds of each feature, and log potentials of (parent, child) for runs and elements."""

    weights: dict[str, float]
    pairs: dict[bool, list[list[float]]]


def _beliefs(nodes: list[Node], odds: list[float], model: Model) -> tuple[list[float], list[list[float]]]:
    """Marginals of content by messages up and then down, and each node's upward messages."""
    n = len(nodes)
    ties = {kind: [[math.exp(x) for x in row] for row in table] for kind, table in model.pairs.items()}
    up0, up1 = [0.0] * n, [0.0] * n
    for i, x in enumerate(odds):
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
        up0[i], up1[i] = 1 - p, p
    to0, to1 = [1.0] * n, [1.0] * n
    for i in range(n - 1, 0, -1):
        total = up0[i] + up1[i]
        a, b = up0[i] / total, up1[i] / total
        up0[i], up1[i] = a, b
        tie = ties[nodes[i].tag == "#"]
        m0, m1 = tie[0][0] * a + tie[0][1] * b, tie[1][0] * a + tie[1][1] * b
        total = m0 + m1
        to0[i], to1[i] = m0 / total, m1 / total
        parent = nodes[i].parent
        up0[parent] *= to0[i]
        up1[parent] *= to1[i]
        if up0[parent] + up1[parent] < 1e-100:
            up0[parent] *= 1e100
            up1[parent] *= 1e100
    belief = [0.0] * n
    pairs: list[list[float]] = [[]] * n
    total = up0[0] + up1[0]
    belief[0] = up1[0] / total
    for i in range(1, n):
        tie = ties[nodes[i].tag == "#"]
        parent = nodes[i].parent
        # the parent's belief without what this child told it
        a = max(1 - belief[parent], 1e-300) / max(to0[i], 1e-300)
        b = max(belief[parent], 1e-300) / max(to1[i], 1e-300)
        joint = [a * tie[0][0] * up0[i], a * tie[0][1] * up1[i], b * tie[1][0] * up0[i], b * tie[1][1] * up1[i]]
        total = sum(joint)
        joint = [x / total for x in joint]
        belief[i] = joint[1] + joint[3]
        pairs[i] = joint
    return belief, pairs


def train(pages: list[tuple[str, set[str]]], rounds: int = 10) -> Model:
    """From pages and the texts of their content runs, by steps up the likelihood.

    An element is content if some run below it is, so a child of boilerplate never is.
    """
    weights: dict[str, float] = {}
    squares: dict[object, float] = {}
    pairs = {kind: [[0.0, 0.0], [0.0, 0.0]] for kind in (True, False)}
    model = Model(weights, pairs)
    data = []
    for page, content in pages:
        nodes = parse(page)
        truth = [node.tag == "#" and node.text in content for node in nodes]
        for n in range(len(nodes) - 1, 0, -1):
            truth[nodes[n].parent] |= truth[n]
        data.append((nodes, features(nodes), truth))

    def step(key: object, grad: float) -> float:
        squares[key] = squares.get(key, 1e-3) + grad * grad
        return 0.3 * grad / math.sqrt(squares[key])

    for _ in range(rounds):
        for nodes, named, truth in data:
            odds = [sum(weights.get(f, 0.0) for f in own) for own in named]
            belief, joint = _beliefs(nodes, odds, model)
            change: dict[str, float] = {}
            for own, real, p in zip(named, truth, belief, strict=True):
                for f in own:
                    change[f] = change.get(f, 0.0) + real - p
            for f, grad in change.items():
                weights[f] = weights.get(f, 0.0) * 0.999 + step(f, grad)
            for kind in (True, False):
                grads = [0.0] * 4
                for i in range(1, len(nodes)):
                    if (nodes[i].tag == "#") == kind:
                        for k in range(4):
                            grads[k] -= joint[i][k]
                        grads[2 * truth[nodes[i].parent] + truth[i]] += 1
                for k, grad in enumerate(grads):
                    pairs[kind][k // 2][k % 2] = max(-8.0, min(8.0, pairs[kind][k // 2][k % 2] + step((kind, k), grad)))
    return model


def content_blocks(page: str, model: Model) -> list[str]:
    """The runs of text whose marginal is at least one half, in page order."""
    nodes = parse(page)
    odds = [sum(model.weights.get(f, 0.0) for f in own) for own in features(nodes)]
    belief, _ = _beliefs(nodes, odds, model)
    return [node.text for node, p in zip(nodes, belief, strict=True) if node.tag == "#" and p >= 0.5]


def extract(df: DataFrame, model: Model, key: str = "page_id", page: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``text``, ``n_chars`` and the columns in ``keep``.

    Runs of white space are one blank, blocks are joined by two line feeds. A null, empty or
    boilerplate page has an empty text. Each row is read alone, so repeated rows come out
    alike; other columns are not read.
    """

    def make():
        def work(keys: list, pages: list[str]) -> dict[str, list]:
            texts = ["\n\n".join(content_blocks(p, model)) for p in pages]
            return {key: keys, "text": texts, "n_chars": [len(t) for t in texts]}

        return work

    return map_texts(df, key, page, "text string, n_chars long", make, keep)


# How the labelled pages call the parts of a page.
_PARTS = {
    "nav": "nav div.menu ul.nav div#navbar div.navigation div#topnav nav.main-nav ul#menu div.breadcrumb div.breadcrumbs nav.pagination div.pager div.toc",
    "head": "header div#header div.site-header div.masthead div#top header.page-header div.topbar div.logo header#masthead",
    "foot": "footer div#footer div.site-footer div.copyright footer.page-footer div.bottom div#colophon div.legal",
    "side": "aside div.sidebar div#sidebar aside.widget div.widget-area div#right-column section.sidebar div.related section.related-posts div.recommended div.trending ul.popular",
    "note": "div.cookie-notice div#cookie-banner div.gdpr div.consent div.notice div.alert div@alert div.popup div.modal section.banner div.announcement div.disclaimer div.paywall div.warning aside.notice p.notice",
    "ad": "div.ad div.ads div.advert div.advertisement aside.ad div.sponsored div#ad-top div.ad-slot div.promo div.banner-ad section.sponsor div.adsbygoogle div.advertorial p.ad",
    "form": "form form.search div.newsletter form#subscribe div.login-form form.contact div.search-box form.comment-form div.signup fieldset",
    "talk": "section.comments div#comments div.comments ol.commentlist div.comment-section section#comments ul.comment-list div#disqus div.replies div.discussion section.reader-comments div.responses",
    "share": "div.share div.social ul.social-links div.share-buttons div.follow div.tags ul.tags div.sharing",
}
_BODIES = (
    "article main>article div.content>article article>div.entry-content div#content main div.post div.article-body "
    "section.story div.story div#main>div.text article.post div.page>div.post-content div.container>div div#main "
    "div@main td.content section div.wrapper>main>div body"
).split()


@lru_cache(maxsize=2)
def labelled_pages(count: int = 400, seed: int = 3) -> tuple[tuple[str, frozenset[str]], ...]:
    """Seeded pages of many layouts, with the texts of their content runs."""
    rng = random.Random(seed)
    syllables = [a + b for a in "b d f g k l m n p r s t v".split() for b in "a e i o u an er in on ut".split()]

    def words(n: int) -> str:
        made = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(max(1, n))]
        made[0] = made[0].capitalize()
        for i in range(6, len(made) - 1, rng.randint(5, 12)):
            made[i] += rng.choice((",", ".", ".", ";"))
        return " ".join(made)

    def sentence(n: int) -> str:
        return words(n) + rng.choice("..!?")

    def wrap(how: str, inner: str) -> str:
        for part in reversed(how.split(">")):
            tag, name, value = (re.split(r"([.#@])", part) + ["", ""])[:3]
            kind = {".": "class", "#": "id", "@": "role", "": ""}[name]
            inner = f'<{tag} {kind}="{value}">{inner}</{tag}>' if kind else f"<{tag}>{inner}</{tag}>"
        return inner

    def links(n: int) -> str:
        made = [f'<a href="/{i}">{words(rng.randint(1, 4))}</a>' for i in range(n)]
        return rng.choice(("<ul>" + "".join(f"<li>{x}</li>" for x in made) + "</ul>", " | ".join(made), " ".join(made)))

    def other(kind: str) -> str:
        how = rng.choice(_PARTS[kind].split())
        if kind == "nav" or kind == "share":
            inner = links(rng.randint(2, 9))
        elif kind == "head":
            inner = rng.choice((f"<h1>{words(2)}</h1>", f'<a href="/">{words(2)}</a>', f"<p>{words(5)}</p>")) + rng.choice(("", links(5)))
        elif kind == "foot":
            inner = rng.choice((f"&copy; {words(3)} &middot; {sentence(6)}", f"<p>{sentence(9)}</p>{links(4)}", f"<div>{words(4)}</div>"))
        elif kind == "side":
            inner = "<h{0}>{1}</h{0}>".format(rng.choice("234"), words(2)) + rng.choice((links(6), f"<p>{sentence(rng.randint(6, 40))}</p>"))
        elif kind == "form":
            inner = f"<label>{words(2)}</label><input name=q><p>{sentence(rng.randint(3, 15))}</p><button>{words(1)}</button>"
        elif kind == "talk":
            inner = f"<h3>{words(2)}</h3>" + "".join(
                rng.choice(("<div class=comment><b>{}</b><p>{}</p></div>", "<li><p>{1}</p></li>", "<article><p>{1}</p></article>", "<p>{1}</p>"))
                .format(words(2), sentence(rng.randint(4, 60)))
                for _ in range(rng.randint(1, 5))
            )
        else:
            inner = rng.choice(("{}", "<p>{}</p>", "<h3>{}</h3>", "<div><span>{}</span></div>")).format(sentence(rng.randint(2, 30)))
        if how.startswith("p."):  # a paragraph holds no blocks
            inner = sentence(rng.randint(2, 30))
        return wrap(how, inner)

    pages = []
    for _ in range(count):
        content: set[str] = set()

        def real(n: int, content: set[str] = content) -> str:
            text = sentence(n)
            content.add(text)
            return text

        blocks = []
        if rng.random() < 0.8:
            blocks.append(rng.choice(("<h1>{}</h1>", "<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h2>{}</h2>")).format(real(rng.randint(3, 9))))
        for _ in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.7:
                text = real(rng.choice((1, 4, 15, 40, 40, 80, 150)))
                blocks.append(rng.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>")).format(text))
            elif kind < 0.8:
                blocks.append(f"<h2>{real(rng.randint(2, 6))}</h2>")
            elif kind < 0.88:
                blocks.append("<ul>" + "".join(f"<li>{real(rng.randint(2, 20))}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.94:
                blocks.append(f"<blockquote><p>{real(25)}</p></blockquote>")
            elif kind < 0.97:
                blocks.append(f"<figure><img src=x><figcaption>{real(8)}</figcaption></figure>")
            else:
                blocks.append(f"<table><tr><td>{real(4)}</td><td>{real(4)}</td></tr></table>")
        if rng.random() < 0.5:
            for kind in rng.sample(("ad", "share", "side", "form", "note", "talk"), rng.randint(1, 2)):
                place = len(blocks) if kind in ("talk", "share") else rng.randint(1, len(blocks))
                blocks.insert(place, other(kind))
        body = rng.choice(_BODIES)
        inner = "".join(blocks) if body == "body" else wrap(body, "".join(blocks))
        if body.startswith("td"):
            inner = f"<table><tr>{inner}</tr></table>"
        before = [other(k) for k in ("note", "head", "nav", "ad", "form") if rng.random() < 0.5]
        after = [other(k) for k in ("share", "side", "talk", "ad", "form", "note", "foot") if rng.random() < 0.5]
        page = f"<html><head><title>{words(4)}</title></head><body>{''.join(before)}{inner}{''.join(after)}</body></html>"
        pages.append((page, frozenset(" ".join(t.split()) for t in content)))
    return tuple(pages)


def trained(count: int = 400) -> Model:
    return train([(page, set(content)) for page, content in labelled_pages(count)])


def accuracy(model: Model, pages: Iterator[tuple[str, frozenset[str]]]) -> tuple[int, int, int]:
    """Content runs found, missed, and other runs taken for content."""
    hit = miss = extra = 0
    for page, content in pages:
        found = content_blocks(page, model)
        hit += sum(f in content for f in found)
        extra += sum(f not in content for f in found)
        miss += len(content - set(found))
    return hit, miss, extra
