"""Main text of web pages: flat text blocks, judged by a small decision tree.

A page is cut at its block-level tags into flat text blocks, in one pass over its tags. Each
block is described by its number of words and its link density, those of the blocks before and
after it, by what the containers around it say, and by whether the page marks an article at all.
Containers say one of three things by tag, class, id or role: surely beside the article (comments,
notices, adverts, hidden parts), of a part of the layout (header, menu, sidebar, form), or article.
Names of layout parts also stand on wrappers around a whole page, so the innermost one comes with
its share of the page's words. A decision tree (CART, Gini impurity) learned from the labelled pages below keeps or
drops the block. The tree is fitted on the driver from that fixed table and sent with the task.

Tags are read as browsers read them: a quote counts only where a value starts, and one that never
closes is a plain character; end tags may be left out. Work grows in proportion to the page.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import cache, lru_cache
from html import unescape
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from propensity.llm.texts import map_batches, strings

# Tags that stay inside a block; every other tag ends it.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr""".split())
# Elements whose content is not text of the page.
HIDDEN = frozenset("script style noscript template svg math title iframe object canvas select textarea".split())
RAW = frozenset("script style title textarea noscript iframe".split())  # no tags inside
LEFT = frozenset("svg math select".split())  # a block-level tag inside ends them
# Containers whose start and end are matched up.
CONTAINERS = HIDDEN - RAW | frozenset("""address article aside body button center details dialog div fieldset figure footer
foreignobject form header html li main menu nav ol p section table td th tr ul""".split())
BLOCK = CONTAINERS - {"foreignobject"} | frozenset("blockquote dd dl dt h1 h2 h3 h4 h5 h6 hr pre".split())
WALLS = frozenset("table td th".split())  # no end tag from inside reaches out of them
BESIDE = frozenset("nav footer aside button menu dialog".split())
LAYOUT = frozenset("form fieldset header".split())
WITHIN = frozenset("article main".split())
# Words of class, id and role.
SAYS_BESIDE = frozenset("""ad ads advert advertisement adverts alert breadcrumb breadcrumbs comment comments consent cookie
cookies copyright disclaimer disqus gdpr newsletter notice notification pager pagination paywall popup promo promoted recommended
related replies reply respond sponsor sponsored subscribe teaser""".split())
SAYS_LAYOUT = frozenset("""banner footer form header login masthead menu modal nav navbar navigation search share sharing sidebar
signup skip social toolbar topbar widget""".split())
SAYS_WITHIN = frozenset("article articlebody content entry main post story".split())
HAS = frozenset("has no with without".split())  # the next word names a part, not the element

_TOKEN = re.compile(r"""
    <!--(?:-?>|.*?(?:--!?>|\Z))                 # comment
    | <(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)      # declaration, nameless end tag
    | </?([a-zA-Z][a-zA-Z0-9:-]*+)
      ((?>[^>"'=]+ | =\s*(?>"[^"]*" | '[^']*' | [^\s"'>][^\s>]*) | [="'])*+)(?:>|\Z)""", re.DOTALL | re.VERBOSE)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role|hidden)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FEATURES = ("beside", "layout", "inner", "share", "within", "marked", "words", "links", "words_before", "links_before", "words_after", "links_after")


class Block(NamedTuple):
    """A flat block; ``box`` numbers the innermost part of the layout around it, 0 where there is none; ``inner``: within the article."""

    text: str
    words: int
    linked: int
    beside: bool
    within: bool
    box: int
    inner: bool


class _Open(NamedTuple):
    """An open container; places in the stack of the cell, row, item and wall it stands in or is, -1 without."""

    name: str
    beside: bool
    within: bool
    hidden: bool
    box: int
    inner: bool
    cell: int
    row: int
    item: int
    wall: int


_PAGE = _Open("", False, False, False, 0, False, -1, -1, -1, -1)


@lru_cache(10_000)
def _says(attributes: str) -> tuple[bool, bool, bool]:
    """Whether class, id or role speak of something beside the article, of a part of the layout, of the article."""
    named = _NAMED.findall(attributes)
    words = set()
    for _, value in named:
        said = [w.lower() for w in _WORDS.findall(value)]
        words.update(w for before, w in zip(["", *said], said) if before not in HAS)
    hidden = any(name.lower() == "hidden" for name, _ in named)
    return hidden or bool(words & SAYS_BESIDE), bool(words & SAYS_LAYOUT), bool(words & SAYS_WITHIN)


def blocks(html: str) -> tuple[list[Block], list[int]]:
    """The flat blocks in page order, and for each box the box around it (box 0 is the page)."""
    out: list[Block] = []
    outer = [0]
    parts: list[str] = []
    linked: list[str] = []
    stack: list[_Open] = []
    places: dict[str, list[int]] = defaultdict(list)  # of the open containers of a name
    endless: set[str] = set()  # names without a further end tag
    top, link = _PAGE, False

    def close() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, text.count(" ") + 1, len(" ".join(linked).split()), top.beside, top.within, top.box, top.inner))
        parts.clear()
        linked.clear()

    def pop(k: int) -> None:
        nonlocal top
        for o in reversed(stack[k:]):
            places[o.name].pop()
        del stack[k:]
        top = stack[-1] if stack else _PAGE

    def push(name: str, attributes: str) -> None:
        nonlocal top
        beside, layout, within = (False, False, False) if name in ("html", "body") else _says(attributes)
        if name in WITHIN:
            layout, within = False, True
        elif name in LAYOUT:
            layout = True
        if layout and top.within and (name == "header" or "header" in attributes.lower()) and not top.box:
            layout = False                   # within the article it holds the headline
        if layout:
            outer.append(top.box)
        k = len(stack)
        top = _Open(name, top.beside or beside or name in BESIDE, top.within or within, top.hidden or name in HIDDEN,
                    len(outer) - 1 if layout else top.box, top.within if layout else top.inner,
                    k if name in ("td", "th") else -1 if name == "table" else top.cell,
                    k if name == "tr" else -1 if name == "table" else top.row,
                    k if name == "li" else -1 if name in ("ul", "ol", "menu") else top.item,
                    k if name in WALLS else top.wall)
        places[name].append(k)
        stack.append(top)

    at, size = 0, len(html)
    find = _TOKEN.search
    while at < size:
        m = find(html, at)
        if not top.hidden:
            raw = html[at:m.start()] if m else html[at:]
            if raw:
                raw = unescape(raw) if "&" in raw else raw
                parts.append(raw)
                if link:
                    linked.append(raw)
        if not m:
            break
        at = m.end()
        if m[1] is None:                     # comment, declaration
            continue
        name, ends, empty = m[1].lower(), html[m.start() + 1] == "/", m[2].endswith("/")
        if name in RAW:
            if not ends:                     # nothing inside is a tag but its own end
                stop = None if name in endless else re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
                if stop:
                    at = stop.start()
                else:                        # code takes the rest of the page, other text ends at the next tag
                    endless.add(name)
                    if not empty:
                        at = size if name in ("script", "style") else html.find("<", at) % (size + 1)
                close()
            continue
        if name in INLINE:
            if name == "a":
                link = not ends
            elif name == "br" and not top.hidden:
                parts.append(" ")
            continue
        close()
        link = False
        if ends:
            if name in CONTAINERS and places[name]:
                k = top.cell if name in ("td", "th") else top.row if name == "tr" else places[name][-1]
                if k >= 0 and stack[k].name == name and (k >= top.wall or name in ("table", "tr", "td", "th")):
                    pop(k)
            continue
        if top.name in LEFT and name not in HIDDEN and name in BLOCK or top.name == "p":
            pop(len(stack) - 1)
        if name in ("td", "th", "tr"):       # end tags that may be left out
            k = top.row if name == "tr" else top.cell
            if k >= 0:
                pop(k)
        elif name == "li" and top.item >= 0 and top.item > top.wall:
            pop(top.item)
        if name in CONTAINERS and not empty:
            push(name, m[2])
    close()
    return out, outer


def features(found: list[Block], outer: list[int]) -> np.ndarray:
    """One row of FEATURES for each block; nothing before the first or after the last counts as 0 words, all links.

    ``share`` is that of the block's box in the unlinked words of blocks that are not surely beside the article.
    """
    words = np.array([0, *(b.words for b in found), 0], float)
    links = np.array([1, *(min(1.0, b.linked / b.words) for b in found), 1], float)
    held = [0] * len(outer)
    for b in found:
        held[b.box] += 0 if b.beside else max(0, b.words - b.linked)
    for k in range(len(outer) - 1, 0, -1):   # a box comes after the one around it
        held[outer[k]] += held[k]
    flags = np.array([(b.beside, b.box > 0, b.inner, held[b.box] / max(1, held[0]), b.within) for b in found], float).reshape(-1, 5)
    marked = np.full(len(found), float(any(b.within and not b.beside for b in found)))
    return np.column_stack((flags, marked, words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:]))


_LINE = "the river was low that summer and the boats lay on the sand for weeks before any rain came. "
_SIZES = {"T": "Rain.", "S": "It rained.", "M": _LINE, "L": _LINE * 4}
_LINKS = "".join(f"<li><a href=/{i}>topic {i}</a></li>" for i in range(5))
# Layouts around an article, which stands for {}; what else they hold is to be dropped.
_MARKED = (
    "<nav><ul>LINKS</ul></nav><div class=ad>M</div><article>{}</article><footer>M</footer>",
    "<header><p>S</header><div class=top-menu>LINKS</div><main>{}</main><aside><p>M<p>L<p>S</aside>",
    "<div id=cookie-notice>M</div><div id=content>{}</div><div class=comments><p>L<p>M<p>S</div>",
    "<form><p>M<p>S</form><div class=post>{}<div class=share>LINKS</div></div><div class=footer><p>L</div>",
    "<div class=banner><p>L<p>L</div><article><ul>LINKS</ul>{}<p><a href=/more>S</a><section class=related>S</section></article>",
    "<div>M<p>L<p>T</div><article>{}</article><div>S<p>M<p>L<p>T</div>",
    "<div class=page-header><nav>LINKS</nav><article>{}</article><div class=sidebar><p>S<p>M</div></div>",
    "<div class=page-banner><article>{}</article></div><p>S<p>T",
    "<nav>LINKS</nav><article>{}</article>",
    "<main>{}<div class=widget><p>M</div></main>",
    "<article>{}</article><div class=sidebar><article><p>S</article></div>",
    "<main><div class=with-sidebar-nav><article>{}</article><aside>M</aside></div></main>",
    "<article>{}</article>",
    "<form id=f><div class=menu>LINKS<p>S</div><div id=main>{}<div class=widget><p>M</div></div><p>S</form>",
)
_BARE = (
    "<div class=notice><p>L<p>M</div><nav><p>L</nav>{}<div class=sidebar><p>L<p>L<p>M</div><aside><p>L</aside>",
    "<ul>LINKS</ul>{}<ul>LINKS</ul><p>S",
    "<ul>LINKS</ul><p>S<ul>LINKS</ul>{}",
    "{}",
    "<table><tr><td><a href=/>home</a><td><a href=/b>news</a></table><p>S<ul>LINKS</ul>{}<hr><p><a href=/x>M</a>",
    "<form id=f><div class=header><p>M</div><ul>LINKS</ul>{}<div class=footer><p>M<p>S</div></form>",
    "<p><a href=/x>M</a><div class=page-header>{}</div><div class=toolbar><p>M<p>S</div>",
    "<div class=page-sidebar><ul>LINKS</ul>{}<div class=sidebar><p>M<p>L</div></div>",
    "<table><tr><td class=menu>LINKS<p>M<td>{}<td class=sidebar><p>L</table>",
)


def labelled(marked: tuple[str, ...] = _MARKED, bare: tuple[str, ...] = _BARE) -> list[str]:
    """The labelled table: every layout with every order of short and long paragraphs; k marks the article."""
    out = []
    for layouts, orders in ((marked, product("TSML", repeat=4)), (bare, ["SLLL", "SLML", "MLLM", "SMLL", "TLSL", "SLTL", "SLLS"])):
        for layout, (head, *order) in product(layouts, orders):
            paragraphs = "".join(f"<p k>{size}" for size in order)
            page = layout.format(f"<h1 k>{head}</h1>{paragraphs}").replace("LINKS", _LINKS)
            out.append(re.sub(r"(?<=>)[TSML](?=<|$)", lambda m: _SIZES[m[0]], page))
    return out


def _labelled_blocks(*layouts: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    mark = "\u00a4 "
    x, y = [], []
    for page in labelled(*layouts):
        found, outer = blocks(re.sub(r"<(\w+) k>", rf"<\1>{mark}", page))
        y.extend(float(b.text.startswith(mark)) for b in found)
        x.append(features([b._replace(words=b.words - b.text.startswith(mark)) for b in found], outer))
    return np.vstack(x), np.array(y)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10, least: int = 5) -> tuple:
    """A tree: (feature, limit, tree for up to the limit, tree above it), or a leaf's share of 1."""
    share = float(y.mean())
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return (share,)
    best = (share * (1 - share) * len(y) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= limit
            n, m = low.sum(), (~low).sum()
            if min(n, m) < least:
                continue
            p, q = y[low].mean(), y[~low].mean()
            loss = n * p * (1 - p) + m * q * (1 - q)
            if loss < best[0]:
                best = (loss, f, float(limit))
    if best[1] < 0:
        return (share,)
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


@cache
def fitted() -> tuple:
    return grow(*_labelled_blocks())


def kept(tree: tuple, row) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0] >= 0.5


def main_text(html: str, tree: tuple) -> str:
    found, outer = blocks(html)
    if not found:
        return ""
    return "\n".join(b.text for b, row in zip(found, features(found, outer).tolist()) if kept(tree, row))


def extract(pages: DataFrame, id_col: str = "page_id", html: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per row: id, the carried columns, text and n_chars (code points).

    Kept blocks stand in page order, joined by one line end; white space inside a block is one
    space. Null and empty pages and pages of which nothing is kept give the empty text. Broken
    markup never fails and never enters the text: a tag that is not closed ends with its parent or
    the page. Very long pages are read whole, in time proportional to their length. Repeated rows
    repeat; columns that are not named are not read.
    """
    tree = fitted()

    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(x, tree) for x in strings(batch, "_html")]
            out = {c: batch.column(c) for c in (id_col, *carry)}
            out["text"] = pa.array(texts, pa.string())
            out["n_chars"] = pa.array([len(x) for x in texts], pa.int64())
            return pa.RecordBatch.from_pydict(out)
        return each

    kinds = dict(pages.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (id_col, *carry)) + ", text string, n_chars long"
    return map_batches(pages.select(id_col, *carry, pages[html].alias("_html")), work, schema)
