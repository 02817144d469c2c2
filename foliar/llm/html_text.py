"""Main text of HTML pages: flat text blocks classified by a decision tree.

A page is cut into blocks at block-level tags; inline tags do not cut. Each
block has its words and link density, those of the blocks before and after it,
and whether it stands in a container that is furniture by tag or by class, id
or role, in the article container, or in a heading. A decision tree decides.
It is grown from the labelled pages of ``labelled_pages``, whose main text is
marked, by the same features. Where a page names no container, words and links
of a block and of its neighbours decide.

Names count as furniture of two kinds: menus, adverts, comments and the like
always, others (search, notice, tags, form) not where an article stands inside.
What follows a heading such as "Comments" in the same container is furniture.

Scripts, styles, comments, titles and form controls give no blocks. Character
references are decoded, white space inside a block becomes one space, blocks
are joined in page order by an empty line. A missing or empty page has empty
text; scripts, styles and comments that are never closed run to the end of the
page, a ``<`` that starts no whole tag is text. Time grows with the length of a
page, however its markup is broken.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from foliar.llm._jobs import narrow

# Elements without text of the page; those of the first row run to the end of the page where they are never closed.
_RAW = frozenset("script style textarea iframe noscript".split())
_SKIPPED = _RAW | frozenset("title template svg select object button".split())
_SKIP_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in _SKIPPED}
_TAG = re.compile(r"</?[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_NAMED = frozenset(("class", "id", "role"))
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Furniture wherever it stands, also around an article and on it.
_STICKY_TAGS = frozenset("nav footer aside menu dialog".split())
_STICKY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|breadcrumbs?|comments?|commentlist|cookies?|discuss\w*|disqus|footer|menu|nav|navbar|navigation|newsletter|promo\w*|recommend\w*|related|repl(?:y|ies)|sidebar|sponsor\w*|teasers?|user[_-]?(?:comments?|notes?))(?=$|[\s_-])",
    re.I,
)
# Furniture, but not where an article stands inside.
_LOOSE = re.compile(
    r"(?:^|[\s_-])(?:banner|contentinfo|copyright|disclaimer|foot|head|header|legal|login|masthead|modal|notice|overlay|pager|pagination|popup|search|share|sharing|signup|social|subscribe|tags|toolbar|topbar|widget)(?=$|[\s_-])",
    re.I,
)
# A name such as has-sidebar or with-ads speaks of something inside.
_SPOKEN_OF = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no)[_-]\S*", re.I)
_MAIN_TAGS = frozenset("article main".split())
_MAIN = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|post|story|body)(?=$|[\s_-])", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_COMMENTS = re.compile(r"(?:\d+ )?(?:(?:reader |user |your )?comments?|responses?|replies|discussion|leave an? (?:comment|reply)|join the (?:discussion|conversation))(?: ?\(\d+\)| \d+)?\W*", re.I)
_ITEMS = frozenset("li dt dd tr td th option".split())
_SPACES = re.compile(r"\s+")
FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "main", "heading", "page_has_main"]


def _find(page: str, what: str, at: int, missing: set) -> int:
    """``str.find`` that never looks twice for what no longer comes."""
    if what in missing:
        return -1
    found = page.find(what, at)
    if found < 0:
        missing.add(what)
    return found


def _attributes(page: str, at: int, missing: set) -> tuple[str, bool, bool, int]:
    """Reads a start tag from behind its name: class, id and role, whether it has attributes, whether it closes itself, and where it ends.

    A quote counts only after an equals sign. A quoted value that runs past a
    ``>`` and whose second quote is not followed by a space, a slash or ``>`` was
    never closed: it ends where the tag does.
    """
    names, some = [], False
    while True:
        gap = _GAP.match(page, at)
        at = gap.end()
        if page.startswith(">", at) or at >= len(page):
            return " ".join(names), some, gap.group().endswith("/"), at + 1
        some = True
        name = _ATTRIBUTE.match(page, at)
        at, value = name.end(), ""
        if name[2]:
            quote = page[at : at + 1]
            if quote in ("'", '"'):
                close, end = _find(page, quote, at + 1, missing), _find(page, ">", at + 1, missing)
                if close < 0 or (0 <= end < close and not page[close + 1 : close + 2].isspace() and page[close + 1 : close + 2] not in ("/", ">", "")):
                    close = end if end >= 0 else len(page)
                    value, at = page[at + 1 : close], close
                else:
                    value, at = page[at + 1 : close], close + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare.group(), bare.end()
        if name[1].lower() in _NAMED:
            names.append(value)


def _tokens(page: str):
    """Pieces of a page in order, each character looked at a bounded number of times.

    ("text", text), ("open", tag, names, has attributes, closes itself) or ("close", tag).
    """
    at, missing = 0, set()
    ends: set[str] = set()  # skipped elements that no longer end
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:]
            return
        if start > at:
            yield "text", page[at:start]
        if page.startswith("<!--", start):
            end = _find(page, "-->", start + 2, missing)
            at = len(page) if end < 0 else end + 3
        elif page.startswith("<![CDATA[", start):
            end = _find(page, "]]>", start, missing)
            yield "text", html.escape(page[start + 9 : end if end >= 0 else len(page)], quote=False)
            at = len(page) if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), start):
            end = _find(page, ">", start, missing)
            at = len(page) if end < 0 else end + 1
        elif (m := _TAG.match(page, start)) and _find(page, ">", start, missing) >= 0:
            closing = page[start + 1] == "/"
            tag = m.group()[1 + closing :].lower()
            names, some, itself, at = _attributes(page, m.end(), missing)
            if closing:
                yield "close", tag
                continue
            if tag in _SKIPPED and not (tag == "svg" and itself):
                end = None if tag in ends else _SKIP_END[tag].search(page, at)
                if end:
                    at = end.end()
                    continue
                ends.add(tag)
                if tag in _RAW:
                    return
                continue
            yield "open", tag, names, some, itself
        else:
            yield "text", "<"
            at = start + 1


def text_blocks(page: str) -> list[tuple[str, list[float]]]:
    """Blocks of a page in order: their text and features."""
    found: list[list] = []  # text, link density, furniture, in a form only, main, heading
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple] = []  # open containers: tag, sticky, loose, form, main, counts to restore
    times: dict[str, int] = {}  # how often a tag is open
    sticky = loose = forms = main = 0
    in_link = heading = 0
    comments: tuple[int, int] | None = None  # depth and level of the heading above reader comments

    def end_block():
        if parts:
            text = _SPACES.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                links = len(_SPACES.sub(" ", html.unescape("".join(linked))).split())
                furniture = sticky > 0 or loose > 0 or comments is not None
                found.append([text, min(1.0, links / len(text.split())), furniture, forms > 0 and not furniture, main > 0, heading > 0])
            parts.clear()
            linked.clear()

    def pop() -> str:
        nonlocal sticky, loose, forms, main, comments
        tag, s, n, f, a, before = stack.pop()
        times[tag] -= 1
        sticky, main = sticky - s, main - a
        loose, forms = before if before else (loose - n, forms - f)
        if comments and len(stack) < comments[0]:
            comments = None
        return tag

    for kind, tag, *rest in _tokens(page):
        if kind == "text":
            parts.append(tag)
            if in_link:
                linked.append(tag)
            continue
        opened = kind == "open"
        if tag == "a":
            in_link = int(opened)
            continue
        if tag in _INLINE:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        before = len(found)
        end_block()
        # A paragraph ends where the next block starts, an item where the next item does.
        while opened and stack and (stack[-1][0] == "p" or (tag in _ITEMS and stack[-1][0] == tag)):
            pop()
        if tag in _HEADINGS:
            heading = int(opened)
            if opened and comments and int(tag[1]) <= comments[1]:
                comments = None
        if not opened:
            if times.get(tag):
                while pop() != tag:
                    pass
            if tag in _HEADINGS and len(found) > before and _COMMENTS.fullmatch(found[-1][0]):
                found[-1][2] = True
                comments = (len(stack), int(tag[1]))
            continue
        names, some, itself = rest
        if tag in _VOID or itself:
            continue
        if tag in ("p", "li", *_HEADINGS) and not some:
            continue  # no container, and often never closed
        names = _SPOKEN_OF.sub("", names)
        own = tag in _MAIN_TAGS
        is_main = own or bool(names and _MAIN.search(names))
        named = names and tag not in ("body", "html", "main")
        is_sticky = tag in _STICKY_TAGS or bool(named and _STICKY.search(names))
        # The header of an article is part of it; that of the page is not.
        is_loose = (tag == "header" and not main) or bool(named and not own and _LOOSE.search(names))
        saved = (loose, forms) if is_main and not is_sticky else None
        if saved:
            # What is named as search, notice and the like is no furniture around an article, nor is a form around the main container.
            loose, forms = 0 if own else loose, 0
        stack.append((tag, is_sticky, is_loose, tag == "form", is_main, saved))
        times[tag] = times.get(tag, 0) + 1
        sticky, loose, forms, main = sticky + is_sticky, loose + is_loose, forms + (tag == "form"), main + is_main
    end_block()

    # A form around all of the page is no furniture.
    in_forms = any(not furniture and not form for _, _, furniture, form, _, _ in found)
    found = [(text, links, furniture or (form and in_forms), a, h) for text, links, furniture, form, a, h in found]
    counts = [len(b[0].split()) for b in found]
    has_main = float(any(b[3] for b in found))
    out = []
    for i, (text, links, f, a, h) in enumerate(found):
        before = (counts[i - 1], found[i - 1][1]) if i else (0, 0.0)
        after = (counts[i + 1], found[i + 1][1]) if i + 1 < len(found) else (0, 0.0)
        out.append((text, [counts[i], links, *before, *after, float(f), float(a), float(h), has_main]))
    return out


# Labelled pages: blocks of main text carry a leading plus sign.
_LONG = "The harbour stayed closed for most of the winter because ice had formed earlier than anyone expected and the tugs could not break it alone. "
_MID = "Repairs to the northern pier will take two more weeks, the office said. "
LABELLED = [
    f"<nav><a href=1>Home</a> <a href=2>News</a></nav><div class='ad'>Buy two boats and pay for one today.</div><article><h1>+Harbour closed</h1><p>+{_LONG}<p>+{_MID}<p>+Nobody was hurt.</article><footer>&copy; Harbour News. All rights reserved.</footer>",
    f"<header><div>Harbour News</div><ul><li><a href=1>Sport</a><li><a href=2>Weather</a></ul></header><main><h2>+Ice</h2><p>+{_MID}</p><p>+{_LONG * 2}</p><ul><li>+Tugs</li><li>+Ice breakers</li></ul><aside>{_MID}</aside></main><div id='comments'><p>{_LONG}</p><p>Me too</p></div>",
    f"<div>Welcome</div><div><a href=1>Home</a> | <a href=2>About us</a> | <a href=3>Contact</a></div><div><p>+{_LONG}</p><p>+{_MID}{_LONG}</p><p>+{_LONG}</p></div><div><a href=4>More on this</a></div><div>Imprint</div>",
    f"<table><tr><td><a href=1>Archive</a></td><td><h1>+Winter at sea</h1>+{_LONG}<br>{_MID}<p>+{_MID * 3}</p></td></tr></table><p><a href=5>Read the next one</a></p><p>Terms of use</p>",
    f"<div class='sidebar'><p>{_LONG}</p></div><div class='content'><p>+Short.</p><p>+{_MID}</p><p>+See <a href=1>the tide table</a> for the hours.</p></div><div class='cookie notice'>{_MID}</div><form>Your name</form>",
    f"<div class='menu'><a href=1>A</a><a href=2>B</a></div><section><h1>+Notes</h1><p>+{_LONG * 3}</p><p>+{_MID * 2}</p><h3>+Sources</h3><p>+{_MID * 2}</p></section><div class='promo'>{_MID}</div><div>Site map</div>",
    f"<article><p>+One line.</p></article><div class='related'><p>{_LONG}</p></div><footer><p>{_LONG}</p></footer>",
    f"<article><p>+{_MID}</p><p>+{_LONG}</p></article>",
    f"<nav><a href=1>Home</a></nav><article><h1>+Tides</h1><p>+Low.</p><p>+High at noon.</p></article>",
    f"<div>Skip to text</div><article><p>+{_LONG}</p><ul><li>+<a href=1>Map of the pier</a></li><li>+<a href=2>Photographs</a></li></ul></article><div>Top of page</div><div><a href=3>Home</a></div>",
    f"<p>+{_LONG}</p><p>+{_LONG}</p>",
    f"<p>+{_MID}</p>",
    f"<h1>+Report</h1><p>+{_MID}</p><p>+{_LONG}</p><p>+{_MID}</p>",
    f"<div>Mail us</div><main><p>+Yes.</p></main><div>Printed {_MID}</div><div>{_LONG}</div>",
    f"<div><a href=1>Home</a> <a href=2>Search</a></div><article><h2>+Ice</h2><p>+{_MID}</p></article><p>Imprint</p><p>{_MID}</p>",
    f"<div><a href=1>{_MID}</a></div><div><a href=2>{_LONG}</a></div><p>+{_LONG}</p><p>+{_MID}</p><div><a href=3>{_MID}</a></div>",
    f"<header>{_MID}</header><p>+{_LONG}</p><h2>+Later</h2><p>+{_MID}</p><p>+{_LONG}</p><footer>{_LONG}</footer>",
    f"<article><header><h1>+Title here</h1><p>+{_MID}</p></header><p>+<a href=1>The whole report is linked here</a></p><div class='share'>Share this</div><p>+{_LONG}</p><section class='comments'><p>{_LONG}</p></section></article>",
]


# Lines that stand in both parts of a page without names; only what stands around them tells which.
_SHORT = ("Nobody was hurt.", "The harbour office", "Ice and wind", "Two weeks more", "Harbour News", "Since last winter")
_CHROME = ("Welcome to the harbour", "All rights reserved", "Terms of use", "Printed by the office", "Harbour News", "Since last winter", "Monday morning")
_WRAPPERS = ("<div>{}</div>", "<p>{}</p>", "<div><span>{}</span></div>", "<tr><td>{}</td></tr>", "<section><div>{}</div></section>", "<ul><li>{}</li></ul>")


def unnamed_pages(n: int = 48) -> list[str]:
    """Labelled pages whose markup names nothing, each of another make-up: wrapper, menu, lengths, and where short lines stand."""
    pages = []
    for i in range(n):
        wrap, other = _WRAPPERS[i % 6].format, _WRAPPERS[(i // 6) % 6].format
        menu = [other(f"<a href={j}>{_CHROME[(i + j) % 7]}</a>") for j in range(1 + i % 4)]
        plain = [other(_CHROME[(i + j) % 7]) for j in range(2 + i % 3)]
        teaser = [other(f"<a href=9>{_LONG if i % 2 else _MID}</a>")]
        body = []
        for j in range(2 + i % 5):
            body.append(wrap("+" + _LONG * (1 + (i + j) % 3)))
            if (i + j) % 2:
                body.append(wrap("+" + _SHORT[(i + 2 * j) % 6]))
            body.append(wrap("+" + (_MID if (i + j) % 3 else f"{_MID}<a href=7>The tide table</a> {_MID}")))
        title = [f"<h1>+{_SHORT[i % 6]}</h1>"] if i % 3 else []
        top = (plain + menu, menu + plain, menu + teaser + menu, plain)[i % 4]
        end = (menu + plain, plain + menu, plain, teaser + plain)[(i // 4) % 4]
        pages.append("".join(top + title + body + end))
    return pages


_NAMED_CHROME = ("<nav>{}</nav>", "<footer>{}</footer>", "<aside>{}</aside>", "<div class='ad'>{}</div>", "<div id='comments'>{}</div>", "<div class='related'>{}</div>", "<form>{}</form>", "<div class='cookie notice'>{}</div>")
_NAMED_MAIN = ("<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "<div id='main'><section>{}</section></div>")


def named_pages(n: int = 48) -> list[str]:
    """Labelled pages with named containers: text, short lines and links of all kinds stand in the article as well as around it."""
    pages = []
    for i in range(n):
        wrap = _WRAPPERS[i % 6].format
        lines = [_SHORT[(i + j) % 6] for j in range(4)] + [f"<a href={j}>{_SHORT[(i + j) % 6]}</a>" for j in range(2 + i % 3)]
        lines += [_MID, _LONG, _LONG * 2, f"<a href=8>{_LONG if i % 2 else _MID}</a>"]
        around = ["".join(wrap(x) for x in lines[j :: 2 + i % 3]) for j in range(2 + i % 3)]
        chrome = [_NAMED_CHROME[(i + j) % 8].format(x) for j, x in enumerate(around)]
        if i % 5 == 4:
            # Only what is around the text has a name.
            body = "".join(wrap("+" + x) for x in (_LONG, _MID * 2, _LONG, _LONG * 2, _MID * 2))
        else:
            chosen = lines[i % 3 :: 1 + i % 2] if i % 7 else lines[:4]
            body = _NAMED_MAIN[i % 4].format("".join(wrap("+" + x) if "<a" not in x else wrap(x.replace(">", ">+", 1)) for x in chosen))
            # Lines without a name beside an article do not belong to it.
            chrome.append("".join(wrap(x) for x in (_CHROME[i % 7], _MID, _LONG)))
        pages.append(chrome[0] + body + "".join(chrome[1:]))
    return pages


def labelled_pages() -> list[str]:
    return LABELLED + named_pages() + unnamed_pages()


def _gini(y: np.ndarray) -> float:
    p = y.mean() if len(y) else 0.0
    return p * (1 - p) * len(y)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 9):
    """A decision tree by Gini impurity: (feature, cut, low side, high side), or True or False at a leaf."""
    if depth == 0 or y.all() or not y.any():
        return bool(y.mean() >= 0.5)
    best = (1e-9, None, None)
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, j] <= cut
            gain = _gini(y) - _gini(y[low]) - _gini(y[~low])
            if gain > best[0] + 1e-12:
                best = (gain, j, cut)
    if best[1] is None:
        return bool(y.mean() >= 0.5)
    low = x[:, best[1]] <= best[2]
    return best[1], float(best[2]), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def labelled_table(pages: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of marked pages; main blocks carry a leading plus sign."""
    rows = [(f, text.startswith("+")) for page in (labelled_pages() if pages is None else pages) for text, f in text_blocks(page)]
    return np.array([f for f, _ in rows]), np.array([y for _, y in rows])


def is_main(tree, features: list[float]) -> bool:
    while not isinstance(tree, bool):
        j, cut, low, high = tree
        tree = low if features[j] <= cut else high
    return tree


def main_text(page: str | None, tree) -> str:
    return "\n\n".join(text for text, f in text_blocks(page or "") if is_main(tree, f))


def _extract(tree):
    def run(batches):
        for batch in batches:
            texts = [main_text(p, tree) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", tree=None) -> DataFrame:
    """One row per page: (page_id, url, text, n_chars)."""
    tree = grow(*labelled_table()) if tree is None else tree
    rows = narrow(pages, id=id_col, url=url_col, html=html_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_extract(tree), f"page_id {kind}, url {rows.schema['url'].dataType.simpleString()}, text string, n_chars long")
