"""One pass over a page's markup: its blocks of text, their elements, and a hash of every subtree.

Not a validating parser: tags open and close elements the way browsers recover from common faults
(unclosed paragraphs, list items and cells, end tags without a start, a page that breaks off).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import xxhash

# fixed values: element names and words of the HTML standard and of common page layouts
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|iframe|template|svg|xmp|noembed|noframes"
MATH = frozenset("math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle "
                 "msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation annotation-xml none".split())
FOREIGN = MATH | {"svg", "path"}  # elements that "/>" ends
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                          "object span strike strong sub sup time tt u var wbr br".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr figcaption caption".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
                     "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd".split())
CLOSES_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
BARRIER = frozenset("html body table ul ol dl article section aside nav div form main header footer td th".split())
CHROME_TAGS = frozenset("nav footer aside form dialog menu button select head fieldset audio video canvas".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
CHROME_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
                         "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup sidebar sidenav menu "
                         "menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments disqus reply replies "
                         "respond share sharing social related recommended recommendations widget widgets toolbar pagination pager "
                         "copyright hidden".split())
HEADER_WORDS = frozenset("header headers".split())
LAYOUT_WORDS = frozenset("site page main top bottom left right upper lower box slot container wrapper wrap inner outer list item items area "
                         "section block bar panel primary secondary global header head body link links post posts article articles button "
                         "btn icon icons form text content col column row unit zone 1 2 3 4 5".split())
NEVER_CHROME = frozenset("html body article main".split())
CONTENT_WORDS = frozenset("article post entry content story main".split())

_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)"
    r"|<(?!svg[\s/](?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>)"  # an svg that ends itself is a tag like others
    rf"({RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(?s:.*?)(?:</\1\s*+>|\Z)"
    r"|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"  # a tag with an odd quote
    r"|[^<]++|<", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][^\s=/>]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[^\s]+")
_PART = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Element:
    tag: str
    up: int
    chrome: bool = False  # markup says that it is no part of an article
    named: bool = False  # only its class or id says so
    words: frozenset = frozenset()
    in_article: bool = False  # itself or an element above is article or main
    block: int = 0  # itself, or for inline elements the nearest element above that is not
    parts: list = field(default_factory=list)
    digest: int = 0


@dataclass
class Page:
    elements: list[Element]  # an element comes after those above it
    blocks: list[tuple[int, str]]  # (innermost element, text)


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _names_chrome(name: str, also: frozenset) -> bool:
    """A class or id that names chrome and besides only places or kinds of a layout: ``ad-slot`` but not ``ad-free``."""
    parts = _PART.findall(name)
    return any(p in CHROME_WORDS or p in also for p in parts) and all(p in CHROME_WORDS or p in LAYOUT_WORDS or p in also for p in parts)


def _chrome(tag: str, attributes: dict[str, str], in_article: bool) -> tuple[bool, bool]:
    """(chrome by tag, role or style; chrome by a name alone).  Names say nothing of paragraphs inside an article."""
    if tag in INLINE or (tag in NEVER_CHROME and not (tag == "article" and in_article)):
        return False, False
    if tag in CHROME_TAGS or attributes.get("role", "").lower() in CHROME_ROLES or (tag == "header" and not in_article):
        return True, False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return True, False
    if in_article and tag in PROSE:
        return False, False
    names = _NAME.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower())
    return False, any(_names_chrome(name, frozenset() if in_article else HEADER_WORDS) for name in names)


def parse(source: str) -> Page:
    elements = [Element("", -1)]
    stack = [0]
    is_open: Counter[str] = Counter()  # of the tags on the stack
    blocks: list[tuple[int, str]] = []
    pending: list[str] = []

    def flush() -> None:
        if pending:
            text = " ".join(html.unescape("".join(pending)).split())
            pending.clear()
            if text:
                at = elements[stack[-1]].block
                blocks.append((at, text))
                elements[at].parts.append(text)

    def close(depth: int) -> None:
        """End all elements of the stack from ``depth`` on."""
        if any(elements[i].tag not in INLINE for i in stack[depth:]):
            flush()
        while len(stack) > depth:
            e = elements[stack.pop()]
            is_open[e.tag] -= 1
            e.digest = xxhash.xxh64_intdigest("\0".join([e.tag, *e.parts])) - (1 << 63)
            e.parts = []
            if e.tag not in INLINE:
                elements[stack[-1]].parts.append(str(e.digest))

    for m in _TOKEN.finditer(source):
        token = m[0]
        if token[0] != "<" or token == "<":
            pending.append(token)
            continue
        end, tag, rest = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not tag:
            if m[1]:
                flush()
            continue
        tag = tag.lower()
        if end:
            if not is_open[tag]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[depth]].tag
                if open_tag == tag:
                    close(depth)
                    break
                if tag in INLINE and open_tag not in INLINE:
                    break
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                pending.append(" ")
            if tag == "hr":
                flush()
            continue
        like = CLOSES_LIKE.get(tag, ())
        if is_open["select"] and tag in CLOSES_P:  # a form's list holds no blocks: it was not closed
            depth, lists = len(stack), is_open["select"]
            while lists:
                depth -= 1
                lists -= elements[stack[depth]].tag == "select"
            close(depth)
        if (is_open["p"] and tag in CLOSES_P) or any(is_open[t] for t in like):
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[depth]].tag
                if open_tag in like or (open_tag == "p" and tag in CLOSES_P):
                    close(depth)
                    if not like:
                        break
                elif open_tag in BARRIER:
                    break
        if tag not in INLINE:
            flush()
        attributes = _attributes(rest) if rest else {}
        up = elements[stack[-1]]
        chrome, named = _chrome(tag, attributes, up.in_article)
        words = frozenset(_PART.findall(attributes.get("class", "").lower() + " " + attributes.get("id", "").lower())) if attributes else frozenset()
        elements.append(Element(tag, stack[-1], chrome or named, named, words & CONTENT_WORDS, up.in_article or tag in ("article", "main"),
                                up.block if tag in INLINE else len(elements)))
        if not rest or not rest.endswith("/") or tag not in FOREIGN:
            stack.append(len(elements) - 1)
            is_open[tag] += 1
    flush()
    close(1)
    flush()
    return Page(elements, blocks)


# what the last step needs to know of an element, as bits
CHROME, NAMED, FORM, ARTICLE, MAIN, CONTENT = (1 << i for i in range(6))


def flags_of(e: Element) -> int:
    content = bool(e.words) and e.tag in ("div", "section", "td")
    return (CHROME * e.chrome | NAMED * e.named | FORM * (e.tag in ("form", "fieldset")) | ARTICLE * (e.tag == "article")
            | MAIN * (e.tag == "main") | CONTENT * content)


def kept_blocks(ups: list[int], flags: list[int], removed: list[bool], at: list[int], sizes: list[int]) -> list[bool]:
    """Which blocks (their elements and text sizes) are main text once the elements ``removed`` are gone.

    Markup is a prior on what is left: chrome goes, and the text is that of ``article``, else of ``main``, else
    of an element named as content that holds half of the page, else the page.  A name alone does not make chrome of
    what holds most of a page that declares no article.
    """
    n = len(ups)
    total = [0] * n  # text below, without what was removed
    gone = [False] * n
    for i in range(n):
        gone[i] = removed[i] or (i > 0 and gone[ups[i]])
    for i, size in zip(at, sizes):
        if not gone[i]:
            total[i] += size
    for i in range(n - 1, 0, -1):
        total[ups[i]] += total[i]
    declared = any(f & (ARTICLE | MAIN) and total[i] for i, f in enumerate(flags))
    chrome = [bool(f & CHROME) and (declared or not f & NAMED or 2 * total[i] <= total[0]) for i, f in enumerate(flags)]
    barred = [False] * n  # below chrome other than a form that wraps the page
    dead = [False] * n
    for i in range(1, n):
        barred[i] = barred[ups[i]] or (chrome[i] and not flags[i] & FORM)
        dead[i] = dead[ups[i]] or chrome[i] or gone[i]
    free = [i for i in range(n) if total[i] and not chrome[i] and not gone[i] and not (i and barred[ups[i]])]
    region = None
    for kind in (ARTICLE, MAIN):
        found = {i for i in free if flags[i] & kind}
        if found:
            region = found
            break
    if region is None:
        named = [i for i in free if flags[i] & CONTENT]
        best = max(named, key=lambda i: (total[i], -i), default=None)
        region = {best} if best is not None and 2 * total[best] >= total[0] else {0}
    inside = [False] * n
    for i in range(n):
        up = i > 0 and inside[ups[i]]
        inside[i] = i in region or up
        if i in region and not up:
            dead[i] = gone[i]  # a form around the article does not make chrome of it
        elif i:
            dead[i] = dead[ups[i]] or chrome[i] or gone[i]
    return [inside[i] and not dead[i] for i in at]
