"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags.  The first pass looks at each block
alone: its length, the share of its characters inside links and the share of its
words that are stop words make it good, bad or ambiguous (``short``: too short to
tell; ``near``: of middling stop-word share).  In the second pass ambiguous blocks
inherit: a short one takes the label of the nearest decided neighbour, a heading that
of what follows it, and a middling one is good unless both neighbours are bad.

What the page says about itself comes first.  Blocks in scripts, styles, the head,
menus, headers, footers, asides, forms, hidden elements and in elements whose class or
id names an advert, a notice, a sidebar, a menu or reader comments are bad.  Where
the page marks its article (``article``, ``main`` or a content class), only blocks
inside can be good, and the article's edge counts as a good neighbour: a long block
needs no stop words there and a short article is not lost.

Defined results: a null or empty page, and one without a good block, has the empty
text; broken markup is read as far as it goes (a comment, script or quoted value that
never ends takes the rest); the time is linear in the page's length; repeated rows
stay; an empty table gives an empty result; further columns are left out."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from firmo.llm.common import blocks, column, pick

# -- fixed values: elements of the HTML vocabulary by their role -----------------
BLOCK = frozenset("""address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option
p pre section summary table tbody td tfoot th thead title tr ul""".split())
#: the content is no markup, up to the end tag
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
DROPPED = frozenset("""head nav footer aside form script style textarea title xmp iframe noembed noframes noscript template svg
object audio video canvas select button datalist dialog menu fieldset map applet""".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl li dd dt menu dir".split())
#: words of a class, id or role that name what is not the article
NOT_TEXT = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
complementary consent contentinfo cookie cookies dialog disclaimer discussion disqus footer form login masthead menu modal nav
navbar navigation newsletter notice notices pagination pager paywall popup popover promo promoted promotion recommended related
replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud teaser
toolbar topbar widget widgets""".split())
#: words that name the article, alone as an id or role, or one of each set in a class
ARTICLE = frozenset("article articlebody main".split())
OF_ARTICLE = (frozenset("article blog entry main post story news".split()), frozenset("body content text copy".split()))
#: frequent words of the languages at hand
STOP = frozenset("""
a about after all also an and are as at be been but by can could do for from had has have he her his how i if in into is it
its more my no not of on one or our out she so some than that the their them then there these they this to up was we were
what when which who will with would you your
au aux avec ce ces cette comme dans de des du elle en est et être il ils je la le les leur lui mais ne nous on ou où par pas
plus pour qu que qui sa se ses son sont sur un une vous
aber als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat haben ich ihr im
in ist kann mit nach nicht noch nur oder sich sie sind so über um und uns unter vom von vor war was wenn werden wie wird zu
zum zur
al como con del donde el ella ellos entre era esta este esto fue ha hay la las lo los más muy ni o otro para pero por porque
que sin sobre su sus también todo un una y ya
""".split())

LOW_LENGTH, HIGH_LENGTH = 70, 200
LOW_STOP, HIGH_STOP = 0.15, 0.25
LINK_SHARE = 0.33
HEADING_REACH = 200

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++))")
_HIDDEN = re.compile(r"(?:^|[\s/\"'])hidden(?=[\s/=]|$)", re.I)
_TOKEN = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")
_END_RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}

GOOD, BAD, SHORT, NEAR = "good", "bad", "short", "near"


class Block:
    """One block: its text, characters inside links, what it stands in."""

    __slots__ = ("text", "linked", "links", "bad", "article", "heading", "listed", "label", "at")

    def __init__(self, text: str, linked: int, links: int, bad: bool, article: int, heading: bool, listed: bool) -> None:
        self.text, self.linked, self.links, self.bad = text, linked, links, bad
        self.article, self.heading, self.listed, self.label, self.at = article, heading, listed, "", 0


def _names(attributes: str) -> tuple[bool, bool]:
    """Whether an element's attributes say that it is no text, or that it is the article."""
    if not attributes or attributes.isspace():
        return False, False
    not_text = _HIDDEN.search(attributes) is not None and "hidden" not in "".join(x for m in _ATTRIBUTE.finditer(attributes) for x in m.groups()[1:] if x)
    article = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            for one in value.split():
                words = {w.lower() for w in _TOKEN.findall(one)}
                not_text = not_text or not NOT_TEXT.isdisjoint(words)
                article = article or (name != "class" and one.lower() in ARTICLE) or all(not s.isdisjoint(words) for s in OF_ARTICLE)
        elif name == "itemprop":
            article = article or value.lower() == "articlebody"
        elif name == "style":
            flat = re.sub(r"\s", "", value.lower())
            not_text = not_text or "display:none" in flat or "visibility:hidden" in flat
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            not_text = not_text or value.lower() != "false"
    return not_text, article and not not_text


def page_blocks(page: str) -> list[Block]:
    """The blocks of a page in order."""
    out: list[Block] = []
    # open elements that hold blocks: name, dropped, article (number, 0: none), list, link open before
    stack: list[tuple[str, bool, int, bool]] = []
    counts: dict[str, int] = {}
    parts: list[str] = []
    linked = links = articles = 0
    in_link = own_bad = heading = False
    bad, article, listed = False, 0, False

    def flush() -> None:
        nonlocal linked, links, own_bad, heading
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, links, bad or own_bad, article, heading, listed))
            parts.clear()
        linked = links = 0
        own_bad = heading = False

    def say(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw)
        parts.append(text)
        if in_link:
            linked += len("".join(text.split()))

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        if lt > at:
            say(page[at:lt])
        m = _TAG.match(page, lt)
        if m is None:
            if page.startswith("<!--", lt):
                # "<!-->" and "<!--->" are whole comments
                end = page.find("-->", lt + 2)
                at = n if end < 0 else end + 3
            elif page.startswith(("<!", "<?", "</"), lt):
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            elif lt + 1 < n and page[lt + 1].isascii() and page[lt + 1].isalpha():
                at = n          # a tag that never ends
            else:
                say("<")
                at = lt + 1
            continue
        at = m.end()
        name, closing = m[2].lower(), bool(m[1])
        if name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = not closing
            links += not closing
        elif closing:
            if name in BLOCK or name in DROPPED:
                flush()
                in_link = in_link and name not in BLOCK
                if counts.get(name):
                    # elements that were left open end with the one around them
                    while stack:
                        top = stack.pop()
                        counts[top[0]] -= 1
                        if top[0] == name:
                            break
                    _, bad, article, listed = stack[-1] if stack else ("", False, 0, False)
        elif name in VOID:
            if name in BLOCK:
                flush()
        elif name in BLOCK or name in DROPPED:
            flush()
            not_text, marked = _names(m[3]) if name not in ("html", "body") else (False, False)
            if name in ("p", *HEADING):
                own_bad, heading = not_text, name in HEADING
                in_link = False
            else:
                marked = marked or name in ("article", "main")
                drop = name in DROPPED or not_text or (name == "header" and not article)
                # a form around the whole page does not hide its article
                inside_form = bad and not drop and marked and all(s[0] == "form" or not s[1] for s in stack)
                if marked and not drop and (not bad or inside_form):
                    articles += name != "main" or not article
                    article, bad = articles, False
                bad = bad or drop
                listed = listed or name in LISTS
                stack.append((name, bad, article, listed))
                counts[name] = counts.get(name, 0) + 1
            if name in RAW:
                end = _END_RAW[name].search(page, at)
                at = n if end is None else end.start()
        elif name == "plaintext":
            say(page[at:])
            break
    flush()
    return out


def first_pass(block: Block, marked: bool) -> str:
    """The label of a block by itself; ``marked``: the page marks its article."""
    size = len(block.text)
    share = block.linked / max(1, sum(1 for c in block.text if not c.isspace()))
    if block.bad or (marked and not block.article):
        return BAD
    if share > LINK_SHARE and (not marked or block.links > 1 or (block.listed and share > 0.9)):
        return BAD
    if size < LOW_LENGTH:
        return SHORT
    if marked:
        return GOOD if size >= HIGH_LENGTH else NEAR
    if "©" in block.text and size < HIGH_LENGTH:
        return BAD
    words = _WORD.findall(block.text.lower())
    stops = sum(w in STOP for w in words) / max(1, len(words))
    if stops >= HIGH_STOP:
        return GOOD if size >= HIGH_LENGTH else NEAR
    return NEAR if stops >= LOW_STOP else BAD


def classify(found: list[Block]) -> list[Block]:
    """Both passes; the label of each block is GOOD or BAD."""
    marked = any(b.article and not b.bad for b in found)
    at = 0
    for b in found:
        b.label, b.at = first_pass(b, marked), at
        at += len(b.text)
    first = [b.label for b in found]
    n = len(found)
    # the nearest decided blocks before and after, and how far they are; a block of
    # middling share is decided enough for a short one.  Bad blocks outside an article
    # do not count for blocks inside: the edge does
    before: list[tuple[str, int]] = [("", 0)] * n
    after: list[tuple[str, int]] = [("", 0)] * n
    for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
        last, where, part = "", 0, -1
        for i in order:
            b = found[i]
            here = b.article if marked else 0
            if marked and here and here != part:
                last, where = GOOD, b.at if near is before else b.at + len(b.text)
            if here or not marked:
                part = here
                near[i] = (last, abs((b.at if near is before else b.at + len(b.text)) - where))
                if first[i] in (GOOD, NEAR) or (first[i] == BAD and not b.bad):
                    last, where = (BAD if first[i] == BAD else GOOD), (b.at + len(b.text) if near is before else b.at)
                elif first[i] == BAD and not marked:
                    last, where = BAD, (b.at + len(b.text) if near is before else b.at)
    for i, b in enumerate(found):
        if first[i] in (GOOD, BAD):
            continue
        (one, far1), (two, far2) = before[i], after[i]
        if b.heading and two == GOOD and far2 <= HEADING_REACH:
            b.label = GOOD
        elif first[i] == NEAR:
            b.label = BAD if (one or BAD) == BAD == (two or BAD) else GOOD
        elif one == two or not one or not two:
            b.label = one or two or BAD
        else:
            b.label = one if far1 < far2 or (far1 == far2 and one == GOOD) else two
    return found


def main_text(page: str | None) -> str:
    return "\n".join(b.text for b in classify(page_blocks(page or "")) if b.label == GOOD)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(*keep, text, n_chars) of every page.  No shuffle."""
    need = pick(pages, *keep, html_col)
    kinds = dict(need.dtypes)

    def run(batches):
        for b in blocks(batches, html_col):
            texts = [main_text(x) for x in column(b, html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[column(b, k) for k in keep], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[*keep, "text", "n_chars"])

    return need.mapInArrow(run, ", ".join([*[f"`{k}` {kinds[k]}" for k in keep], "text string", "n_chars long"]))


def query(pages: DataFrame) -> DataFrame:
    return extract(pages)
