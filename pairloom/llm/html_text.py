"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. Pass one decides a block by its share of link text, by evidence of
its containers (menus, footers, asides, forms, roles, whole class or id names that tell of other matter, all of which
count as one feature) or a copyright sign at the head of a line outside of articles, by its length and its density of stop words. Short blocks, and long ones with few links
and few stop words, stay open; the long ones are text where no list of stop words fits the page. In pass two
an open block takes the label of its nearest decided neighbours: those with which it shares the deeper container,
and of two that share the same one, the nearer. Blocks decided by the evidence of containers alone are no neighbours,
since they say nothing on what stands beside them; a block without neighbours in its region (an article, the
main part, or the rest of the page) is kept. A container that may hold the text in spite of its name or kind is
judged as any other if it holds more long text than all that is outside of such. An article hides what is outside if it holds at
least as much text. Scripts, styles, buttons and hidden elements are markup, and give no blocks.

Nulls and edges: a null or empty page has the text ""; broken markup, cut tags and unclosed elements are read as far
as they go; pages of any length are read whole; null or repeated ids and addresses are kept as they are;
extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow

#: Characters from which a block is decided on its own.
LENGTH = 70
#: Share of a block's characters in links from which it is a menu.
LINKS = 0.4
#: Share of stop words that running text has at least, in an article and elsewhere.
STOPS_ARTICLE, STOPS = 0.08, 0.15

STOP_WORDS = {
    "en": "a about after all also an and any are as at be been but by can could did do for from had has have he her his how i if in into is it its more my no not of on one or other our out she so some than that the their them then there these they this to up was we were what when which who will with would you your",
    "fr": "à au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui ma mais me même mes mon ne nos notre nous on ont ou par pas plus pour qu que quel qui sa sans se ses son sont sur ta te tes tu un une vos votre vous y",
    "de": "aber als also am an auch auf aus bei bin bis das dass dem den der des die doch durch ein eine einem einen einer es für hat ich ihr im in ist ja kann mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wie wir zu zum zur",
    "es": "a al algo como con contra cual de del desde donde el ella en entre era es esta este esto fue ha han hasta hay la las le les lo los más me mi muy no nos o otro para pero por que se ser si sin sobre son su sus también te todo un una uno y ya yo",
}
_STOPS = {k: frozenset(v.split()) for k, v in STOP_WORDS.items()}

_BLOCKS = frozenset(
    "address article aside blockquote body br-block caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frame frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link main menu meta nav noframes ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PLAIN = frozenset("abbr acronym b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small strike strong sub sup time tt u var wbr".split())
#: Elements whose content is never text; where those of the second kind are not closed, only their tag is passed over.
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_FOREIGN = frozenset("math noscript object select svg template".split())
_UNSEEN = frozenset("button head".split())
_ASIDE = frozenset("aside dialog footer menu nav".split())
#: Elements that hold whole pages too.
_PERHAPS = frozenset("fieldset form".split())
_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Names of what is never the text of a page.
_NEVER = frozenset(
    "ad ads adv advert adverts advertisement advertising advertisements adsense breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "footer gdpr login nav navbar navi pager pagination signup sitenav skyscraper sponsor sponsored".split()
)
#: Names that wrappers of a whole text have too: the text comes back where it outweighs the rest of the page.
_SELDOM = frozenset(
    "banner byline disclaimer masthead menu menus modal navigation newsletter notice notices paywall popup promo promotion promoted recommended related respond "
    "share sharing sidebar sidebars social subscribe subscription toolbar topbar".split()
)
#: Words of layout that may stand beside these in a class or id.
_LAYOUT = frozenset(
    "area article bar blog block body bottom box btn button buttons center col column container desktop fixed floating global group header icons inline inner item items left "
    "link links list local main mobile outer page panel post posts primary reader right secondary section sharing site slot sticky tag text title top unit user widget widgets wrap wrapper".split()
)
#: Of these, what the wrapper of a page is told by that has such a part in this place.
_PLACES = frozenset("body bottom fixed left main page right sticky top".split())
_TAG = re.compile(r"""<(?:!--(?:>|->|.*?(?:-->|--!>|\Z))|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_HEADING = re.compile("h[1-6]")
_EDGES = re.compile("[.,;:!?()\"'«»]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    links: int  # characters in links
    region: int  # 0 is the page itself
    heading: bool
    evidence: int = 0  # of containers: 1 that it may be other matter, 2 that it is
    named: int = 0  # the outermost container with evidence 1; 0 is outside of all
    dip: int = 0  # the fewest containers open since the block before


def _names(value: str) -> int:
    """2 if one of the names says that it is never text, 1 if one says that it seldom is. The whole name has to."""
    most = 0
    for name in value.split():
        parts = {x.lower() for x in _WORDS.findall(name)} if name.isascii() else set()
        known = parts & (_NEVER | _SELDOM)
        if known and all(x in known or x in _LAYOUT or x.isdigit() for x in parts):
            most = max(most, 2 if known & _NEVER and not parts & _PLACES else 1)
    return most


def _evidence(tag: str, attributes: str, in_article: bool) -> int:
    """What an element, its role, or its whole class or id say: 3 not shown, 2 other matter, 1 perhaps, 0 nothing."""
    if tag in _UNSEEN:
        return 3
    most = 2 if tag in _ASIDE or tag == "header" and not in_article else int(tag in _PERHAPS)
    if not attributes or tag in ("html", "body", "article", "main"):
        return most
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
            return 3
        if name == "role" and value.lower() in _ROLES:
            most = 2
        if name == "class" or name == "id" and not _HEADING.fullmatch(tag):  # a heading's id tells what it is about
            most = max(most, _names(value))
    return most


def blocks(page: str) -> list[Block]:
    """The blocks of a page, in order, with what their containers say of them."""
    found: list[Block] = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, int, int, int]] = []  # tag, unseen; region, evidence and named container outside
    at, unseen, region, regions, evidence, named, containers, heading, dip = 0, 0, 0, 0, 0, 0, 0, False, 0
    link: int | None = None  # how many containers are open around the open link

    def flush() -> None:
        nonlocal dip
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                found.append(Block(whole, len(" ".join(html.unescape(" ".join(linked)).split())) if linked else 0, region, heading, evidence, named, dip))
                dip = len(stack)
            text.clear()
            linked.clear()

    def put(piece: str) -> None:
        if piece and not unseen:
            text.append(piece)
            if link is not None:
                linked.append(piece)

    def pop() -> None:
        nonlocal unseen, region, evidence, named, dip, link
        _, was_unseen, *was = stack.pop()
        if [evidence, named] != was[1:]:
            flush()
        unseen -= was_unseen
        region, evidence, named = was
        dip = min(dip, len(stack))
        if link is not None and len(stack) < link:
            link = None

    n = len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            put(page[at:])
            break
        m = _TAG.match(page, start)
        if m is None:  # a bare <
            put(page[at : start + 1])
            at = start + 1
            continue
        put(page[at:start])
        at = m.end()
        if m[2] is None:
            continue
        close, tag, attributes = bool(m[1]), m[2].lower(), m[3]
        if not close and (tag in _RAW and not attributes.endswith("/") or tag in _FOREIGN):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            if end or tag in _RAW:
                at = end.end() if end else n
            continue
        block = tag in _BLOCKS
        if block:
            flush()
        if tag == "a":
            link = len(stack) if not close and "href" in attributes.lower() else None
        if tag == "br":
            put(" ")
        if tag in _VOID or tag == "a":
            continue
        if close:
            heading = False if tag[:1] == "h" and tag[1:].isdigit() else heading
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if any(x[0] in ("article", "main", "body") for x in stack[k + 1 :]) and tag not in ("html", "body"):
                        break  # a stray end tag does not close what holds it
                    while len(stack) > k:
                        pop()
                    break
            continue
        if block:
            heading = tag[:1] == "h" and tag[1:].isdigit()
            if stack and stack[-1][0] == "p" or stack and tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] == tag:
                pop()
        says = _evidence(tag, attributes, region > 0)
        if tag in _PLAIN and not says:
            continue
        if attributes.endswith("/") and not block:
            continue
        inline = tag in _PLAIN or tag in ("span", "label")
        stack.append((tag, says == 3 or says > 0 and inline, region, evidence, named))
        unseen += stack[-1][1]
        if says and not stack[-1][1]:
            flush()
            if says == 1 and not evidence:
                containers += 1
                named = containers
            evidence = max(evidence, says)
        if tag in ("article", "main") and not region:
            regions += 1
            region = regions
    flush()
    return found


def density(text: str) -> float:
    """The largest share of stop words, over the languages known."""
    words = _EDGES.sub("", text.lower()).split()
    return max(sum(map(s.__contains__, words)) for s in _STOPS.values()) / max(1, len(words))


def _is_linked(b: Block) -> bool:
    return b.links >= LINKS * len(b.text)


def _is_other(b: Block) -> bool:
    return _is_linked(b) or b.evidence > 0 or not b.region and b.text.startswith("©")


def first_pass(b: Block) -> bool | None:
    """True for text, False for other matter, None for what is open."""
    if _is_other(b):
        return False
    if len(b.text) < LENGTH:
        return None
    if b.region:
        return True if density(b.text) >= STOPS_ARTICLE else None
    return density(b.text) >= STOPS


def _open(found: list[Block], first: list[bool | None]) -> list[bool | None]:
    """Labels where long blocks of few links and stop words are open, or text if no list of stop words fits the page."""
    long = [len(b.text) >= LENGTH and not _is_other(b) for b in found]
    if all(x is True for x, y in zip(first, long, strict=True) if y):
        return first
    texts = [b.text for b, y in zip(found, long, strict=True) if y]
    fits = sum(len(t) * density(t) for t in texts) >= STOPS * sum(map(len, texts))
    return [(None if fits else True) if y and x is not True else x for x, y in zip(first, long, strict=True)]


def decided(found: list[Block]) -> list[bool | None]:
    """Pass one for a whole page."""
    return _open(found, [first_pass(b) for b in found])


def _nearest(found: list[Block], first: list[bool | None], back: bool) -> list[tuple[bool, int, int] | None]:
    """Label of the nearest decided block of the same region on one side, containers shared with it, and distance."""
    out: list[tuple[bool, int, int] | None] = [None] * len(found)
    deepest = 1 << 30
    last: dict[bool, list] = {}  # within an article (which is one stretch), and outside: region, label, place, shared
    order = range(len(found) - 1, -1, -1) if back else range(len(found))
    for i in order:
        b = found[i]
        dip = found[i + 1].dip if back and i + 1 < len(found) else b.dip
        for x in last.values():
            x[3] = min(x[3], dip)
        x = last.get(b.region > 0)
        if x and x[0] == b.region:
            out[i] = x[1], x[3], abs(i - x[2])
        if first[i] is not None and not b.evidence:
            last[b.region > 0] = [b.region, first[i], i, deepest]
    return out


def labels(found: list[Block]) -> list[bool]:
    """Both passes: whether each block is text."""
    first = decided(found)
    out = []
    for b, label, before, after in zip(found, first, _nearest(found, first, False), _nearest(found, first, True), strict=True):
        if label is None:
            if before is None or after is None or before[0] == after[0]:
                label = (before or after or (True,))[0]
            elif b.heading and not b.region and after[1] >= before[1]:
                label = after[0]  # a heading goes with what follows it
            elif before[1] != after[1]:
                label = max(before, after, key=lambda x: x[1])[0]
            elif b.region or before[2] == after[2]:
                label = True
            else:
                label = min(before, after, key=lambda x: x[2])[0]
        out.append(label)
    return out


def _come_back(found: list[Block]) -> None:
    """Clears the evidence of containers that may be other matter, where they hold more long text than what is outside."""
    rest, prose = 0, {}
    for b in found:
        if b.evidence < 2 and not _is_linked(b):
            if b.evidence == 0:
                rest += len(b.text)
            elif len(b.text) >= LENGTH:
                prose[b.named] = prose.get(b.named, 0) + len(b.text)
    for b in found:
        if b.evidence == 1 and prose.get(b.named, 0) > rest:
            b.evidence = 0


def extract(page: str | None) -> str:
    """The main text: its blocks in order, one per line. An article that holds more than what is outside hides that."""
    found = blocks(page or "")
    _come_back(found)
    kept = [b for b, keep in zip(found, labels(found), strict=True) if keep]
    sizes: dict[int, int] = {}
    for b in kept:
        sizes[b.region] = sizes.get(b.region, 0) + len(b.text)
    outside = sizes.pop(0, 0)
    if sizes and max(sizes.values()) >= outside:
        kept = [b for b in kept if b.region]
    return "\n".join(b.text for b in kept)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id_col, url_col, text string, n_chars long: one row per page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [id_col, url_col, "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return in_arrow(pages.select(id_col, url_col, html_col), run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long")
