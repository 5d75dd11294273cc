"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags; scripts, styles, comments and
other raw elements give no text. Pass 1 classifies a block by where it stands
and by its words: a block inside navigation, header, footer, sidebar, form,
notice, advert or comment markup is boilerplate; a block of the article element
is text unless it is one of ``LINK_RUN`` or more link blocks in a row; elsewhere
link density, length and stop-word density decide, and short blocks without much
evidence stay ambiguous. Class names of the page's own wrappers (``html``,
``body``, ``main``, ``article``) reject nothing, and if no text is found, names on
elements with most of the page's text are left out of account. Pass 2 gives every ambiguous block
the label of its nearest decided neighbours (text if both sides are text, or if
the nearer one is). The text is the good blocks in page order.

Every page is read whole inside its own task, no shuffle. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_rows

MAX_LINK_DENSITY = 0.3
#: In an article, so many blocks in a row of at least this link density are a list of links.
LINK_RUN = 3
LINK_LIST_DENSITY = 0.66
#: An element with more than this share of a page's text holds most of it.
MOST = 0.5
SHORT_CHARS = 70
LONG_CHARS = 200
LOW_STOP_WORDS = 0.15
HIGH_STOP_WORDS = 0.3

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    "a an and are as at be by for from has have he her his in is it its not of on or she that the "
    "their they this to was were which with you "
    "aber als auch auf aus bei das dem den der des die durch ein eine einen er es für im in ist mit "
    "nicht sich sie sind und von war wie wird zu zum zur "
    "al como con de del el en es esta fue la las lo los más no o para pero por que se ser su sus un "
    "una y ya "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne ou par pas "
    "pour qui que sa se ses son sur un une".split()
)
# Tags that end a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li "
    "main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that hold the page or its article: their names say nothing of their text.
WRAPPER_TAGS = frozenset("html body main article".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is never text of the page.
RAW_TAGS = frozenset("script style noscript template textarea title svg iframe object".split())
BOILERPLATE_TAGS = frozenset(
    "nav header footer aside form menu dialog button select option label fieldset".split()
)
_BOILERPLATE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|"
    r"header|menu|modal|nav\w*|newsletter|notice|popup|promo\w*|related|replies|share|sharing|"
    r"side|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
_ROLE_BOILERPLATE = frozenset("navigation banner contentinfo complementary search form dialog alert".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"\w+")

GOOD, BAD, SHORT = "good", "bad", "short"


@dataclass
class Block:
    text: str
    link_chars: int
    in_boilerplate: bool
    in_article: bool
    #: Numbers of the open elements that only a class or id names as boilerplate.
    named: tuple[int, ...]

    @property
    def link_density(self) -> float:
        return self.link_chars / len(self.text) if self.text else 0.0


def _boilerplate_names(attributes: str) -> tuple[bool, bool]:
    """Whether the role, and whether a class or id, names boilerplate."""
    role = name = False
    if "=" in attributes:
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            value = a or b or c
            if key.lower() == "role":
                role |= value.strip().lower() in _ROLE_BOILERPLATE
            else:
                name |= bool(_BOILERPLATE_NAME.search(value))
    return role, name


def _pieces(html: str):
    """Yields ``("text", s)``, ``("open", tag, attributes)`` and ``("close", tag)`` in page order."""
    pos, n = 0, len(html)
    while pos < n:
        m = _TAG.search(html, pos)
        if not m:
            yield "text", html[pos:], ""
            return
        if m.start() > pos:
            yield "text", html[pos : m.start()], ""
        pos = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            yield "close", tag, ""
        elif tag in RAW_TAGS and not m.group(3).rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, pos)
            yield "break", tag, ""
            pos = end.end() if end else n
        else:
            yield "open", tag, m.group(3)


def blocks_of(html: str) -> list[Block]:
    """The non-empty blocks of a page, character references decoded, white space made single."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # open elements: tag, boilerplate by tag or role, number if by name
    named: list[int] = []
    bad = article = links = numbers = 0
    parts: list[str] = []
    link_parts: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                linked = " ".join(unescape("".join(link_parts)).split())
                out.append(Block(text, len(linked), bad > 0, article > 0, tuple(named)))
        parts.clear()
        link_parts.clear()

    def count(tag: str, is_bad: bool, by: int) -> None:
        nonlocal bad, article, links
        bad += by * is_bad
        article += by * (tag in ("article", "main"))
        links += by * (tag == "a")

    for kind, value, attributes in _pieces(html):
        if kind == "text":
            parts.append(value)
            if links:
                link_parts.append(value)
            continue
        if value in BLOCK_TAGS or kind == "break":
            flush()
        if kind == "open":
            if value in VOID_TAGS or attributes.rstrip().endswith("/"):
                continue
            role, name = _boilerplate_names(attributes)
            is_bad = value in BOILERPLATE_TAGS or role
            # an article's own heading group is part of the article
            if value == "header" and article and not role and not name:
                is_bad = False
            number = 0
            if name and value not in WRAPPER_TAGS:
                numbers += 1
                number = numbers
                named.append(number)
            stack.append((value, is_bad, number))
            count(value, is_bad, 1)
        elif kind == "close" and any(t == value for t, _, _ in reversed(stack)):
            while True:
                tag, was_bad, number = stack.pop()
                count(tag, was_bad, -1)
                if number:
                    named.pop()
                if tag == value:
                    break
    flush()
    return out


def first_label(block: Block, trusted: frozenset[int] = frozenset()) -> str:
    """Pass 1: good, bad or short (ambiguous); names of ``trusted`` elements are left out of account."""
    if block.in_boilerplate or any(k not in trusted for k in block.named):
        return BAD
    if block.in_article:
        return GOOD
    if block.link_density > MAX_LINK_DENSITY:
        return BAD
    words = _WORD.findall(block.text.lower())
    density = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    n = len(block.text)
    if n < SHORT_CHARS:
        return SHORT if not block.link_chars else BAD
    if density >= HIGH_STOP_WORDS and n >= LONG_CHARS:
        return GOOD
    if density >= LOW_STOP_WORDS:
        return GOOD if n >= LONG_CHARS else SHORT
    return BAD if n < LONG_CHARS else SHORT


def first_labels(blocks: list[Block], trusted: frozenset[int] = frozenset()) -> list[str]:
    """Pass 1 of all blocks; lists of links inside an article are bad."""
    labels = [first_label(b, trusted) for b in blocks]
    run: list[int] = []
    for k, block in enumerate([*blocks, None]):
        if block and block.in_article and block.link_density >= LINK_LIST_DENSITY:
            run.append(k)
            continue
        if len(run) >= LINK_RUN:
            for j in run:
                labels[j] = BAD
        run = []
    return labels


def _holders(blocks: list[Block]) -> frozenset[int]:
    """Numbers of named elements that hold most of the page's text."""
    chars: Counter = Counter()
    for block in blocks:
        for number in block.named:
            chars[number] += len(block.text)
    total = sum(len(b.text) for b in blocks)
    return frozenset(k for k, n in chars.items() if n > MOST * total)


def final_labels(labels: list[str]) -> list[bool]:
    """Pass 2: True for text. An ambiguous block takes its nearest decided neighbours' label."""
    n = len(labels)
    before: list[tuple[str, int] | None] = [None] * n
    after: list[tuple[str, int] | None] = [None] * n
    last = None
    for k in range(n):
        before[k] = last
        if labels[k] != SHORT:
            last = (labels[k], k)
    last = None
    for k in range(n - 1, -1, -1):
        after[k] = last
        if labels[k] != SHORT:
            last = (labels[k], k)
    out = []
    for k, label in enumerate(labels):
        if label != SHORT:
            out.append(label == GOOD)
            continue
        a, b = before[k], after[k]
        if a and b and a[0] != b[0]:
            out.append((a if k - a[1] < b[1] - k else b)[0] == GOOD)
        else:
            near = a or b
            out.append(bool(near) and near[0] == GOOD)
    return out


def main_text(html: str | None) -> str:
    """The good blocks joined by one space; empty for a null or empty page."""
    if not html:
        return ""
    blocks = blocks_of(html)
    keep = final_labels(first_labels(blocks))
    if not any(keep) and (holders := _holders(blocks)):
        keep = final_labels(first_labels(blocks, holders))
    return " ".join(b.text for b, good in zip(blocks, keep) if good)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page; text is empty if there is none.

    Null ids and urls are carried, repeated rows are kept, other columns are
    ignored.
    """

    def row(page_id, url, html):
        text = main_text(html)
        return page_id, url, text, len(text)

    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
    )
    return map_rows(source, row, "page_id long, url string, text string, n_chars long", per_batch=500)
