"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  Blocks inside menus, headers,
footers, sidebars, notices, adverts, forms and reader comments are left out by
their tags, roles and class names.  Class names that only say how a page is laid
out (has-sidebar, comments-off, search-page) say nothing, and an element that
holds half of the page's text that is not links, or more, is left out only if its
name is a word of its own, or one of comments, and no article is inside.
The first pass labels each of the others good, bad
or ambiguous: bad if links make up most of it, else by its length and stop-word
density.  A page whose longer blocks have next to no stop words is in a language
that they do not tell, so length alone does; signs of scripts that are written
without spaces count as WIDE letters each.  An article or main element sets the thresholds: inside it a block needs
little to be good and is never bad by density; outside it a block needs both a
high density and length, unless the elements hold less than half of the page's
text that is not links (a teaser), where the usual thresholds hold outside.
In the second pass an ambiguous block takes the label of its nearest decided
neighbour on its side of the element; between two at one distance a heading
follows the one below, others are good if both are, or inside the element if one
is, and what the element begins with is good.  A side without good blocks has its ambiguous ones good, but not outside an
element that holds half of the text or more.  A heading inside the element that
is a link follows the block below it, if that is no such heading.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LINES = HEADINGS | {"p"}
ITEMS = frozenset("li dt dd tr td th option".split())
BARRIERS = ("article", "main", "body", "table")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("head script style noscript template svg math iframe object canvas audio video map".split())
APART = frozenset("nav footer aside menu dialog form button select textarea input search fieldset".split())
RAW = "script|style|textarea|title|noscript|iframe|template"
#: Words of class names, ids and roles of parts that are not main text.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentary cookie cookies consent contentinfo complementary copyright disclaimer disqus dropdown footer gdpr "
    "header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination paywall popup promo promoted promotion related reply replies respond rss search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
#: Parts of compound names that make them names of a layout or a state, in front and at the end.
BEFORE, AFTER = frozenset("has no with without is not".split()), frozenset("on off open opened closed enabled disabled active visible page layout template".split())
COMMENTS = frozenset("comment comments commentary disqus reply replies respond".split())
MAIN_HINTS = frozenset("header masthead tags related".split())  # inside an article these may be its own
#: Frequent short words of English, French, German and Spanish.
STOP = frozenset(
    "a about all also an and are as at be but by can for from had has have he her his i if in is it its more not of on one or our she so that the their there they this to was we were what which who will with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous ou par pas plus pour qu que qui sa se ses son sur un une vous "
    "aber als am auch auf aus bei bin bis das dem den der die dies ein eine einem einen einer er es für hat ich im ist mit nach nicht noch nur oder sein sich sie sind so um und von vor war wie wird zu zum zur "
    "al como con del el ella ellos era esta este ha hay las lo los mi muy no o para pero por se si sin sobre su sus también todo una uno y ya".split()
)
SHORT, LONG = 70, 200
LINKS, LOW, HIGH = 0.5, 0.2, 0.3
#: Scripts without spaces: Thai to Tibetan, Burmese, Khmer, Chinese, Japanese; letters that one of their signs counts as.
UNSPACED, WIDE = re.compile(r"[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0002ffff]"), 3

# Possessive, so that no long run without its end is read again from each of its characters.
_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*))>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]++)))?", re.DOTALL)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+(?:>|\Z)", re.IGNORECASE) for t in RAW.split("|")}
_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+|\d+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|$)|display\s*+:\s*+none", re.IGNORECASE)
_INNER = re.compile(r"\w(?:.*\w)?", re.DOTALL)
_NUMBER = re.compile(r"&#(?:(\d{8,})|[xX]([0-9a-fA-F]{7,}));?")


def decoded(text: str) -> str:
    """The text with character references decoded; numbers beyond Unicode give U+FFFD, however long they are."""

    def short(m: re.Match) -> str:
        digits = (m[1] or m[2]).lstrip("0")
        return f"&#{'x' if m[2] else ''}{digits or 0};" if len(digits) <= 7 else "�"

    return html.unescape(_NUMBER.sub(short, text) if "&#" in text else text)


def _names(attrs: str) -> tuple[set[str], bool, str]:
    """The hint words of class, id and role, whether one is a name of its own, and the role."""
    words, own, role = set(), False, ""
    for m in _ATTR.finditer(attrs):
        key = m[1].lower()
        if key in ("class", "id", "role"):
            value = decoded(m[2] or m[3] or m[4] or "")
            role = value.strip().lower() if key == "role" else role
            for name in value.split():
                parts = [w.lower() for w in _PART.findall(name)]
                found = HINTS.intersection(parts)
                if found and not (len(parts) > 1 and (parts[0] in BEFORE or parts[-1] in AFTER)):
                    words |= found
                    own |= len(parts) == 1
    return words, own, role


class Reader:
    """Blocks of one page: (text, share of link characters, in main, is heading), and the named elements that each is in."""

    def __init__(self):
        self.blocks: list[tuple[str, float, bool, bool]] = []
        self.named_of: list[tuple[int, ...]] = []  # of each block
        self.named: list[bool] = []  # of each element with a hint: whether it is left out even if it holds most of the text
        self.within: list[int] = []  # those open
        self.open: list[tuple[str, bool, bool, int]] = []  # tag, left out, main, number of a named element or -1
        self.places: dict[str, list[int]] = {}  # of each tag that is open
        self.left_out = self.mains = 0  # of those open
        self.text: list[str] = []
        self.linked = self.anchors = 0
        self.heading = False

    def push(self, tag: str, out: bool, main: bool, named: int) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, out, main, named))
        if named >= 0:
            self.within.append(named)
        self.left_out += out
        self.mains += main

    def close(self, place: int) -> None:
        """Close what is open from a place on."""
        while len(self.open) > place:
            tag, out, main, named = self.open.pop()
            self.places[tag].pop()
            if named >= 0:
                self.within.pop()
            self.left_out -= out
            self.mains -= main

    def end_block(self) -> None:
        text = " ".join(decoded("".join(self.text)).split())
        if text:
            self.blocks.append((text, min(1.0, self.linked / len(text)), self.mains > 0, self.heading))
            self.named_of.append(tuple(self.within))
        self.text, self.linked = [], 0

    def data(self, text: str) -> None:
        if text and not self.left_out:
            self.text.append(text)
            if self.anchors:
                self.linked += len(" ".join(decoded(text).split()))

    def start(self, tag: str, attrs: str) -> None:
        if tag in BLOCKS:
            self.end_block()
            while self.open and self.open[-1][0] in LINES:
                self.close(len(self.open) - 1)
            if tag in ITEMS and self.open and self.open[-1][0] == tag:
                self.close(len(self.open) - 1)
            self.heading = tag in HEADINGS
        elif tag == "br":
            self.data(" ")
        if tag == "a":
            self.anchors = 1
        words, own, role = _names(attrs) if "=" in attrs else (set(), False, "")
        main = tag in ("article", "main") or role in ("main", "article")
        inside = self.mains > 0
        hints = words
        if inside or tag in ("html", "body"):
            hints = hints - MAIN_HINTS if inside else set()
        out = tag in APART or tag in UNREAD or bool(hints and tag not in BLOCKS) or (tag == "header" and not inside) or bool(_HIDDEN.search(attrs))
        if main and not out:
            for i in self.within:  # it may be the story
                self.named[i] = False
        if tag not in VOID and not attrs.rstrip().endswith("/") and (tag in BLOCKS or out or main):
            named = -1
            if hints and not out:
                named = len(self.named)
                self.named.append(own or bool(hints & COMMENTS))
            self.push(tag, out, main and not out, named)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.anchors = 0
        if tag in BLOCKS:
            self.end_block()
            self.heading = False
        place = self.places[tag][-1] if self.places.get(tag) else -1
        barrier = -1 if tag in BLOCKS else max((self.places[b][-1] for b in BARRIERS if self.places.get(b)), default=-1)
        if place >= 0 and place >= barrier:
            self.close(place)


def read_blocks(page: str) -> list[tuple[str, float, bool, bool]]:
    reader, at = Reader(), 0
    while True:
        m = _TOKEN.search(page, at)
        if not m:
            reader.data(page[at:])
            break
        reader.data(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["close"] or m["close2"]:
            reader.end(tag)
            continue
        reader.start(tag, m["attrs"] or m["attrs2"] or "")
        if tag in _RAW_END:  # its text has no markup and is not read
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            reader.end(tag)
    reader.end_block()
    return _kept(reader)


def _kept(reader: Reader) -> list[tuple[str, float, bool, bool]]:
    """The blocks outside named elements, but for names of elements that hold half of the text or more."""
    if not reader.named:
        return reader.blocks
    held, total = [0] * len(reader.named), 0
    for (text, links, _, _), within in zip(reader.blocks, reader.named_of, strict=True):
        if links <= LINKS:
            total += len(text)
            for i in within:
                held[i] += len(text)
    out = [strict or 2 * h < total or not h for strict, h in zip(reader.named, held, strict=True)]
    return [b for b, within in zip(reader.blocks, reader.named_of, strict=True) if not any(out[i] for i in within)]


Block = tuple[str, float, bool, bool]


def _strong(blocks: list[Block]) -> bool:
    """Whether main elements hold half of the page's text that is not links, or more."""
    held = sum(len(b[0]) for b in blocks if b[2] and b[1] <= LINKS)
    return any(b[2] for b in blocks) and 2 * held >= sum(len(b[0]) for b in blocks if b[1] <= LINKS)


def _linked_title(block: Block) -> bool:
    text, links, inside, heading = block
    return links > LINKS and inside and heading and len(text) <= LONG


def _stops(text: str) -> float:
    """The share of stop words among the words of a text."""
    words = text.split()
    return sum(m[0].lower() in STOP for m in map(_INNER.search, words) if m) / len(words)


def _size(text: str) -> int:
    """The length of a text in letters."""
    return len(text) + (WIDE - 1) * len(UNSPACED.findall(text))


def first_pass(blocks: list[Block]) -> list[bool | None]:
    """Good, bad or ambiguous by link density, length and stop-word density."""
    strong, out = _strong(blocks), []
    sizes, shares = [_size(b[0]) for b in blocks], [_stops(b[0]) for b in blocks]
    longer = [(size, share) for b, size, share in zip(blocks, sizes, shares, strict=True) if b[1] <= LINKS and size >= SHORT]
    total = sum(a for a, _ in longer)
    told = total < LONG or sum(a * b for a, b in longer) >= LOW / 2 * total
    for block, size, stops in zip(blocks, sizes, shares, strict=True):
        _, links, inside, _ = block
        if links > LINKS:
            label = None if _linked_title(block) else False
        elif inside:
            label = True if size >= SHORT and (stops >= LOW / 2 or not told) else None
        elif size < SHORT:
            label = None
        elif not told:
            label = True if size > LONG else None
        elif strong:
            label = False if stops < HIGH else True if size > LONG else None
        elif stops >= HIGH:
            label = True
        elif stops >= LOW:
            label = True if size > LONG else None
        else:
            label = False
        out.append(label)
    return out


def second_pass(blocks: list[Block], first: list[bool | None]) -> list[bool]:
    """Ambiguous blocks with the labels of their neighbours."""
    strong, titles, out = _strong(blocks), [_linked_title(b) for b in blocks], [False] * len(blocks)
    for inside in (True, False):
        side = [i for i, b in enumerate(blocks) if b[2] == inside and not titles[i]]
        labels = [first[i] for i in side]
        if True in labels:
            labels = _neighbours(labels, [blocks[i][3] for i in side], inside)
        else:  # nothing long enough to tell by: all that is not links
            labels = [x is None and (inside or not strong) for x in labels]
        for i, x in zip(side, labels, strict=True):
            out[i] = x
    for i, title in enumerate(titles):
        if title and i + 1 < len(blocks) and blocks[i + 1][2] and not titles[i + 1]:
            out[i] = out[i + 1]
    return out


def label_blocks(blocks: list[Block]) -> list[bool]:
    """Which blocks are main text."""
    return second_pass(blocks, first_pass(blocks))


def _neighbours(first: list[bool | None], headings: list[bool], one: bool) -> list[bool]:
    """Labels with those of their neighbours where they are None; between two at one distance one good neighbour is enough, or both must be."""
    before, after, out = [(-1, None)] * len(first), [(-1, None)] * len(first), []
    last = (-1, None)
    for i, x in enumerate(first):
        last = (i, x) if x is not None else last
        before[i] = last
    last = (-1, None)
    for i in range(len(first) - 1, -1, -1):
        last = (i, first[i]) if first[i] is not None else last
        after[i] = last
    for i, x in enumerate(first):
        if x is not None:
            out.append(x)
            continue
        (b, up), (a, down) = before[i], after[i]
        if up is None or down is None:
            out.append(bool(up or down) or (one and up is None))  # a title above a list of links
        elif i - b != a - i:
            out.append(up if i - b < a - i else down)
        elif headings[i]:
            out.append(down)
        else:
            out.append(up or down if one else up and down)
    return out


def main_text(page: str | None) -> str:
    """The main text of one page; empty if it has none."""
    blocks = read_blocks(page or "")
    return "\n\n".join(b[0] for b, good in zip(blocks, label_blocks(blocks), strict=True) if good)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from lexiloom.llm.words import pieces

    for batch in batches:
        for part in pieces(batch, "html"):
            texts = [main_text(x) for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """The main text of each page: page_id, url, text, n_chars (code points).

    `pages` has page_id, url and html; other columns are ignored.  Character
    references are decoded, white space inside a block becomes one space, blocks
    are joined in page order by two newlines.  Null, empty and boilerplate-only
    pages give an empty text.  Null ids and urls and repeated rows are kept as
    they are; an empty table gives no rows.
    """
    src = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    return src.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op4(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


#: For pages of one article element without boilerplate inside it.
OP4_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g') AS t FROM pages),
b AS (SELECT page_id, url, string_split_regex(regexp_replace(t, '</?b>', '', 'g'), '</?(?:p|h1)>') AS p FROM a),
c AS (SELECT page_id, url, list_transform(p, lambda x: trim(regexp_replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS p FROM b)
SELECT page_id, url, array_to_string(list_filter(p, lambda x: x <> ''), chr(10) || chr(10)) AS text,
  length(array_to_string(list_filter(p, lambda x: x <> ''), chr(10) || chr(10)))::BIGINT AS n_chars FROM c
"""
