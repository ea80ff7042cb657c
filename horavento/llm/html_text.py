"""Main text of web pages by two-pass block rules.

A page is cut into blocks of text at block-level tags.  First pass: stop-word
density, length and link density decide every block as text, boilerplate or
ambiguous, and the elements it stands in add evidence: inside navigation,
footers, forms, adverts or comments a block is boilerplate; inside an article
what would be boilerplate for few stop words or linked prose is ambiguous or
text.  Short blocks stay ambiguous in and beside an article.  Second pass: an
ambiguous block takes the label of the nearest decided neighbours, those on
its own side of the article's border first.  An article without a decided
text block is text only where the page has no other text.  A page of almost
no stop words (another language) is decided by length and links alone, and so
is one of short blocks only.

Class words behind a state prefix (``no-sidebar``) and those of ``body`` and
``html`` are no evidence, and a class or id is none either where its element
holds most of a page's text blocks.

An article stays boilerplate in a navigation or aside element or with a
boilerplate class of its own.  In other boilerplate that is closed behind it
(a list of related cards, or a form or class around a whole page) it is text
only where the page has no other; an unclosed advert or menu before it does
not count.

The scan is linear in the page, and pages are independent, so the whole job is
one narrow ``mapInArrow``: nothing is shuffled and a page of any size is one
row of one task.

Defined cases: null or empty html gives the empty text; unclosed and stray
tags, comments and attributes are tolerated; repeated rows are answered each;
other columns are not read.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.llm.common import map_batches, register, table, text_column

#: a block from LONG characters on is decided by its stop words, one under SHORT is ambiguous
SHORT, LONG = 70, 140
#: where no block is decided, one from BRIEF characters on is text
BRIEF = 25
#: a page whose long blocks hold fewer stop words is in another language
FOREIGN = 0.03
#: share of a page's text characters, and text blocks, that a boilerplate class can't hold
HELD_SHARE, HELD_BLOCKS = 0.8, 3
STOP_LOW, STOP_HIGH, LINKS = 0.12, 0.25, 0.4

# Stop words of the four languages, tags, and class or id words.
STOP_WORDS = frozenset("""
the of and to in a is that it for was on with as by at be this from or are an were which have has had not but they
his her he she you we their all there been one so if will would can no when who more out up about into than them
der die das und in zu den ist von mit sich des auf für im dem nicht ein eine als auch es an werden aus er hat dass
sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch
de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux ou mais
elle nous vous leur cette ces sans être fait comme tout on entre
el que y los del se las por con una su para es al lo como más pero sus le ya o este sí porque esta entre cuando muy
sin sobre también me hasta hay donde quien desde todo nos durante
""".split())
RAW = frozenset("script style noscript template iframe svg math object canvas textarea select option button title".split())
#: these hold raw text up to their end tag; the others end at a block tag where theirs is missing
RAW_TO_END = frozenset("script style textarea title iframe".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td
tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav footer aside form head header menu dialog fieldset".split())
BOILER_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored sponsors promo
promotion banner sidebar side menu menubar nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar
cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share
sharing social related recommended teaser widget pagination pager tags copyright legal disclaimer comment comments reply
replies disqus respond form search toolbar skip""".split())
#: words that mark a paragraph or an inline element as no text
AD_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsored cookie cookies consent gdpr newsletter popup".split())
#: a class word behind one of these tells what a page has or lacks
STATES = frozenset("no has with without is show hide".split())
COMMENT_WORDS = frozenset("comment comments reply replies disqus respond".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
MAIN_WORDS = frozenset("article main content post entry story".split())
#: boilerplate that an article inside it never leaves
HOLD_TAGS, HOLD_ROLES = frozenset("nav aside footer menu dialog".split()), frozenset("navigation complementary contentinfo menu dialog".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_LETTERS = re.compile(r"[^\W\d_]+")
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.I)


class Cover:
    """A boilerplate element around articles: ``state`` is 0 unless it or one
    around it is closed by its own tag, 2 if such a one holds its articles."""
    __slots__ = ("around", "closed", "hold", "state")

    def __init__(self, around: Cover | None, hold: bool):
        self.around, self.hold, self.closed, self.state = around, hold, False, 0


class Block:
    __slots__ = ("article", "boiler", "chars", "cover", "heading", "label", "linked", "parts", "text", "weak")

    def __init__(self, boiler: bool, article: int, cover: Cover | None, heading: bool, weak: tuple[int, ...]):
        self.parts, self.linked, self.label = [], 0, ""
        #: numbers of the elements that only a class or id makes boilerplate, if no other is around
        self.weak = weak
        #: number of the outermost article, 0 outside; boilerplate around that article
        self.article, self.cover = article, cover
        self.boiler, self.heading = boiler, heading


def _class_words(value: str) -> set[str]:
    """The words of a class or id, without those behind a state prefix."""
    out: set[str] = set()
    for one in value.split():
        words = re.split(r"[^a-z]+", one)
        if len(words) == 1 or words[0] not in STATES:
            out.update(words)
    return out


def _advert(attributes: str) -> bool:
    """Whether a paragraph's or an inline element's class or id marks an advert or a notice."""
    return any(m[1].lower() in ("class", "id") and _class_words((m[2] or m[3] or m[4] or "").lower()) & AD_WORDS
               for m in _ATTRIBUTE.finditer(attributes))


def _marks(name: str, attributes: str) -> tuple[bool, bool, bool, bool, bool]:
    """Whether an element is boilerplate, reader comments, an article,
    boilerplate that holds its articles, and boilerplate by class or id only."""
    words, role, hidden = set(), "", False
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key in ("class", "id"):
                if name not in ("body", "html"):
                    words.update(_class_words(value))
            elif key == "role":
                role = value
            elif key == "style":
                hidden = "display:none" in value.replace(" ", "")
        hidden = hidden or bool(re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes))
    article = name in ("article", "main") or role in ("main", "article")
    comment = bool(words & COMMENT_WORDS)
    sure = name in BOILER_TAGS or role in ROLES or hidden or comment
    boiler = sure or (bool(words & BOILER_WORDS) and not (words & MAIN_WORDS and name != "aside"))
    if "teaser" in words and article and name != "main":
        boiler = True
    return boiler, comment, article and not comment, name in HOLD_TAGS or role in HOLD_ROLES or hidden, boiler and not sure and not article


def blocks_of(page: str) -> list[Block]:
    """The page's blocks with text, in order, in one pass over the tags."""
    out: list[Block] = []
    #: name, boilerplate, comments, article, cover of that article, own cover, weak elements (None: others, too): inherited
    stack: list[tuple[str, bool, bool, int, Cover | None, Cover | None, tuple[int, ...] | None]] = []
    boiler = comment = False
    weak: tuple[int, ...] | None = ()
    mute, depth, weaks = "", 0, 0
    last_end: dict[str, int] = {}
    article, cover, around = 0, None, None
    covers: list[Cover] = []
    block, links, heading, articles = None, 0, False, 0

    def add(raw: str):
        nonlocal block
        if not raw or mute:
            return
        text = html_lib.unescape(raw)
        if block is None:
            if not text.strip():
                return
            block = Block(boiler, article, cover, heading, weak or ())
            out.append(block)
        block.parts.append(text)
        if links:
            block.linked += len("".join(text.split()))

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt)
        if m:
            closing, name, attributes, at = m[1], m[2].lower(), m[3], m.end()
        else:
            plain = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)").match(page, lt)
            if not plain:
                add("<")
                at = lt + 1
                continue
            end = page.find(">", lt)
            closing, name, attributes, at = plain[1], plain[2].lower(), "", n if end < 0 else end + 1
        if name in RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                tag = re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])", re.I)
                if name not in last_end:
                    last_end[name] = max((m.start() for m in tag.finditer(page, at) if m[1]), default=-1)
                end = tag.search(page, at) if last_end[name] >= at else None
                if name in RAW_TO_END:
                    while end and not end[1]:
                        end = end.re.search(page, end.end())
                elif not end or not end[1] and name not in ("svg", "object", "template"):
                    end = _BLOCK_TAG.search(page, at)  # not closed before the next of its kind
                    at = end.start() if end else n
                    continue
                else:
                    nested = 1
                    while end:
                        nested += -1 if end[1] else 1
                        if not nested:
                            break
                        end = end.re.search(page, end.end())
                    if not end:
                        end = _BLOCK_TAG.search(page, at)
                        at = end.start() if end else n
                        continue
                gt = page.find(">", end.end()) if end else -1
                at = n if gt < 0 else gt + 1
            continue
        if name == "a":
            links = max(0, links - 1) if closing else links + 1
            continue
        if name not in BLOCK:
            if name == mute:
                depth += -1 if closing else 1
                mute = mute if depth else ""
            elif not mute and not closing and attributes and name not in VOID and _advert(attributes):
                mute, depth = name, 1
            continue
        block, mute = None, ""
        if name in VOID:
            continue
        if name[0] == "h" and name[1:].isdigit():
            heading = not closing
            continue
        if name == "p":
            if not closing:
                links = 0
                if attributes and _advert(attributes):
                    mute, depth = "p", 1
            continue
        if closing:
            if any(s[0] == name for s in stack):
                while stack:
                    top = stack.pop()
                    if top[0] == name:
                        if top[5] and top[5] is not (stack[-1][5] if stack else None):
                            top[5].closed = True
                        break
        else:
            own, own_comment, own_article, hold, by_class = _marks(name, attributes)
            inherited = boiler
            if own:
                weaks += 1
                weak = weak + (weaks,) if by_class and weak is not None else None
            if own_article and not comment:
                # what the boilerplate around it means is known at its end
                own, inherited = own and name != "main", False
                if boiler:
                    cover = around
            if name == "header" and article and not boiler and not own_comment:
                own = False
            if own:
                around = Cover(around, hold or own_article)
                covers.append(around)
            if own_article and not article:
                articles += 1
                article = articles
            stack.append((name, inherited or own, comment or own_comment, article, cover, around, weak))
            links = 0
        _, boiler, comment, article, cover, around, weak = stack[-1] if stack else ("", False, False, 0, None, None, ())
    for c in covers:
        c.state = max(c.around.state if c.around else 0, (2 if c.hold else 1) if c.closed else 0)
    return out


def _stop_words(b: Block) -> tuple[int, int]:
    words = [w.lower() for w in _LETTERS.findall(b.text)]
    return sum(w in STOP_WORDS for w in words), len(words)


def _foreign(blocks: list[Block]) -> bool:
    """Whether the blocks from SHORT characters on hold almost no stop word."""
    found = [_stop_words(b) for b in blocks if not b.boiler and not b.article and len(b.text) >= SHORT]
    return sum(s for s, _ in found) < FOREIGN * sum(n for _, n in found)


def _first(b: Block, inside: bool, foreign: bool = False) -> str:
    """The label by stop words, length and links; "" is ambiguous."""
    stops, size = _stop_words(b)
    density, words = stops / size if size else 0.0, range(size)
    links = b.linked / b.chars if b.chars else 0.0
    # linked words inside an article's prose are text, a block of links is not
    if links > LINKS and (not inside or density < STOP_HIGH or links > 0.9 and len(words) < 12):
        return "bad"
    if len(b.text) < SHORT:
        return "bad" if links and not inside else ""
    if foreign and not inside:
        return "good" if links <= LINKS else "bad"
    if density >= STOP_HIGH or density >= STOP_LOW and len(b.text) >= LONG:
        return "good"
    return "bad" if density < STOP_LOW and len(b.text) >= LONG and not inside else ""


def _near(blocks: list[Block], side: bool) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
    """Distance and label of the nearest decided block before and after each,
    with ``side`` among those of the same article (or of none; boilerplate
    elements inside an article are not of it)."""
    n = len(blocks)
    before, after = [(0, "")] * n, [(0, "")] * n
    for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, tuple[int, str]] = {}
        for i in order:
            key = blocks[i].article if side and not blocks[i].boiler else 0
            if key in last:
                near[i] = (abs(i - last[key][0]), last[key][1])
            if blocks[i].label:
                last[key] = (i, blocks[i].label)
    return before, after


def _free_wrapped(blocks: list[Block]) -> None:
    """A class or id is no evidence where its element holds most of the text
    blocks: those blocks lose that mark."""
    if not any(b.weak for b in blocks):
        return
    text = [b for b in blocks if not b.article and (b.weak or not b.boiler) and _first(b, False) == "good"]
    if any(b.article and not b.boiler for b in blocks):
        return
    total, held = sum(b.chars for b in text), {}
    for b in text:
        for e in b.weak:
            n, chars = held.get(e, (0, 0))
            held[e] = n + 1, chars + b.chars
    freed = {e for e, (n, chars) in held.items() if n >= HELD_BLOCKS and chars > HELD_SHARE * total}
    for b in blocks if freed else ():
        if b.weak:
            b.weak = tuple(e for e in b.weak if e not in freed)
            b.boiler = bool(b.weak)


def _decide(blocks: list[Block]) -> None:
    """Both passes: sets ``label`` to good or bad."""
    covered = []
    for b in blocks:
        b.text = " ".join("".join(b.parts).split())
        b.chars = len(b.text) - b.text.count(" ")
    _free_wrapped(blocks)
    foreign = _foreign(blocks)
    for b in blocks:
        state = b.cover.state if b.cover else 0
        if b.boiler or state:
            b.label = "bad"
            if state == 1 and not b.boiler:
                covered.append(b)
        else:
            b.label = _first(b, b.article > 0, foreign)
    if covered and not any(b.label == "good" or b.article and not b.label for b in blocks):
        for b in covered:
            b.label = _first(b, True)
    text = {b.article for b in blocks if b.label == "good"}
    if not text:
        for b in blocks:
            if b.article and not b.label:
                b.label = "good"
    if not any(b.label == "good" for b in blocks):
        for b in blocks:
            if not b.label and len(b.text) >= BRIEF and b.linked <= LINKS * b.chars:
                b.label = "good"
    own, page = _near(blocks, True), _near(blocks, False)
    for i, b in enumerate(blocks):
        if b.label:
            continue
        (d1, left), (d2, right) = own[0][i], own[1][i]
        if b.heading and not b.article:
            right = page[1][i][1]
        elif not left and not right or b.article and b.article not in text:
            (d1, left), (d2, right) = page[0][i], page[1][i]
        if b.heading and right:
            b.label = right
        elif left == right or not right:
            b.label = left or "bad"
        elif not left:
            b.label = right
        else:
            b.label = left if d1 < d2 else right if d2 < d1 else "good"


def main_text(page: str | None) -> str:
    """The text blocks of a page, joined by newlines."""
    blocks = blocks_of(page or "")
    _decide(blocks)
    return "\n".join(b.text for b in blocks if b.label == "good" and b.text)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``."""
    def fn(batch: pa.RecordBatch) -> dict:
        texts = [main_text(h) for h in text_column(batch, "html")]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return map_batches(rows, fn, "page_id long, url string, text string, n_chars long")


@register("op3_html_text")
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
