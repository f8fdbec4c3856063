"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one decides the clear
blocks: those inside boilerplate containers (navigation, header, footer, aside,
form, adverts, notices, comments, ...) and those with many linked characters
are dropped; long blocks with many stop words are kept. Pass two settles what is
left, short or undecided blocks: each takes the label of the nearest decided
blocks before and after it, kept only if those agree, or if the only neighbour
it has is kept, or if only the kept one is its sibling.

These rules run on every page. An article container only shifts them: where it
holds most of the running text, thresholds are lower inside it (and undecided
blocks stay unless their neighbours are dropped) and higher outside; where it
does not, as with a teaser beside the story, they are the same on both sides.
Blocks look for neighbours on their own side of the container.

Stop words cover English, French, German and Spanish. A block without any is
undecided, not boilerplate, and on a page without running text in these
languages length and links decide alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINK_DENSITY = 0.33  # share of linked characters from which a block is dropped
STOP_HIGH, STOP_LOW = 0.30, 0.15  # stop words per word
LENGTH_LONG, LENGTH_SHORT = 200, 70  # characters


class Limits(NamedTuple):
    links: float
    stop_high: float
    stop_low: float
    long: int
    short: int


PLAIN = Limits(LINK_DENSITY, STOP_HIGH, STOP_LOW, LENGTH_LONG, LENGTH_SHORT)
#: Inside the article that holds the page's text: only blocks that are nearly all links are dropped.
LOWER = Limits(0.8, 0.20, 0.10, 120, 40)
#: Outside the article that holds the page's text.
HIGHER = Limits(0.20, 0.30, 0.20, 400, 140)
ARTICLE_WEIGHT = 2  # a character of running text in an article counts as so many outside

#: Function words of the languages that pages are written in.
STOP_WORDS = frozenset(
    """a an and are as at be by for from had has have he her his if in is it its not of on or she that the their them
    there they this to was we were which will with you
    au aux avec ce ces cette dans de des du elle en est et être eux il ils je la le les leur lui mais ne nous on ou par
    pas plus pour qu que qui se ses son sur un une vous
    aber als am auch auf aus bei bin bis das dass dem den der des die doch durch ein eine einem einen einer er es für
    hat ich ihr im in ist mit nach nicht noch nur oder sich sie sind so über um und uns vom von vor war wie wir zu zum zur
    al como con del desde donde el ella ellos en era es esta este fue hay la las lo los más me mi muy no nos o para pero
    por que se si sin sobre su sus también tiene un una uno y ya""".split()
)

BLOCK_TAGS = frozenset(
    """address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section
    summary table tbody td tfoot th thead title tr ul""".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not text.
RAW_TAGS = frozenset("script style noscript template svg math iframe object canvas textarea title".split())
#: Those that end, where they are never closed, at the next block of the page.
SOFT_RAW_TAGS = frozenset("noscript template svg math object canvas".split())
#: Their content is never the article's.
BOILER_TAGS = frozenset("nav footer aside form menu button select dialog header head".split())
ARTICLE_TAGS = frozenset("article main".split())
#: Blocks of running text; those of one parent are siblings.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption".split())
#: A following tag of this name closes an open one.
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())

BOILER_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|side|footer|"
    r"foot|header|masthead|toolbar|cookies?|consent|gdpr|notices?|notification|alert|popup|modal|overlay|subscribe|"
    r"newsletter|signup|login|share|sharing|social|related|recommend\w*|trending|popular|more-?links|comments?|"
    r"commentlist|respon[ds]\w*|disqus|discussion|replies|reply|reader-?comments?|tags?|pagination|pager|copyright|"
    r"legal|disclaimer|widget|hidden|skip-?link)(?=$|[\s_-])",
    re.I,
)
#: What readers wrote, under whatever longer name.
COMMENT_NAMES = re.compile(r"comment|respon[ds]|disqus|discussion|repl(?:y|ies)", re.I)
ACQUITTED_FROM = 0.8  # share of the running text from which an element is none of what a part of its name says
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: Names of layouts and of the article's own title, which hold a boilerplate word but no boilerplate.
LAYOUT_NAMES = re.compile(r"(?:has|no|with|without|is|show|hide)[_-]|(?:article|post|entry|story)[_-](?:header|title)$", re.I)
#: What an article or main element itself is called when it is not the article.
CARD_NAMES = re.compile(
    r"(?:^|[_-])(?:ads?|adverts?|sponsor\w*|promo\w*|comments?|reply|replies|related|teaser)(?=$|[_-])", re.I
)
ARTICLE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:article(?:-?body|-?content|-?text)?|post-?(?:body|content|text)?|entry-?(?:content|body|text)?|"
    r"story-?(?:body|content|text)?|main-?(?:content|text)|content-?(?:body|main|text)?|body-?text)(?=$|[\s_-])",
    re.I,
)
BLOCK_START = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK_TAGS))})(?=[\s/>])", re.I)
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)",
    re.S,
)
#: Up to the next attribute value, the end of the tag, or what no tag holds.
TO_VALUE = re.compile(r"[^<>=]*(?:=\s*)?")
BARE_VALUE = re.compile(r"[^\s<>]*")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[^\W\d_]+")


def _only_boiler(name: str) -> bool:
    """Whether every part of a class name or id is a boilerplate word."""
    parts = [x for x in re.split("[_-]", name) if x]
    return BOILER_NAMES.fullmatch(name) is not None or all(BOILER_NAMES.fullmatch(x) for x in parts)


def _kind(name: str, rest: str, inside_article: bool) -> str:
    """What an element is to its content: 'boiler', 'suspect' (a longer name with a boilerplate word in it), 'named', 'article' or ''."""
    if name in BOILER_TAGS and not (name == "header" and inside_article):
        return "boiler"
    if rest and name not in ("body", "html"):
        at = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)}
        if "hidden" in at or at.get("aria-hidden") == "true" or at.get("role", "").lower() in BOILER_ROLES:
            return "boiler"
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", ""), re.I):
            return "boiler"
        names = [x for x in f"{at.get('class', '')} {at.get('id', '')}".split() if not LAYOUT_NAMES.match(x)]
        said = [(x, m) for x in names if (m := (CARD_NAMES if name in ARTICLE_TAGS else BOILER_NAMES).search(x))]
        if any(COMMENT_NAMES.search(x) or _only_boiler(x) for x, _ in said):
            return "boiler"
        if said:
            return "suspect"
        if name not in ARTICLE_TAGS and any(ARTICLE_NAMES.search(x) for x in names):
            return "named"
        if at.get("itemprop", "").lower() in ("articlebody", "text") or at.get("role", "").lower() in ("main", "article"):
            return "article"
    return "article" if name in ARTICLE_TAGS else ""


class Tags:
    """Ends of the tags of one page, in time that grows with the page.

    Quoted values, which begin after an equals sign, have any length. A tag that
    is not closed, or whose value is not, is text.
    """

    def __init__(self, page: str):
        self.page, self.last = page, {q: page.rfind(q) for q in "\"'"}
        self.open: set[int] = set()  # places outside values from which no tag ends

    def end(self, at: int) -> int:
        """Position of the '>' of the tag whose name ends at ``at``, or -1."""
        page, passed = self.page, []
        while at not in self.open:
            passed.append(at)
            stop = TO_VALUE.match(page, at).end()
            c = page[stop : stop + 1]
            if page[at:stop].rstrip()[-1:] == "=" and c not in ("", "<", ">"):
                if c not in self.last:
                    at = BARE_VALUE.match(page, stop).end()
                elif self.last[c] > stop:
                    at = page.find(c, stop + 1) + 1
                else:
                    break
            elif c == ">":
                return stop
            else:
                break
        self.open.update(passed)
        return -1


class Block:
    """Text, share of linked characters, what containers it is in, and its parent element's number."""

    __slots__ = ("parts", "linked", "boiler", "article", "named", "parent", "suspects", "text", "links", "stop")

    def __init__(self, boiler: bool, article: bool, named: bool, parent: int, suspects: tuple[int, ...]):
        self.parts, self.linked, self.boiler, self.article, self.named = [], 0, boiler, article, named
        self.parent, self.suspects, self.text, self.links, self.stop = parent, suspects, "", 0.0, 0.0

    def running(self) -> bool:
        return len(self.text) >= LENGTH_SHORT and self.links < LINK_DENSITY


def _judge(found: list[Block]) -> None:
    """Blocks in suspect elements are boilerplate, unless the element holds nearly all running text and no article is elsewhere."""
    clear = [b for b in found if not b.boiler and b.running()]
    total = sum(len(b.text) for b in clear)
    share: dict[int, int] = {}
    for b in clear:
        for k in b.suspects:
            share[k] = share.get(k, 0) + len(b.text)
    innocent = {
        k
        for k, n in share.items()
        if n >= ACQUITTED_FROM * total and not any((b.article or b.named) and k not in b.suspects for b in clear)
    }
    for b in found:
        b.boiler = b.boiler or any(k not in innocent for k in b.suspects)


def blocks(page: str) -> list[Block]:
    """Blocks with text in page order."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []  # open elements: (name, kind)
    parents, elements = [0], 0  # numbers of the open elements that hold blocks
    suspects: list[int] = []  # numbers of the open elements that are suspect
    depth = {"boiler": 0, "suspect": 0, "article": 0, "named": 0, "a": 0, "": 0}
    n_suspects = 0
    unclosed: set[str] = set()  # names of raw elements with no end tag further on
    current: Block | None = None
    at, end, tags = 0, len(page), Tags(page)

    def add(text: str) -> None:
        nonlocal current
        text = html.unescape(text)
        if current is None:
            if not text.strip():
                return
            current = Block(depth["boiler"] > 0, depth["article"] > 0, depth["named"] > 0, parents[-1], tuple(suspects))
            out.append(current)
        current.parts.append(text)
        if depth["a"]:
            current.linked += len("".join(text.split()))

    def close(k: int) -> None:
        while len(stack) > k:
            name, kind = stack.pop()
            depth[kind] -= 1
            if kind == "suspect":
                suspects.pop()
            depth["a"] -= name == "a"
            if name in BLOCK_TAGS and name not in TEXT_TAGS:
                parents.pop()

    while at < end:
        m = TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name, rest = (m["name"] or "").lower(), ""
        if name:
            stop = tags.end(at)
            if stop < 0:
                add(m[0])
                continue
            rest, at = page[at:stop], stop + 1
        else:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:-3]))
            continue
        if name in BLOCK_TAGS:
            current = None
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
            continue
        if name in CLOSES_ITSELF and stack and stack[-1][0] == name:
            close(len(stack) - 1)
        if name in RAW_TAGS:
            if not rest.rstrip().endswith("/"):
                stop = None if name in unclosed else re.compile(f"</{name}[^>]*>?", re.I).search(page, at)
                if stop is None:
                    unclosed.add(name)
                    begin = BLOCK_START.search(page, at) if name in SOFT_RAW_TAGS else None
                    at = begin.start() if begin else end
                else:
                    at = stop.end()
            continue
        if name in VOID_TAGS or rest.endswith("/"):
            continue
        kind = _kind(name, rest, depth["article"] > 0)
        if kind and current is not None:
            current = None  # another container begins
        stack.append((name, kind))
        depth[kind] += 1
        if kind == "suspect":
            n_suspects += 1
            suspects.append(n_suspects)
        depth["a"] += name == "a"
        if name in BLOCK_TAGS and name not in TEXT_TAGS:
            elements += 1
            parents.append(elements)
    found = []
    for b in out:
        b.text = " ".join("".join(b.parts).split())
        if b.text:
            b.links = b.linked / max(1, len(b.text) - b.text.count(" "))
            found.append(b)
    _judge(found)
    for b in found:
        if not b.boiler:
            words = WORD.findall(b.text.lower())
            b.stop = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    return found


def _clear(b: Block, limits: Limits, known: bool) -> bool | None:
    """Pass one: the label of a clear block, None for others. ``known``: the page is in a language with stop words."""
    size = len(b.text)
    if b.boiler or b.links >= limits.links:
        return False
    if size >= limits.long and (b.stop >= limits.stop_low or not known):
        return True
    if size >= limits.short and (b.stop >= limits.stop_high or b.named):
        return True
    if size >= limits.long and b.stop and limits is not LOWER:
        return False
    return None


def _near(found: list[Block], labels: list[bool | None]) -> list[int]:
    """Position of the nearest decided block before each one, on its side of the article, or -1."""
    out, last = [], {False: -1, True: -1}
    for i, b in enumerate(found):
        out.append(last[b.article])
        if labels[i] is not None:
            last[b.article] = i
    return out


def main_text(page: str) -> str:
    """Kept blocks joined by a line break; empty if none."""
    found = blocks(page)
    free = [b for b in found if not b.boiler]
    running = [b for b in free if b.running()]
    known = any(b.stop >= STOP_LOW for b in running)
    has_article = any(b.article for b in free)
    inside = sum(len(b.text) for b in running if b.article)
    leads = inside * ARTICLE_WEIGHT >= sum(len(b.text) for b in running) - inside
    limits = []
    for b in found:
        limits.append(PLAIN if not has_article or not leads else LOWER if b.article else HIGHER)
    labels = [_clear(b, x, known) for b, x in zip(found, limits, strict=True)]
    # boilerplate in the middle of the leading article says nothing of the text around it
    voting = [None if b.boiler and x is LOWER else label for b, x, label in zip(found, limits, labels, strict=True)]
    before = _near(found, voting)
    after = [len(found) - 1 - k if k >= 0 else -1 for k in reversed(_near(found[::-1], voting[::-1]))]
    kept = []
    for i, b in enumerate(found):
        label = labels[i]
        if label is None:
            near = [k for k in (before[i], after[i]) if k >= 0]
            votes = [labels[k] for k in near]
            if limits[i] is LOWER:
                label = any(votes) or not votes
            elif limits[i] is HIGHER:
                label = len(votes) == 2 and all(votes)
            elif not votes:
                label = b.named
            else:
                siblings = [labels[k] for k in near if found[k].parent == b.parent]
                label = all(votes) or any(votes) and (b.named or siblings == [True])
        if label:
            kept.append(b.text)
    return "\n".join(kept)


def extract(page: Column) -> Column:
    """Main text of ``page``; a null page has an empty one."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p) if p else "" for p in batch], dtype=object)

    return extracted(page)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    Whole pages are read and nothing is capped. Null or empty pages have an
    empty text; null ids and addresses and repeated rows stay; other columns
    are not read; an empty table gives no rows.
    """
    return pages.select("page_id", "url", extract(F.col(html_col)).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
