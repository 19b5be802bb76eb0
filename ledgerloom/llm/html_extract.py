"""Main text of web pages: the maximum-scoring run of words and tags, with weights learned from marked pages.

A page becomes a sequence of words and tags. Words score by the place they
stand in (landmark, kind of block, inside a link or not) and tags score below
zero; one linear scan finds the contiguous region with the largest sum. Blocks
of that region which score below zero by themselves (an advert between two
paragraphs) are left out, the others are the text.

Weights are log odds from labelled pages, that is pages whose markup names
their main part (``article`` or ``main``): words inside it are content, all
others are not. They are counted over every page, and only counts per place
come to the driver (landmarks x block tags x 2, all of them fixed lists). On
pages without such markup, words outside menus and the like take the weight of
their kind of block alone. Without labelled pages default weights hold.

Null or empty html gives an empty text. Markup that is cut off or never closed
is read as far as it goes; the length and depth of pages are not limited. Where
HTML lets a closing tag be left out (items, options, cells, rows, paragraphs,
head) the next element of that kind closes the last.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = "script|style|title|textarea|xmp|iframe|noembed|noframes"
MAIN = frozenset(("article", "main"))
# Elements that neither an open list item nor an inline element reaches into from outside.
PARTS = tuple("article aside blockquote body button details dialog dl fieldset figure footer form header main menu nav ol section table td th ul".split())
# What an opening tag closes by implication, unless one of the second group stands between.
IMPLIED = {
    "li": (("li",), PARTS),
    **{t: (("dt", "dd"), PARTS) for t in ("dt", "dd")},
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
    **{t: (("caption", "td", "th"), ("table", "tr")) for t in ("td", "th")},
    "tr": (("caption", "td", "th", "tr"), ("table",)),
    **{t: (("caption", "td", "th", "tr", "tbody", "thead", "tfoot"), ("table",)) for t in ("tbody", "thead", "tfoot")},
    "body": (("head",), ()),
}
AROUND_P, AROUND_HEAD = ("button", "object", "select", "template"), ("noscript", "template")
# Elements and words in class, id or role that mark what is not main text.
ASIDE_TAGS = {t: t for t in "nav footer aside form header menu dialog".split()} | {t: "form" for t in "button select option fieldset".split()} | {t: "hidden" for t in "noscript template svg math object canvas audio video head".split()}
ASIDE_WORDS = {
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination toc skip",
    "aside": "sidebar aside share sharing social newsletter subscribe subscription",
    "related": "widget related recommended trending",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert disclaimer",
    "comments": "comment comments disqus replies respond discussion",
    "footer": "footer copyright",
    "header": "masthead topbar",
    "form": "search login signup",
}
ROLES = {word: role for role, words in ASIDE_WORDS.items() for word in words.split()}
# Words of a name that tells a state of the page (has-sidebar, share-enabled), and words that may stand beside a mark in
# a name within the main part (comment-list, but neither related-work nor search-algorithms).
STATES = frozenset("has have is no not with without enable enabled disable disabled".split())
PLAIN = frozenset("a area bar block bottom box col column container content cta entry group head hd ft heading inline inner item items left link links list main middle page post posts right section site slot small stories story tag text title top unit wide wrap wrapper".split())
# Marks that are about the page when they stand outside its main part, and mere styling within it.
OUTSIDE_ONLY = frozenset(("notice", "header", "footer", "form"))

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][\w:-]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>|<(/?)([a-zA-Z][\w:-]*)([^<>]*)>|<[!?][^>]*(?:>|\Z)|<[/a-zA-Z][^<>]*\Z""",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_WORDS = re.compile(r"[a-z]+")

# A place is (landmark, block, in a link); a token is (place or None for a tag, text, opens a new block).
Place = tuple[str, str, bool]


# Landmarks whose articles are not the page's, and elements whose articles are not (a main part in them is).
OWN_ARTICLES = frozenset(("comments", "related", "hidden"))
TEASERS = ("aside", "nav", "footer", "menu", "dialog")


def _role(tag: str, attributes: str, inside: str, teaser: bool) -> str:
    """Landmark of an element within another landmark; teaser: one of ``TEASERS`` is open."""
    if tag in MAIN and inside not in OWN_ARTICLES and not (teaser and tag == "article"):
        return "main"  # also in a form around the page, or in a wrapper with a name like content-sidebar-wrap
    if inside not in ("body", "main"):
        return inside  # what is in a menu or among comments stays there
    if tag in ASIDE_TAGS and not (tag == "header" and inside == "main"):
        return ASIDE_TAGS[tag]
    if attributes and "=" in attributes and tag not in ("body", "html"):
        for m in NAMES.finditer(attributes):
            for name in (m[1] or m[2] or m[3] or "").lower().split():
                if role := _mark(NAME_WORDS.findall(name), inside == "main"):
                    return role
    return inside


def _mark(words: list[str], within_main: bool) -> str | None:
    """What the words of one class, id or role mark, if anything."""
    marks = [ROLES[word] for word in words if word in ROLES]
    if not marks or not STATES.isdisjoint(words):
        return None
    if within_main and (marks[0] in OUTSIDE_ONLY or any(word not in ROLES and word not in PLAIN for word in words)):
        return None
    return marks[0]


def tokens(page: str) -> Iterator[tuple[Place | None, str, bool]]:
    """Tags and runs of text in page order, with the place of each run."""
    stack: list[tuple[str, str, str, int]] = []  # open elements: tag, landmark, block, links around
    open_at: dict[str, list[int]] = defaultdict(list)  # places of each tag in the stack
    landmark, block, links, at = "body", "body", 0, 0

    def last(tags: tuple[str, ...]) -> int:
        return max((open_at[t][-1] for t in tags if open_at[t]), default=-1)

    def close(tags: tuple[str, ...], around: tuple[str, ...] = ()) -> None:
        """Close the elements named (the innermost of each) and what they hold, unless they are outside of ``around``."""
        nonlocal landmark, block, links
        least = last(around)
        places = [open_at[t][-1] for t in tags if open_at[t] and open_at[t][-1] > least]
        if places:
            while len(stack) > min(places):
                open_at[stack.pop()[0]].pop()
            _, landmark, block, links = stack[-1] if stack else ("", "body", "body", 0)

    def text(raw: str) -> Iterator[tuple[Place | None, str, bool]]:
        if raw and not raw.isspace():
            yield (landmark, block, links > 0), entities.unescape(raw), False
        elif raw:
            yield (landmark, block, links > 0), " ", False

    for m in TOKEN.finditer(page):
        yield from text(page[at : m.start()])
        at = m.end()
        name = m[3] or m[6]
        if name is None:
            continue
        tag, closing, attributes = name.lower(), bool(m[2] or m[5]), m[4] or m[7] or ""
        yield None, tag, tag in BLOCKS
        if tag == "br":
            yield (landmark, block, links > 0), " ", False
        if tag in VOID or (attributes.endswith("/") and tag not in BLOCKS):
            continue
        if not closing:
            if tag in BLOCKS:
                close(("p",), AROUND_P)
                close(("head",), AROUND_HEAD)
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            landmark = _role(tag, attributes, landmark, tag == "article" and last(TEASERS) >= 0)
            block = tag if tag in BLOCKS else block
            links += tag == "a"
            open_at[tag].append(len(stack))
            stack.append((tag, landmark, block, links))
        elif tag in BLOCKS:
            close((tag,), IMPLIED[tag][1] if tag in IMPLIED else ())
        else:
            close((tag,), () if tag in ASIDE_TAGS or tag in PARTS or tag in ("html", "select") else PARTS)
    yield from text(page[at:])


def count_places(page: str, counts: Counter) -> None:
    """Add the words and tags of one labelled page: by place and by kind of block, inside and outside its main part."""
    found = list(tokens(page))
    if not any(place and place[0] == "main" for place, _, _ in found):
        return
    inside = False
    for place, text, _ in found:
        if place is None:
            counts["tag", "", False, inside] += 1
            continue
        inside = place[0] == "main"
        n = len(text.split())
        if n:
            counts[(*place, inside)] += n
            if place[0] in ("main", "body"):
                counts[("any", *place[1:], inside)] += n


class Weights:
    """Scores of words by place and of tags."""

    def __init__(self, counts: dict[tuple[str, str, bool, bool], int], most: float = 4.0, least_tag: float = 0.05):
        self.most, self.least_tag = most, least_tag
        self.odds: dict[Place, float] = {}
        for landmark, block, link in {k[:3] for k in counts}:
            inside, outside = (counts.get((landmark, block, link, x), 0) for x in (True, False))
            self.odds[landmark, block, link] = max(-most, min(most, math.log((inside + 0.5) / (outside + 0.5))))
        self.tag = -max(least_tag, min(0.5, -self.odds.get(("tag", "", False), -0.1)))

    def word(self, place: Place, marked: bool) -> float:
        """Weight of a word; marked: the page names its main part."""
        landmark, block, link = place
        if landmark == "body" and not marked:
            return self.odds.get(("any", block, link), -1.0 if link else 1.0)
        return self.odds.get(place, 1.0 if landmark == "main" else -1.0)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum above zero; the first such run, or (0, 0)."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str | None, weights: Weights) -> str:
    """The text of a page: blocks of the best region, one to a line."""
    if not page:
        return ""
    found = list(tokens(page))
    marked = any(place and place[0] == "main" for place, _, _ in found)
    scores = [weights.tag if place is None else weights.word(place, marked) * len(text.split()) for place, text, _ in found]
    start, end = best_region(scores)
    blocks: list[str] = []
    parts: list[str] = []
    total = 0.0
    for (place, text, new), score in zip(found[start:end] + [(None, "", True)], scores[start:end] + [0.0]):
        if new:
            joined = " ".join("".join(parts).split())
            if joined and total > 0:
                blocks.append(joined)
            parts, total = [], 0.0
        elif place is not None:
            # A block is kept or left out whole; words of links count, against it too.
            if score > 0 or not text.strip() or (place[2] and place[0] in ("main", "body")):
                parts.append(text)
            total += score if place[0] in ("main", "body") or score > 0 else 0.0
    return "\n".join(blocks)


def learn_weights(pages: DataFrame) -> Weights:
    """Weights from every page that is marked, counted in Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                if page.is_valid:
                    count_places(page.as_py(), counts)
        rows = [(*k, n) for k, n in counts.items()]
        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 5, (pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.int64()))], names=["landmark", "block", "link", "inside", "n"])

    partial = pages.select("html").mapInArrow(count, "landmark string, block string, link boolean, inside boolean, n bigint")
    total = partial.groupBy("landmark", "block", "link", "inside").agg(F.sum("n").alias("n"))
    return Weights({(r.landmark, r.block, r.link, r.inside): r.n for r in total.collect()})


def extract_main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text and n_chars for every page; weights are learned from ``pages`` if none are given."""
    shared = pages.sparkSession.sparkContext.broadcast(weights or learn_weights(pages))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [main_text(page.as_py(), shared.value) for page in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"]
                )

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
