"""Main text of web pages by the best scoring contiguous run of words and tags.

A page is cut into tags and texts. Elements that are boilerplate by their tag or by a whole name in
class, id or role (menus, forms, scripts, adverts, reader comments and the like) are left out with
all they hold. Outside article and main elements, one whose names only have such a word as a part
(``has-sidebar``) stays, but its words score ``LOWER`` as much; and where no article or main holds
the best run, an element that is so named, wholly or in part, counts as any other if its own best
run lowered alike is above the page's. Headings are never judged by their names. In what remains every word scores above zero and every tag below, and one pass finds the run
with the highest sum; a heading right before it is taken in. If most of its words stand in one
article or main element, that whole element is the run. Its blocks are then written one by one.

The weights come from labelled pages: pages whose article element marks the content. A weight
is the log of how much more often words or a tag stand inside the article than outside, kept to
its sign. They are counted over a bounded sample of some ``SAMPLE_PAGES`` such pages; a page
without an article is not learned from, and without any the ``PLAIN`` weights hold.

Every step goes over a page's tokens once, and elements are scored from the inside out without
recursion, so nested, unclosed and repeated markup costs no more than other markup.

Defined results: null and empty pages have an empty text; unclosed elements end where their
parent ends, and an unclosed boilerplate element hides only its own tag; markup cut off at the
end of a page is text; very long pages are read whole; of equally good runs the first counts; repeated
rows give the same text; an empty table gives no rows. All columns come back but ones named ``text``
or ``n_chars``, which are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from math import log

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickflow.llm.common import table, text_batches

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>", re.S)
UNQUOTED = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template", "xmp"}
RAW_END = {name: re.compile(rf"</{name}\b[^>]*>|\Z", re.I) for name in RAW}
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "svg", "canvas", "object", "dialog",
           "menu"}
CONTENT = ("article", "main")
BLOCKS = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
             "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary "
             "table tbody tfoot thead tr ul".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SPACES = {"br", "td", "th", "img", "wbr"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = set(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment commentlist "
    "comments consent contentinfo cookie cookies copyright dialog disclaimer disqus footer gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination "
    "popup promo promotion related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe toolbar widget".split())
FULL_NAMES = set(
    "ad-banner ad-container ad-slot ad-unit ad-wrapper comment-form comment-list comments-area comments-list "
    "comments-section cookie-banner cookie-bar cookie-consent cookie-notice main-menu main-nav nav-bar "
    "nav-menu newsletter-form newsletter-signup popup-overlay post-comments post-navigation promo-box "
    "related-articles related-links related-posts related-stories search-box search-form share-bar "
    "share-buttons share-links side-bar site-footer site-header site-navigation skip-link social-buttons "
    "social-icons social-links social-media social-share sponsored-content sponsored-links subscribe-form "
    "top-nav widget-area".split())
LOWER = 0.3
PLAIN = {"": 1.0, "a": 0.1}  # a word, a word in a link
PLAIN_TAG = -2.0
SAMPLE_PAGES, MOST_TAGS = 2000, 500
LEAST_WEIGHT = 0.02


def tokens(page: str) -> list[tuple]:
    """``(kind, name, text)``: kind 1 opens, -1 closes, 0 is text; text of a tag: its attributes.

    After a tag whose quotes are never closed, tags end at the next ``>`` whatever the quotes say; what
    comes after the page's last ``>`` holds no tag. So no part of a page is searched again and again.
    """
    found, at, start, pattern, last = [], 0, 0, TOKEN, page.rfind(">")
    while True:
        at = page.find("<", at)
        if at < 0 or at > last:
            comment = page.find("<!--", at) if at >= 0 else -1
            rest = page[start:comment if comment >= 0 else len(page)]
            return [*found, (0, "", rest)] if rest else found
        tag = pattern.match(page, at)
        if tag is None:
            if pattern is TOKEN and page[at + 1:at + 3].lstrip("/")[:1].isalpha():
                pattern = UNQUOTED
            else:
                at += 1
            continue
        if at > start:
            found.append((0, "", page[start:at]))
        start = at = tag.end()
        if not tag[2]:
            continue
        name = tag[2].lower()
        if tag[1]:
            found.append((-1, name, ""))
        elif name in RAW:
            start = at = RAW_END[name].search(page, at).end() if at <= last else len(page)
        else:
            found.append((1, name, tag[3]))


def closings(found: list[tuple]) -> dict[int, int]:
    """For each opening tag the place of the closing tag that belongs to it, where there is one."""
    open_tags: dict[str, list[int]] = {}
    ends = {}
    for k, (kind, name, _) in enumerate(found):
        if kind == 1 and name not in VOID:
            open_tags.setdefault(name, []).append(k)
        elif kind == -1 and open_tags.get(name):
            ends[open_tags[name].pop()] = k
    return ends


def content_spans(found: list[tuple], ends: dict[int, int]) -> list[tuple[int, int]]:
    """Places of the article and main elements; one that is never closed reaches to the end."""
    return [(k, ends.get(k, len(found))) for k, (kind, name, _) in enumerate(found)
            if kind == 1 and name in CONTENT]


def is_boilerplate(name: str, attributes: str, inside: bool) -> str:
    """By what an element is boilerplate: its tag, a name, part of a name, or nothing (``""``)."""
    if name in DROPPED or name == "header" and not inside:
        return "tag"
    if name in ("html", "body", *CONTENT) or name in HEADINGS or not attributes:
        return ""
    names = {n for value in NAMES.findall(attributes) for n in value.strip("\"'").lower().split()}
    if not names.isdisjoint(BOILERPLATE) or not names.isdisjoint(FULL_NAMES):
        return "name"
    if inside:
        return ""
    return "" if BOILERPLATE.isdisjoint(w for n in names for w in re.split(r"[^a-z0-9]+", n)) else "part"


class Page:
    """A page's tokens, and what each element is by its names; all of it found in one pass each."""

    def __init__(self, page: str):
        self.found = found = tokens(page)
        self.ends = closings(found)
        self.content = content_spans(found, self.ends)
        change = [0] * (len(found) + 2)
        for start, end in self.content:
            change[start + 1] += 1
            change[min(end, len(found))] -= 1
        self.starts = [start for start, _ in self.content]
        least = [len(found) + 1]  # the first end among the content from each place on
        for _, end in reversed(self.content):
            least.append(min(least[-1], end))
        self.first_end = least[::-1]
        self.next_block = [len(found)] * (len(found) + 1)
        for k in range(len(found) - 1, -1, -1):
            self.next_block[k] = k if found[k][1] in BLOCKS else self.next_block[k + 1]
        self.hidden: dict[int, tuple[str, int, bool]] = {}  # by what, up to where, and whether inside
        inside = 0
        for k, (kind, name, attributes) in enumerate(found):
            inside += change[k]
            if kind == 1 and name not in VOID:
                by = is_boilerplate(name, attributes, inside > 0)
                end = self._end(k, name) if by else None
                if end is not None and not (by != "tag" and self.holds_content(k, end)):
                    self.hidden[k] = by, end, inside > 0

    def _end(self, k: int, name: str) -> int | None:
        end = self.ends.get(k)
        if end is None and name in ("p", "li"):
            block = self.next_block[k + 1]
            end = block - 1 if block < len(self.found) else block
        return end

    def holds_content(self, start: int, end: int) -> bool:
        """Whether a whole article or main element is inside."""
        return self.first_end[bisect_right(self.starts, start)] < end

    def remaining(self, free: set[int] = frozenset()) -> tuple[list[int], set[int]]:
        """Places of the tokens outside boilerplate elements, without ``free`` ones, and those of
        them that are lowered."""
        kept, low, k, low_end = [], set(), 0, -1
        while k < len(self.found):
            by, end, _ = self.hidden.get(k, NOT_HIDDEN) if k not in free else NOT_HIDDEN
            if by in ("tag", "name"):
                k = max(k, end) + 1
                continue
            if by:
                low_end = max(low_end, end)
            kept.append(k)
            if k <= low_end:
                low.add(k)
            k += 1
        return kept, low

    def best_named(self, weights: dict[str, float], free: set[int]) -> tuple[float, list[int]]:
        """The highest score of the best run of an element that its names hide or lower, outside the
        content, and the named elements around that run, from the outside in.

        An element's words score in full for itself. What is named inside it counts ``LOWER`` as much:
        it is part of the element's own run where only a part of its name says so, and competes with
        it in any case. Elements are finished from the inside out, each with the sum and the best
        start, end and run of what it holds.
        """
        found, stack, links, k = self.found, [Holds(len(self.found), -1, "")], 0, 0
        while k <= len(found):
            while len(stack) > 1 and (k > stack[-1].end or k == len(found)):
                stack[-2].take(stack.pop())
            if k == len(found):
                break
            by, end, inside = self.hidden.get(k, NOT_HIDDEN) if k not in free else NOT_HIDDEN
            if by == "tag" or by == "name" and inside:
                k = max(k, end) + 1
                continue
            if by:
                stack.append(Holds(min(end, stack[-1].end), k, by))
            kind, name, text = found[k]
            if kind:
                links = max(0, links + kind) if name == "a" else links
                score = lowered = weights.get("<" + name, PLAIN_TAG)
            else:
                score = len(text.split()) * weights["a" if links else ""]
                lowered = score * LOWER
            stack[-1].add(score, lowered)
            k += 1
        path, best = [], stack[0].rival
        while best is not None:
            path.append(best.start)
            best = best.rival if best.rival is not None and LOWER * best.rival.own > best.full[3] else None
        return (stack[0].rival.own if stack[0].rival is not None else 0.0), path


NOT_HIDDEN = ("", -1, False)
NOTHING = (0.0, 0.0, 0.0, 0.0)


def _after(one: tuple, other: tuple) -> tuple:
    """Sum, best start, best end and best run of two stretches, one after the other."""
    return (one[0] + other[0], max(one[1], one[0] + other[1]), max(other[2], other[0] + one[2]),
            max(one[3], other[3], one[2] + other[1]))


class Holds:
    """What an element holds so far, with its words in full and lowered, and its best named element."""

    def __init__(self, end: int, start: int, by: str):
        self.end, self.start, self.by = end, start, by
        self.full = self.low = NOTHING
        self.rival: Holds | None = None
        self.own = 0.0

    def add(self, score: float, lowered: float) -> None:
        self.full = _after(self.full, (score, max(score, 0.0), max(score, 0.0), max(score, 0.0)))
        self.low = _after(self.low, (lowered, max(lowered, 0.0), max(lowered, 0.0), max(lowered, 0.0)))

    def take(self, inner: Holds) -> None:
        """An element inside has ended."""
        inner.own = max(inner.full[3], LOWER * inner.rival.own if inner.rival is not None else 0.0)
        if inner.by == "part":
            self.full, self.low = _after(self.full, inner.low), _after(self.low, inner.low)
        for rival in (inner, inner.rival if inner.by == "part" else None):
            if rival is not None and (self.rival is None or rival.own > self.rival.own):
                self.rival = rival


def scored(found: list[tuple], kept: list[int], low: set[int], weights: dict[str, float]) -> tuple[list, list]:
    """Score and number of words of each kept token."""
    scores, sizes, links = [], [], 0
    for k in kept:
        kind, name, text = found[k]
        if kind:
            links = max(0, links + kind) if name == "a" else links
            scores.append(weights.get("<" + name, PLAIN_TAG))
            sizes.append(0)
        else:
            sizes.append(len(text.split()))
            scores.append(sizes[-1] * weights["a" if links else ""] * (LOWER if k in low else 1))
    return scores, sizes


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last place (exclusive) of the run with the highest sum."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, span = total, (start, k + 1)
    return span


def heading_before(found: list[tuple], kept: list[int], sizes: list[int], first: int) -> int:
    """The start of the heading right before the run, which its few words could not reach."""
    at = first - 1
    while at >= 0 and not sizes[at] and found[kept[at]][1] not in HEADINGS:
        at -= 1
    if at < 0 or found[kept[at]][0] != -1:
        return first
    start = at - 1
    while start >= 0 and found[kept[start]][1] != found[kept[at]][1]:
        start -= 1
    return start if start >= 0 and found[kept[start]][0] == 1 else first


def extract(text: str | None, weights: dict[str, float]) -> str:
    """The page's main text."""
    page = Page(text or "")
    found, free = page.found, set()
    while True:
        kept, low = page.remaining(free)
        scores, sizes = scored(found, kept, low, weights)
        first, last = best_run(scores)
        before = list(accumulate(sizes, initial=0))
        words = before[last] - before[first]
        main = None  # the smallest article or main element that holds most of the run
        for start, end in sorted(page.content, key=lambda span: span[1] - span[0]):
            a, b = bisect_right(kept, start), bisect_left(kept, end)
            if words and before[max(a, min(b, last))] - before[max(a, first)] > words / 2:
                main = a, b
                break
        best, path = page.best_named(weights, free) if main is None else (0.0, [])
        if LOWER * best <= sum(scores[first:last]) or free.issuperset(path):
            break
        free.update(path)
    if main is not None:
        first, last = main
    elif words:
        first = heading_before(found, kept, sizes, first)
    blocks, block = [], []
    for k in kept[first:last]:
        kind, name, text = found[k]
        if kind == 0:
            block.append(text)
        elif name in BLOCKS:
            blocks.append(block)
            block = []
        elif name in SPACES:
            block.append(" ")
    texts = (" ".join(unescape("".join(b)).split()) for b in [*blocks, block])
    return "\n\n".join(t for t in texts if t)


def count_page(text: str) -> Counter:
    """How often words and tags stand inside and outside the page's article, outside of boilerplate."""
    page = Page(text)
    content = [span for span in page.content if page.found[span[0]][1] == "article"]
    counts: Counter = Counter()
    if len(content) != 1:
        return counts
    start, end = content[0]
    links = 0
    for k in page.remaining()[0]:
        if k in (start, end):
            continue
        kind, name, text = page.found[k]
        if kind:
            links = max(0, links + kind) if name == "a" else links
            counts["<" + name, start < k < end] += 1
        else:
            counts["a" if links else "", start < k < end] += len(text.split())
    return counts


def learned_weights(pages: DataFrame, sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights for words (``""``, in links ``"a"``) and tags (``"<name"``) from labelled pages; of tags
    those of the ``MOST_TAGS`` names seen most often."""
    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for part in parts:
            for page in part["html"]:
                total.update(count_page(page))
        yield pd.DataFrame([(kind, inside, n) for (kind, inside), n in total.items()],
                           columns=["kind", "inside", "n"])

    marked = pages.select("html").where(F.lower("html").contains("<article"))
    share = min(1.0, sample / max(1, marked.count()))
    some = marked.where(F.pmod(F.xxhash64("html"), F.lit(1_000_000)) < int(1_000_000 * share) + 1)
    sums = some.mapInPandas(counted, "kind string, inside boolean, n bigint").groupBy("kind").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"),
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("outside")) \
        .orderBy(F.desc(F.col("inside") + F.col("outside")), "kind").limit(MOST_TAGS).collect()
    weights = dict(PLAIN)
    for kind, inside, outside in sums:
        odds = log((inside + 1) / (outside + 1))
        weights[kind] = min(odds, -LEAST_WEIGHT) if kind.startswith("<") else max(odds, LEAST_WEIGHT)
    return weights


def extracted(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Every page with ``text`` and ``n_chars``."""
    text_batches(pages.sparkSession)
    weights = learned_weights(pages) if weights is None else weights

    @F.pandas_udf("string")
    def main_text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in parts:
            yield pd.Series([extract(page, weights) for page in html], dtype=object)

    found = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("row"), main_text("html").alias("text"))
    return found.select(*[F.col("row")[c].alias(c) for c in pages.columns if c.lower() not in ("text", "n_chars")],
                        "text", F.length("text").cast("bigint").alias("n_chars"))


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages").select("page_id", "url", "html")).drop("html")
