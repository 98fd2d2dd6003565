"""Main text of web pages from parser events and text-to-tag ratios.

A page streams through the standard library's parser once. Block-level tags cut
it into lines; each line has a ratio of text to tags, which is zero for lines in
boilerplate containers (menus, footers, forms, adverts, comments, ...). The
ratios are smoothed with a Gaussian over neighbouring lines and clustered into
low and high by the threshold that separates two means. Regions, that is an
article or main element or a run of lines outside of these, are content when
their smoothed peak lies in the high cluster, and keep all their lines. A class or
id marks boilerplate by a whole name of it, or by one with qualifiers; an article
or main element does not belong to the forms and qualified names around it. Where
nothing else is left, the lines of forms and of named wrappers are scored.

Defined results: a null or empty page, or one without text, gives an empty text;
null ids and urls are carried through; repeated rows are extracted one by one;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements and names that mark boilerplate, and how elements nest.
SILENT = frozenset("head title script style noscript template iframe object svg canvas audio video select button textarea datalist".split())
FRAMES = frozenset("nav header footer aside".split())
FORMS = frozenset("form fieldset".split())
PANELS = frozenset("dialog menu".split())
ROOTS = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
CLOSES = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disclaimer disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pagination popup promo promotion related replies reply respond share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar topbar widget".split())
QUALIFIERS = frozenset(
    "area bar block body bottom box button buttons container form global group inner item items left link links list main "
    "outer page panel post posts primary right secondary section site slot top unit wrap wrapper".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_OPEN_MARKUP = re.compile(r"<[A-Za-z/!?]")

SIGMA = 1.0  # of the smoothing, in lines
ROOT_WEIGHT = 4.0  # of lines inside an article or main element

HEADS, NONE = frozenset(["header"]), frozenset()  # a heading inside an article or main element is text

# What an open element switches.
FRAME, HARD, NAMED, ROOT, COMPOUND, FORM = range(1, 7)


def _named(value: str, exempt: frozenset) -> int:
    """NAMED where a name in a class or id is all boilerplate, COMPOUND where it also has qualifiers."""
    kind = 0
    for name in value.lower().split():
        tokens = set(name.replace("-", " ").replace("_", " ").split())
        known = (tokens & NAMES) - exempt
        if known and tokens <= NAMES:
            return NAMED
        if known and all(t in NAMES or t in QUALIFIERS or t.isdigit() for t in tokens):
            kind = COMPOUND
    return kind


class _Lines(HTMLParser):
    """Collects (text, tags, region, rooted) lines; region -1 is boilerplate, below it are runs in named wrappers and forms."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.open: list[tuple[str, int, tuple]] = []  # element, what it switches, counts that a root sets aside
        self.count = [0] * 7
        self.articles = 0
        self.text: list[str] = []
        self.tags = 0
        self.region = 0
        self.run_open = False
        self.spare = -1
        self.spare_open = False

    def _cut(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            count = self.count
            out = bool(count[HARD] or count[FRAME])
            spare = bool(count[NAMED] or count[COMPOUND] or count[FORM])
            if out or spare:
                self.run_open = False
            elif not count[ROOT] and not self.run_open:
                self.region += 1
                self.run_open = True
            if out or not spare:
                self.spare_open = False
            elif not self.spare_open:
                self.spare -= 1
                self.spare_open = True
            self.lines.append((text, self.tags, -1 if out else self.spare if spare else self.region, bool(count[ROOT])))
            self.tags = 0

    def _marked(self, tag: str, attrs: list) -> int:
        if tag in SILENT or tag in PANELS:
            return HARD
        kind = FORM if tag in FORMS else 0
        inside = self.count[ROOT]
        if tag in FRAMES:
            kind = FRAME if not (tag == "header" and inside) else 0
        named = 0
        if attrs and tag not in ("html", "body"):
            for name, value in attrs:
                if name in ("class", "id"):
                    found = _named(value, HEADS if inside else NONE) if value else 0
                    named = found if found and named != NAMED else named
                elif name == "role" and value and value.lower() in ROLES or name == "hidden" or (
                    name == "aria-hidden" and value == "true" or name == "style" and value and "display:none" in value.replace(" ", "").lower()
                ):
                    return HARD
        return FRAME if kind == FRAME and named != NAMED else named or kind

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._cut()
        if tag in VOID:
            return
        if tag in CLOSES and self.open and self.open[-1][0] in CLOSES[tag]:
            self._pop()
        kind = self._marked(tag, attrs)
        count, aside = self.count, ()
        if tag in ROOTS and not kind:
            while count[FRAME]:  # an article never belongs to an unclosed menu or header before it
                self._pop()
            kind = ROOT
            aside = count[COMPOUND], count[FORM]
            if not count[ROOT]:
                self.region += 1
                count[COMPOUND] = 0
            if not self.articles:
                count[FORM] = 0
            self.articles += tag == "article"
        self.open.append((tag, kind, aside))
        count[kind] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _pop(self) -> None:
        tag, kind, aside = self.open.pop()
        self.count[kind] -= 1
        if kind == ROOT:
            self.count[COMPOUND], self.count[FORM] = aside
            self.articles -= tag == "article"
            if not self.count[ROOT]:
                self.run_open = False

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._cut()
        if any(t == tag for t, _, _ in self.open):
            while self.open[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1][0] in SILENT):
            self.text.append(data)

    def close(self) -> None:
        if _OPEN_MARKUP.match(self.rawdata):  # a tag or comment that the page ends in is no text
            self.rawdata = ""
        super().close()
        self._cut()


def _smooth(ratios: list[float], sigma: float) -> list[float]:
    reach = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(reach + 1)]
    out, n = [], len(ratios)
    for i in range(n):
        total = weight = 0.0
        for j in range(max(0, i - reach), min(n, i + reach + 1)):
            w = kernel[abs(i - j)]
            total, weight = total + w * ratios[j], weight + w
        out.append(total / weight)
    return out


def _threshold(values: list[float]) -> float:
    """Midpoint of two means: the split of the sorted values with the least inner variance."""
    ordered = sorted(values)
    total, count = sum(ordered), len(ordered)
    best, cut, left = -1.0, ordered[0], 0.0
    for k in range(1, count):
        left += ordered[k - 1]
        if ordered[k] > ordered[k - 1]:
            between = (left / k - (total - left) / (count - k)) ** 2 * k * (count - k)
            if between > best:
                best, cut = between, (left / k + (total - left) / (count - k)) / 2
    return cut


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """Main text of one page: its content lines in page order, joined by one space."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    lines = parser.lines
    if not any(region >= 0 for _, _, region, _ in lines):  # where nothing is left, named wrappers and forms are scored
        lines = [(text, tags, -region if region < -1 else -1, rooted) for text, tags, region, rooted in lines]
    if not any(region >= 0 for _, _, region, _ in lines):
        return ""
    ratios = [
        0.0 if region < 0 else len(text) / max(tags, 1) * (ROOT_WEIGHT if rooted else 1.0)
        for text, tags, region, rooted in lines
    ]
    smooth = _smooth(ratios, sigma)
    limit = _threshold([math.log1p(x) for x in smooth])
    peaks: dict[int, float] = {}
    for (_, _, region, _), value in zip(lines, smooth, strict=True):
        if region >= 0:
            peaks[region] = max(peaks.get(region, 0.0), math.log1p(value))
    chosen = {r for r, peak in peaks.items() if peak >= limit} or {max(peaks, key=peaks.get)}
    rooted = {region for _, _, region, root in lines if root and region in chosen}
    chosen = rooted or chosen
    return " ".join(text for text, _, region, _ in lines if region in chosen)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page; a narrow pass."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h) for h in batch["html"]]
            yield pd.DataFrame({
                "page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return rows.mapInPandas(run, f"page_id {kind}, url string, text string, n_chars long")
