"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page is a row of tags and runs of words. Every word scores one, every tag below zero; how far
below is learned from labelled pages for the element's name and the words of its class, id and
role. One linear scan finds the contiguous region with the greatest sum. What elements known as
boilerplate hold inside that region, and cannot outweigh, is cut out of it by the same scores.
"""

from __future__ import annotations

import html
import math
import re
import sys
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from itertools import accumulate

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.labelled_pages import LABELLED_PAGES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?)*+)(?:>|\Z)", re.S)
_CUT_OFF = re.compile(r"\s*<[A-Za-z/!?]")
_ATTR = re.compile(r"([A-Za-z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKEN = re.compile(r"[a-z0-9]+")
# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript template svg iframe noembed noframes xmp object video audio canvas annotation annotation-xml".split())
#: Elements of RAW whose content is markup, or shown only where the element itself cannot be: without an end tag they are plain elements. The others then reach to the page's end.
MARKUP = frozenset("noscript template svg object video audio canvas annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl select table body div article section td main".split())
#: What every tag costs beside what is learned, and the learned cost from which an element is known as boilerplate.
TAG, KNOWN = -0.2, -2.5
#: While weights are learned a run of boilerplate counts as so many times its words (labels of under LABEL words once more by half), and main text as that share of its own.
BOLD, LABEL, SHY = 5.0, 5, 0.5
#: So many words for each point its tags cost let an element known as boilerplate stay.
OUTWEIGH = 4.0
#: What an element known as boilerplate costs amid main text, and the elements that may hold main text of several blocks.
CROSS, CONTAINERS = 1.0, frozenset("body div article section main td".split())
RATE, EPOCHS = 0.5, 400
#: Regions inside boilerplate that are given up one by one.
GIVE_UP = 50


@dataclass
class Run:
    """A run of text without tags inside, or (words 0) a tag."""

    text: str
    words: int = 0
    tag: str = ""
    keys: tuple[str, ...] = ()  # of a tag: its element's name, and the words of class, id and role
    pair: int = -1  # of an opening tag: where its closing tag stands, the end of the page if nowhere
    main: bool = False


def _keys(name: str, attrs: str) -> tuple[str, ...]:
    """What an element is known by: its name, the words of its class, id and role, and whether it is hidden."""
    out = ["<" + name]
    if name in ("html", "body"):
        return tuple(out)
    for key, *values in _ATTR.findall(attrs) if attrs else ():
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id", "role", "itemprop"):
            out += [t for t in _TOKEN.findall(value) if not t.isdigit()]
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            out.append("hidden")
    return tuple(dict.fromkeys(out))


def runs(page: str) -> list[Run]:
    """The tags and runs of text of a page in order; scripts, styles and comments are left out.

    An element that a later tag ends, or that is left open, is closed there.
    """
    out: list[Run] = []
    stack: list[tuple[str, int, bool]] = []
    places: defaultdict[str, list[int]] = defaultdict(list)  # where in the stack each name stands
    at, low, mains, endless = 0, None, 0, set()

    def text(part: str) -> None:
        if part:
            decoded = html.unescape(part) if "&" in part else part
            out.append(Run(decoded, len(decoded.split()), main=mains > 0))

    def opened(name: str, main: bool) -> None:
        nonlocal mains
        places[name].append(len(stack))
        stack.append((name, len(out) - 1, main))
        mains += main

    def close(first: int) -> None:
        nonlocal mains
        for name, begin, main in reversed(stack[first:]):
            out[begin].pair = len(out)
            out.append(Run("", 0, "/" + name, out[begin].keys))
            places[name].pop()
            mains -= main
        del stack[first:]

    def last(names) -> int:
        return max((places[n][-1] for n in names if places[n]), default=-1)

    while m := _TAG.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        if not m.group(2):
            continue
        name, attrs = m.group(2).lower(), m.group(3) or ""
        if m.group(1):
            if places[name]:
                close(places[name][-1])
            else:
                out.append(Run("", 0, "/" + name, ("<" + name,)))
            continue
        closing = SAME.get(name, {"p"} if name in CLOSES_P else set())
        if closing and (k := last(closing)) >= max(0, last(SCOPES)):
            close(k)
        out.append(Run("", 0, name, _keys(name, attrs)))
        empty = attrs.rstrip().endswith("/")
        if name in RAW and not (name in MARKUP and empty):
            low = page.lower() if low is None else low
            end = -1 if name in endless else low.find("</" + name, at)
            if end < 0:
                endless.add(name)  # nor has it an end further on
            if end >= 0 or name not in MARKUP:
                at = len(page) if end < 0 else end
                opened(name, False)
                continue
        if name not in VOID and not empty:
            opened(name, "data-main" in attrs)
    # A cut-off tag at the end is no text.
    text(page[at:] if not _CUT_OFF.match(page, at) else "")
    close(0)
    return out


@dataclass
class Weights:
    """What a tag costs by each key of its element; keys that were not seen cost nothing."""

    keys: dict[str, float] = field(default_factory=dict)

    def cost(self, run: Run) -> float:
        return sum(self.keys.get(k, 0.0) for k in run.keys)

    def of(self, run: Run) -> float:
        return TAG + self.cost(run) if run.tag else float(run.words)


def best_region(scores: list[float]) -> tuple[int, int]:
    """(first, past the last) of the contiguous run with the greatest sum; the shortest, first such; empty if none is positive."""
    best, region, total, begin = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, region = total, (begin, i + 1)
    return region


def learn(pages: list[str]) -> Weights:
    """Costs of tags from pages whose main elements carry ``data-main``, by a structured perceptron.

    Where the scan of a page finds another region than the marked one, the tags that only its region
    has become dearer, and those that only the marked region has cheaper, but never below nothing.
    Keys of elements that stand around main text on any page cost nothing.
    Boilerplate counts BOLD times its words meanwhile, so that longer boilerplate stays out too.
    """
    out, found, around = Weights(), [], set()
    for page in map(runs, pages):
        marked = [i for i, r in enumerate(page) if r.main and r.words]
        region = range(marked[0], marked[-1] + 1)
        around |= {k for r in page[: region.start] if r.pair >= region.stop for k in r.keys}
        found.append((page, region))
    for epoch in range(EPOCHS):
        wrong, rate = 0, RATE / (1 + 8 * epoch / EPOCHS)
        for page, marked in found:
            scores = [out.of(r) if r.tag else r.words * (SHY if r.main else BOLD if r.words >= LABEL else 1.5) for r in page]
            region = range(*best_region(scores))
            if region == marked:
                continue
            wrong += 1
            more = Counter(k for i in marked if i not in region for k in page[i].keys)
            more.subtract(k for i in region if i not in marked for k in page[i].keys)
            for k, n in more.items():
                if k not in around and n:
                    out.keys[k] = min(0.0, out.keys.get(k, 0.0) + math.copysign(rate, n))
        if not wrong:
            break
    return out


def _outer(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of nested spans, in the order of their begin, that stand in no other."""
    out: list[tuple[int, int]] = []
    for i, j in spans:
        if not out or i >= out[-1][1]:
            out.append((i, j))
    return out


def extract(page: str | None, weights: Weights) -> str:
    """Main text of a page: blocks in page order, joined by one space; '' where there is none.

    A region that stands inside an element known as boilerplate is given up, and the scan made
    again without that element's words; after GIVE_UP such regions without those of all such
    elements, so that a page takes time in proportion to its length. Around the region that is left, within the container that
    holds it, a second scan takes such elements for one tag each, so that an advert amid the text
    does not part it.
    """
    found = runs(page or "")
    scores = [weights.of(r) for r in found]
    tags, words = ([0.0, *accumulate(x)] for x in ([s if r.tag else 0.0 for r, s in zip(found, scores, strict=True)], [r.words for r in found]))
    known = [(i, r.pair + 1) for i, r in enumerate(found) if r.pair > 0 and r.tag not in INLINE and weights.cost(r) <= KNOWN]
    known = [(i, j) for i, j in known if OUTWEIGH * (tags[j] - tags[i]) + words[j] - words[i] < 0]
    for given_up in range(GIVE_UP + 2):
        first, last = best_region(scores)
        around = [(i, j) for i, j in known if i < first and last <= j]
        if not around or first == last:
            break
        for i, j in around[:1] if given_up < GIVE_UP else _outer(known):
            scores[i:j] = [min(s, 0.0) for s in scores[i:j]]
    if first == last:
        return ""
    holders = [(i, r.pair + 1) for i, r in enumerate(found[:first]) if r.tag in CONTAINERS and r.pair >= last]
    low, high = holders[-1] if holders else (0, len(found))
    crossed = [(i, j) for i, j in known if low < i and j < high]
    for i, j in _outer(crossed):
        scores[i:j] = [0.0] * (j - i)
    for i, _ in crossed:
        scores[i] = -CROSS
    first, last = (low + x for x in best_region(scores[low:high]))
    # Blocks are taken whole: no text without a block's tag between is parted from the region.
    while first > low and (not found[first - 1].tag or found[first - 1].tag.lstrip("/") in INLINE):
        first -= 1
    while last < high and (not found[last].tag or found[last].tag.lstrip("/") in INLINE):
        last += 1
    parts, skip, inside = [], 0, dict(known)
    for k in range(first, last):
        skip = max(skip, inside.get(k, 0))
        if found[k].tag:
            parts.append("" if found[k].tag.lstrip("/") in INLINE else " ")
        else:
            parts.append(found[k].text if k >= skip else " ")
    return " ".join("".join(parts).split())


def main_text(pages: DataFrame, html_col: str = "html", labelled: list[str] | None = None) -> DataFrame:
    """Every row and column of ``pages`` plus __main, the text extracted from the whole page.

    Null and empty pages, and pages without words, give the empty text. Rows are independent:
    repeated ones get equal texts, and nothing is shuffled.
    """
    weights = learn(LABELLED_PAGES if labelled is None else labelled)

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([extract(p if isinstance(p, str) else None, weights) for p in column], dtype=object)

    return pages.withColumn("__main", run(F.col(html_col)))
