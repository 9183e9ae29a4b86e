"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the path of open tags from the root to it. Per path, text length
and punctuation are summed over the page and divided by the number of blocks and by the share of the text that
stand in links; both ratios are smoothed over the neighbouring paths in page order and fused by their product.
The fused ratio times the path's weight decides on every page: a path is content from a share of the mean fused
ratio upwards. Weights: inside a marked article ARTICLE; outside of one, where the page marks any, OUTSIDE; under
a boilerplate name (adverts, comments ...) or in a form NAMED, unless that wrapper holds most of the page's unlinked text: then
its name counts for nothing, or for OUTSIDE if the page's articles are elsewhere. Paths through elements that
never hold an article (navigation, footers, scripts ...) and through hidden ones take part with ratio 0.

Defined results: a null or empty page has an empty text. Broken markup is read as browsers do where that
matters here: an unclosed comment, script or style runs to the end, an unknown end tag is ignored, a new
paragraph closes an open one. Repeated rows give a text each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SMOOTH = (0.25, 0.5, 0.25)
THRESHOLD = 0.35  # of the page's mean fused ratio
ARTICLE, OUTSIDE, NAMED = 4.0, 0.25, 1 / 32

TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "svg", "select", "option", "button", "object", "canvas")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset("head title nav footer aside menu dialog address figcaption header".split()) | frozenset(RAW)
NAMED_AS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo|nav|navbar|navigation|menu|"
    r"breadcrumbs?|sidebar|side-bar|header|masthead|footer|cookies?|consent|notice|newsletter|subscribe|signup|login|"
    r"comments?|comment-list|replies|disqus|related|recommend(?:ed|ations)?|share|sharing|social|widget|popup|modal|"
    r"toolbar|pagination|pager|copyright|legal|skip-link)(?:$|[\s_-]|s\b)",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")
SPACE = re.compile(r"\s+")


def _attributes(source: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(source)} if "=" in source or "hidden" in source else {}


def _boilerplate(tag: str, source: str, inside_article: bool) -> float | None:
    """The weight of what stands in this element, if it says that it is boilerplate."""
    if tag == "form":
        return NAMED
    if tag in NEVER:
        return None if tag == "header" and inside_article else 0.0
    if not source.strip() or tag in ("html", "body", "article", "main"):
        return None
    found = _attributes(source)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return 0.0
    named = f"{found.get('class', '')} {found.get('id', '')}"
    return NAMED if found.get("role", "").lower() in ROLES or NAMED_AS.search(named.strip()) else None


class Block:
    __slots__ = ("path", "text", "linked", "wrapper", "marked", "weight")

    def __init__(self, path: str, text: str, linked: int, wrapper: int, marked: bool):
        self.path, self.text, self.linked, self.wrapper, self.marked = path, text, linked, wrapper, marked
        self.weight = 1.0


def text_blocks(page: str) -> list[Block]:
    """The page's blocks in order, weighted. A block ends at every tag that isn't inline."""
    stack: list[tuple[str, int, bool]] = []  # tag, innermost boilerplate wrapper, within an article
    wrappers: list[tuple[int, float]] = [(-1, 1.0)]  # the wrapper around it, weight; the first is the page
    blocks: list[Block] = []
    parts: list[str] = []
    state = {"linked": 0, "start": None}

    def flush() -> None:
        text = SPACE.sub(" ", "".join(parts)).strip()
        if text:
            path, wrapper, marked = state["start"]
            blocks.append(Block(path, text, state["linked"], wrapper, marked))
        parts.clear()
        state.update(linked=0, start=None)

    def say(raw: str) -> None:
        if not raw:
            return
        text = html.unescape(raw)
        if state["start"] is None and text.strip():
            solid = [s for s in stack if s[0] not in INLINE]
            state["start"] = ("/".join(s[0] for s in solid), stack[-1][1] if stack else 0, bool(stack and stack[-1][2]))
        if any(s[0] == "a" for s in stack):
            state["linked"] += len(text.strip())
        parts.append(text)

    at, size = 0, len(page)
    while at < size:
        token = TOKEN.search(page, at)
        if not token:
            say(page[at:])
            break
        say(page[at : token.start()])
        at = token.end()
        tag = (token.group(2) or "").lower()
        if not tag:
            continue
        if token.group(1):
            if any(s[0] == tag for s in stack):
                if tag not in INLINE:
                    flush()
                while stack and stack.pop()[0] != tag:
                    pass
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID or token.group(3).endswith("/") and tag in ("path", "rect", "circle"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in CLOSES:
            # An open inline element of the block that is closed here ends with it.
            solid = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), None)
            if solid is not None and stack[solid][0] in CLOSES[tag]:
                del stack[solid:]
        wrapper, marked = (stack[-1][1], stack[-1][2]) if stack else (0, False)
        weight = _boilerplate(tag, token.group(3), marked)
        if weight is not None:
            wrappers.append((wrapper, weight))
            wrapper = len(wrappers) - 1
        stack.append((tag, wrapper, marked or tag in ("article", "main")))
    flush()
    _weigh(blocks, wrappers)
    return blocks


def _weigh(blocks: list[Block], wrappers: list[tuple[int, float]]) -> None:
    """Set the blocks' weights. A wrapper comes behind the one around it."""
    silent = [False] * len(wrappers)  # in an element of weight 0
    for i, (around, weight) in enumerate(wrappers):
        silent[i] = weight == 0 or i > 0 and silent[around]
    unlinked, holds = [0] * len(wrappers), [False] * len(wrappers)
    for b in blocks:
        if not silent[b.wrapper]:
            unlinked[b.wrapper] += max(len(b.text) - b.linked, 0)
            holds[b.wrapper] |= b.marked
    for i in range(len(wrappers) - 1, 0, -1):
        unlinked[wrappers[i][0]] += unlinked[i]
        holds[wrappers[i][0]] |= holds[i]
    most = [2 * n > unlinked[0] for n in unlinked]
    # Articles count if no wrapper around them is boilerplate.
    clear = [True] * len(wrappers)
    for i in range(1, len(wrappers)):
        clear[i] = clear[wrappers[i][0]] and not silent[i] and most[i]
    has_article = any(b.marked and clear[b.wrapper] for b in blocks)
    weights = [1.0] * len(wrappers)
    for i, (around, weight) in enumerate(wrappers[1:], 1):
        if weight and most[i]:
            weight = 1.0 if holds[i] or not has_article else OUTSIDE
        weights[i] = min(weights[around], weight)
    for b in blocks:
        b.weight = weights[b.wrapper] * (1.0 if not has_article else ARTICLE if b.marked else OUTSIDE)


def path_ratios(blocks: list[Block]) -> dict[tuple[str, float], float]:
    """Fused, smoothed ratio per path and weight, before the weight."""
    sums: dict[tuple[str, float], list[float]] = {}
    for b in blocks:
        row = sums.setdefault((b.path, b.weight), [0.0, 0.0, 0.0, 0.0])
        if b.weight:
            row[0] += len(b.text)
            row[1] += len(PUNCTUATION.findall(b.text))
            row[3] += b.linked
        row[2] += 1
    names = list(sums)
    lengths = [(s[0] - s[3]) / s[2] for s in sums.values()]
    points = [s[1] / s[2] for s in sums.values()]

    def smooth(values: list[float]) -> list[float]:
        return [
            sum(w * values[min(max(i + d, 0), len(values) - 1)] for w, d in zip(SMOOTH, (-1, 0, 1))) for i in range(len(values))
        ]

    fused = zip(names, smooth(lengths), smooth(points))
    return {n: length * (1 + point) if n[1] else 0.0 for n, length, point in fused}


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    blocks = text_blocks(page or "")
    if not blocks:
        return ""
    ratios = path_ratios(blocks)
    least = threshold * sum(ratios.values()) / len(ratios)
    kept = [b.text for b in blocks if b.weight and b.weight * ratios[b.path, b.weight] >= least]
    return "\n".join(kept)


@F.pandas_udf(StringType())
def _extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(page) for page in pages], dtype=object)


def extract_text(page: Column) -> Column:
    """The main text of a page; empty if it has none."""
    return _extract(page.cast("string"))
