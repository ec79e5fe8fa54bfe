"""Main text of web pages by tag-path ratios.

Every block of text has the path of block elements from the root to it. Per path the length outside
links and the punctuation of all its blocks are put in relation to their number; both ratios are fused,
smoothed over the page's order with a 1-2-1 kernel, averaged back to the path, and paths below a share of
the best one go. All blocks of a path that stays are kept, short ones too.

Names only weigh. Elements that name themselves as something else than the article (adverts, comments,
forms, ...) go while any other path scores next to the best of them, be they ever so long; where none does,
those stay whose path and name carry most of the page's text outside links. A class counts whole (`sidebar`,
not `has-sidebar`). Elements of FIRM, which HTML has for nothing else, always go. Where <article> or <main> carry most of what is left,
the scores of paths outside both, but for <h1>, count a quarter; where they don't, they have no say.

Defined results: null, empty and textless pages give empty text and 0 characters; unclosed and stray tags
are read as browsers do for paragraphs, items and cells; repeated rows are answered each; pages of any
length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import decoded, slices, texts
from tidewell.session import ready

SHARE = 0.1  # of the best path's score
MOST = 0.5  # of the free text: beyond it names may lose their veto, and <article> and <main> have a say
RIVAL = 0.3  # of the best score under barred names: names keep their veto while another path has as much
OUTSIDE = 0.25  # weight of paths outside <article> and <main> where these have a say

# Elements by their meaning in HTML, and words by which elements name their part of a page.
RAW = "script|style|template|noscript|textarea|iframe|svg|object|canvas|select|title"
BARRED_TAGS = frozenset("head nav header footer aside form button dialog menu label fieldset".split())
FIRM = frozenset("head nav footer button menu label".split())
BARRED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
BARRED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert"
    " comment comments disqus reply replies nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget footer foot header masthead topbar"
    " related recommended share sharing social newsletter subscribe subscription signup login popup modal overlay search form copyright pagination pager toolbar skip".split()
)
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd mark picture q ruby rb rp rt s samp small source span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "thead": "tr td th", "tbody": "tr td th thead tbody"}
CLOSES = {k: frozenset(v.split()) for k, v in CLOSES.items()}
SCOPES = frozenset("ul ol dl table article section div main body blockquote".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<svg\b[^>]*/>|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*+)>"
    r"|</?[a-zA-Z][^>]*>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
SIGNS = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


def _barred(tag: str, attrs: str) -> str:
    """By what name the element is barred; empty if it isn't."""
    if tag in BARRED_TAGS:
        return tag
    for m in NAMED.finditer(attrs) if attrs else ():
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "hidden"
        if name == "role" and value in BARRED_ROLES:
            return value
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            for word in value.split():
                if word in BARRED_WORDS:
                    return word
    return ""


def _letters(text: str) -> int:
    return sum(map(len, text.split()))


Path = tuple[tuple[str, str], ...]  # elements from the root, each with the name that bars it


def blocks(html: str) -> list[tuple[Path, str, int]]:
    """(path, text, characters in links without white space) of every block with text, in page order."""
    out: list[tuple[Path, str, int]] = []
    stack: list[tuple[str, str]] = []  # open block elements
    parts: list[str] = []
    linked = in_link = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((tuple(stack), text, linked))
        parts.clear()
        linked = 0

    def put(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                linked += _letters(text)

    for m in TOKEN.finditer(html):
        put(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not m["end"]
            elif tag == "br":
                parts.append(" ")
            continue
        flush()
        if m["end"]:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if k is not None:
                del stack[k:]
                in_link = 0
            continue
        if tag in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES[tag]:
                    del stack[k:]
                elif stack[k][0] in SCOPES:
                    break
        elif stack and stack[-1][0] == "p":
            stack.pop()  # a block ends a paragraph
        if tag not in VOID:
            stack.append((tag, _barred(tag, m["attrs"])))
    put(html[at:])
    flush()
    return out


def _free(block: tuple[Path, str, int]) -> int:
    """Characters outside links, without white space."""
    return _letters(block[1]) - block[2]


def path_scores(found: list[tuple[Path, str, int]]) -> dict[Path, float]:
    """The smoothed fused ratio of every path of the blocks."""
    sums: dict[Path, list[float]] = {}
    for block in found:
        s = sums.setdefault(block[0], [0, 0, 0])
        s[0] += 1
        free = _free(block)
        s[1] += free
        s[2] += len(SIGNS.findall(block[1])) if free else 0
    fused = {p: sqrt(length / n * (1 + signs / n)) for p, (n, length, signs) in sums.items()}
    own = [fused[b[0]] for b in found]
    smooth = [(own[max(0, k - 1)] + 2 * x + own[min(len(own) - 1, k + 1)]) / 4 for k, x in enumerate(own)]
    total: dict[Path, float] = {}
    for b, x in zip(found, smooth, strict=True):
        total[b[0]] = total.get(b[0], 0.0) + x
    return {p: x / sums[p][0] if sums[p][1] else 0.0 for p, x in total.items()}


def _not_vetoed(found: list[tuple[Path, str, int]]) -> list[tuple[Path, str, int]]:
    """The blocks in no barred element. Where the best of their paths scores next to nothing beside the best of the barred
    ones, blocks stay too whose path and name, if not in FIRM, carry most of the free text."""
    outside = [b for b in found if not any(name for _, name in b[0])]
    scores = path_scores(found)
    best = lambda some: max((scores[b[0]] for b in some), default=0.0)
    barred = [b for b in found if any(name for _, name in b[0]) and not any(tag in FIRM for tag, _ in b[0])]
    if best(outside) >= RIVAL * best(barred):
        return outside
    total, carried = 0, {}
    for block in found:
        free = _free(block)
        total += free
        for k, (_, name) in enumerate(block[0], 1):
            if name:
                carried[block[0][:k]] = carried.get(block[0][:k], 0) + free
    vetoed = {p for p, free in carried.items() if p[-1][0] in FIRM or free <= MOST * total}
    return [b for b in found if not any(name and b[0][:k] in vetoed for k, (_, name) in enumerate(b[0], 1))]


def main_text(html: str, share: float = SHARE) -> str:
    found = _not_vetoed(blocks(html))
    scores = path_scores(found)
    inside = {p for p in scores if not {"article", "main"}.isdisjoint(t for t, _ in p)}
    if sum(_free(b) for b in found if b[0] in inside) > MOST * sum(map(_free, found)):
        scores = {p: x if p in inside or p[-1:] and p[-1][0] == "h1" else OUTSIDE * x for p, x in scores.items()}
    least = share * max(scores.values(), default=0.0)
    return "\n\n".join(b[1] for b in found if scores[b[0]] >= least and scores[b[0]] > 0)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = SHARE) -> DataFrame:
    """Per row: id, url, text (the main text), n_chars (its code points)."""
    ready(pages.sparkSession)
    names = [id_col, url_col, "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found = [main_text(decoded(x), share) for x in texts(batch, "html")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names)

    kept = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").cast("binary").alias("html"))
    return kept.mapInArrow(run, f"`{id_col}` long, `{url_col}` string, text string, n_chars long")
