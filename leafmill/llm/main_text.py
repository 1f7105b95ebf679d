"""Main text of web pages as the maximum-scoring contiguous run of tokens.

A page is a sequence of tags and text pieces. Words score positive and tags negative; how much depends on where they
stand (menu link, advert box, paragraph, ...), with weights fitted on pages that label themselves by an article or main
element, on top of fixed prior weights. A linear scan finds the run with the highest sum; its text, without what
stands in menus, forms, adverts and the like inside it, is the main text.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+)""")
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)""")
_HIDDEN = re.compile(r"(?i)(?:^|[\s\"])hidden(?:[\s=/\"]|$)")
_FORM = re.compile(r"(?i)<form[\s/>]")
_NAME_PART = re.compile(r"[a-z]+")

# HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes".split())
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
ALIKE = {x: frozenset(g.split()) for g in ("li", "dt dd", "td th", "tr", "option", "thead tbody tfoot") for x in g.split()}
SCOPE = frozenset("ul ol dl table article main section body html div aside nav header footer form".split())
# Elements, roles and words in class or id that mark what is never main text.
DROP = frozenset(
    "head nav footer aside menu dialog button select option input svg math canvas audio video object map datalist".split()
) | RAW
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
DROP_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies dialog disqus disclaimer footer footers gdpr header login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification pager pagination paywall popup promo promos promotion recommended related replies "
    "respond search share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe toolbar topbar "
    "widget widgets".split()
)
_CONTENT = frozenset("article main".split())
# What may stand in a head; any other tag ends it, as does text.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript object script style template title".split())
_ABOUT = frozenset("with without has no".split())


class _Element:
    __slots__ = ("drop", "inside", "label", "tag")

    def __init__(self, tag: str, drop: bool, inside: bool, label: str):
        self.tag, self.drop, self.inside, self.label = tag, drop, inside, label


def _open(tag: str, attributes: str, parent: _Element, wraps: bool) -> _Element:
    """The element with its context: dropped or not, inside a labelled element, label of the nearest named container.

    A form that wraps most of the page is no reason to drop.
    """
    label, drop = "", tag in DROP or (tag == "form" and not wraps)
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id") and tag not in ("body", "html"):
                parts = _NAME_PART.findall(value)
                bad = next((x for x in parts if x in DROP_NAMES and not (x == "header" and parent.inside)), "")
                if _ABOUT.intersection(parts):  # with-sidebar and the like tell of others
                    bad = ""
                if bad and tag not in _CONTENT | {"h1"}:
                    label, drop = f".{bad}", True
                elif parts and not label and name == "class":
                    label = f".{parts[0][:20]}"
            elif name == "role" and value in DROP_ROLES and not (wraps and value == "form"):
                label, drop = f"@{value}", True
            elif name == "aria-hidden" and value == "true":
                drop = True
        if _HIDDEN.search(_QUOTED.sub('""', attributes)):
            drop = True
    if tag == "header" and not parent.inside:
        drop = True
    inside = parent.inside or (tag in _CONTENT and not parent.drop)
    if tag in INLINE and not label:
        label = parent.label
    elif tag in SCOPE or label:
        label = tag + label
    else:
        label = parent.label
    return _Element(tag, drop or parent.drop, inside, label)


def _wrapping_forms(page: str) -> frozenset[int]:
    """Which forms of the page, by their numbers, hold more than half of its words that nothing else drops."""
    total, n, form, held = 0, 0, None, defaultdict(int)
    for feature, text, _, dropped, _ in _scan(page, None):
        if text:
            if not dropped:
                count = len(text.split())
                total += count
                held[form] += count
        elif feature[2:7] == "form ":
            n, form = n + 1, n
        elif feature[2:8] == "/form ":
            form = None
    return frozenset(f for f, count in held.items() if f is not None and 2 * count > total)


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool, bool]]:
    """As _scan, with forms dropped unless they wrap most of the page."""
    return _scan(page, _wrapping_forms(page) if _FORM.search(page) else frozenset())


def _scan(page: str, wrapping: frozenset[int] | None) -> Iterator[tuple[str, str, bool, bool, bool]]:
    """(feature, text, breaks a block, dropped, inside a labelled element) per tag (empty text) and text piece.

    The opening tag of an element that is dropped as a whole has a feature of its own kind, d. wrapping: numbers of the
    forms that are not dropped, None for all.
    """
    stack = [_Element("", False, False, "")]
    at, block, link, last, forms = 0, "", 0, page.rfind(">") + 1, 0

    def piece(text: str) -> Iterator[tuple[str, str, bool, bool, bool]]:
        if text:
            top = stack[-1]
            yield f"w {block} {top.label} {'a' if link else ''}", text, False, top.drop, top.inside

    def leave_head() -> None:
        """End a head that was not closed: nothing that a head may hold is open above it."""
        if stack[-1].tag == "head":
            stack.pop()

    while m := _TAG.search(page, at, last):
        if stack[-1].tag == "head" and page[at : m.start()].strip():
            leave_head()
        yield from piece(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)
            continue
        tag, closing, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        top = stack[-1]
        if closing:
            depth = len(stack) - 1
            while depth > 0 and stack[depth].tag != tag:
                if tag in INLINE and stack[depth].tag in SCOPE:
                    depth = 0
                    break
                depth -= 1
            if depth > 0:
                top = stack[depth]
                del stack[depth:]
            yield f"t /{tag} {top.label}", "", tag not in INLINE, top.drop, top.inside and tag not in _CONTENT
        else:
            if tag not in _IN_HEAD:
                leave_head()
            if tag in ENDS_P or tag in ALIKE:
                same = ALIKE.get(tag, ("p",))
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag in same:
                        del stack[depth:]
                        break
                    if stack[depth].tag in SCOPE:
                        break
            parent = stack[-1]
            wraps = tag == "form" and (wrapping is None or forms in wrapping)
            forms += tag == "form"
            element = _open(tag, attributes, parent, wraps)
            kind = "d" if element.drop and not parent.drop else "t"
            yield f"{kind} {tag} {element.label}", "", tag not in INLINE, element.drop, parent.inside
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif tag not in VOID and not attributes.endswith("/"):
                stack.append(element)
            elif tag not in VOID and tag in INLINE:
                stack.append(element)
        block = next((e.tag for e in reversed(stack) if e.tag not in INLINE), "")
        link = any(e.tag == "a" for e in stack[-4:])
    if stack[-1].tag == "head" and page[at:].strip():
        leave_head()
    yield from piece(page[at:])


def prior(feature: str) -> float:
    """Weight of a word or tag before any labelled page is seen."""
    kind, name, *_ = feature.split(" ")
    if kind == "w":
        return -0.3 if feature.endswith(" a") else 1.0
    if name.lstrip("/") in _CONTENT:
        return -6.0
    return -0.2 if name.lstrip("/") in INLINE or name in ("p", "/p", "br") else -0.8


def weight(feature: str, dropped: bool, inside: bool, weights: dict[str, float]) -> float:
    """Weight of a token. An element that is dropped counts once, and not at all inside a labelled element: it is left out
    of the text anyway, and scripts or a form in an article must not cut it in two.
    """
    if dropped:
        return 0.0 if feature[0] != "d" or inside else -3.0
    w = weights.get(feature)
    return prior(feature) if w is None else w


def main_text(page: str, weights: dict[str, float]) -> str:
    """The text of the best run; empty if no run has a positive sum."""
    items, best, low, low_at, total, span = list(tokens(page)), 0.0, 0.0, 0, 0.0, (0, 0)
    for i, (feature, text, _, dropped, inside) in enumerate(items):
        total += weight(feature, dropped, inside, weights) * (len(text.split()) if text else 1)
        if total - low > best:
            best, span = total - low, (low_at, i + 1)
        if total < low:
            low, low_at = total, i + 1
    out = []
    for _, text, breaks, dropped, _ in items[slice(*span)]:
        if breaks:
            out.append(" ")
        elif not dropped:
            out.append(html.unescape(text) if "&" in text else text)
    return " ".join("".join(out).split())


def fit(pages: DataFrame, most_pages: int = 10_000, least: int = 50, prior_count: float = 20.0) -> dict[str, float]:
    """Weights per feature from pages with an article or main element, which label their words and tags.

    A seeded sample of about most_pages pages is used, whatever the size of the table. A weight is the log odds of standing
    inside, between -6 and 6, blended with the prior weight as if that had been seen prior_count times; words that
    stand inside stay positive and tags negative. Features seen fewer than least times keep the prior.
    """
    share = most_pages / max(pages.count(), 1)
    chance = F.xxhash64(F.lit(5), "page_id", "url").bitwiseAND((1 << 30) - 1) / float(1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = defaultdict(lambda: [0, 0])
        for batch in batches:
            for page in batch.column("html").to_pylist():
                found = list(tokens(page))
                if not any(x[4] for x in found):
                    continue
                for feature, text, _, dropped, inside in found:
                    if not dropped:
                        counts[feature][0 if inside else 1] += len(text.split()) if text else 1
        names = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([counts[f][k] for f in names], pa.int64()) for k in range(2)]],
            ["feature", "inside", "outside"],
        )

    seen = (
        pages.where((chance < share) & F.col("html").isNotNull())
        .select("html")
        .mapInArrow(run, "feature string, inside long, outside long")
        .groupBy("feature")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .where(F.col("inside") + F.col("outside") >= least)
        .collect()  # features of a sample of fixed size
    )
    inside, outside = (max(1, sum(r[k] for r in seen if r.feature[0] == "w")) for k in (1, 2))
    weights = {}
    for r in seen:
        odds = math.log((r.inside / inside + 1e-6) / (r.outside / outside + 1e-6))
        n = r.inside + r.outside
        w = (max(-6.0, min(6.0, odds)) * n + prior(r.feature) * prior_count) / (n + prior_count)
        if r.feature[0] == "t":
            w = min(w, -0.1)
        elif r.inside > r.outside:
            w = max(w, 0.3)
        weights[r.feature] = w
    return weights


def extract(pages: DataFrame, weights: dict[str, float] | None = None, **training: float) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of pages (page_id, url, html).

    weights: from fit(), by default fitted on the same pages. A null or empty html, and a page without words, give an
    empty text. Repeated rows give repeated results, an empty table none; other columns are ignored.
    """
    weights = fit(pages, **training) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(p, weights) if p else "" for p in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(map(len, text), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
