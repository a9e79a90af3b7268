"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements whose content is no text, those without an end tag, those
# that flow within a line, and those that a following start tag of the same kind closes.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "canvas"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
}
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p",
    "pre", "section", "table", "ul",
}
# Elements, roles and words in class or id that mark what is never the article's own text, and
# those that mark the article.
APART = {"nav", "footer", "aside", "form", "menu", "head", "select", "button", "dialog", "label", "fieldset"}
APART_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"}
APART_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pagination", "popup", "promo",
    "promoted", "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "signup",
    "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget",
}
DESCRIBING = {"has", "with", "no", "without", "js", "is", "show", "hide", "layout", "template"}
# Of the words above those that name texts: their marks are certain.
PROSE = {
    "comment", "comments", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "notice",
    "recommended", "related", "replies", "reply", "respond",
}
ARTICLE = {"article", "main"}
ARTICLE_ROLES = {"main", "article"}
ARTICLE_PROPS = {"articlebody"}

# Elements that stand in a text: inside the content's container they belong to it whatever
# their length.
TEXT_PARTS = {
    "blockquote", "dd", "details", "dl", "dt", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "li", "ol", "p",
    "pre", "table", "ul",
}
# What a mark makes of a path's ratio: set apart, in doubt, within an article.
WEIGHT_APART, WEIGHT_DOUBT, WEIGHT_ARTICLE = 0.02, 0.3, 1.5
# A path is content from this part of the best score on; the container holds that part of what
# is content; what lies outside of it has to hold that part of the largest element's text.
CONTENT, CONTAINED, BESIDES = 0.2, 0.8, 0.2
# How an element is set apart: not at all, perhaps, certainly.
OPEN, DOUBTFUL, APART_FROM = 0, 1, 2
# Elements nested deeper count as part of the one around them.
DEPTH = 400

TAG_START = re.compile(r"</?[a-zA-Z]")
# The end of a tag, or a quote that opens a value.
STOP = re.compile(r">|=\s*[\"']")
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
HIDDEN = re.compile(r"\shidden(?=[\s>/=])", re.IGNORECASE)
WORDS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
SIGNS = re.compile(r"[.,;:!?…。，、¿¡]")


def _named_apart(value: str, whole: bool) -> int:
    """Whether a class or id names a part outside the article. Parts of a token count as well
    unless ``whole``, but only in doubt where they may describe a page's frame (sidebar-right),
    and not after words such as in page-with-sidebar that describe what is inside."""
    mark = OPEN
    for token in value.split():
        words = WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower())
        if len(words) == 1:
            if words[0] in APART_WORDS:
                return APART_FROM
        elif not whole:
            cut = next((i for i, w in enumerate(words) if w in DESCRIBING and not (w == "layout" and "__" in token)), None)
            found = APART_WORDS.intersection(words[:cut])
            if found:
                mark = max(mark, DOUBTFUL if PROSE.isdisjoint(found) else APART_FROM)
    return mark


def _marks(name: str, tag: str) -> tuple[int, bool]:
    """How an element is set apart from the article, and whether it is an article."""
    # A form may be a page's frame.
    apart, article = (DOUBTFUL if name == "form" else APART_FROM) if name in APART else OPEN, name in ARTICLE
    if "=" in tag:
        for key, *values in ATTRIBUTE.findall(tag):
            key, value = key.lower(), "".join(values)
            if key == "role":
                apart = APART_FROM if value.lower() in APART_ROLES else apart
                article |= value.lower() in ARTICLE_ROLES
            elif key == "itemprop":
                article |= value.lower() in ARTICLE_PROPS
            elif key in ("class", "id") and name not in ("html", "body"):
                apart = max(apart, _named_apart(value, name in ARTICLE or name in INLINE))
            elif key == "aria-hidden":
                apart = APART_FROM if value.lower() == "true" else apart
    if HIDDEN.search(QUOTED.sub("", tag)):
        apart = APART_FROM
    return apart, article


# An open block element: its name, how it is set apart, whether it is an article, its number.
Element = tuple[str, int, bool, int]


class _Scanner:
    """The tags of a page, from front to back; no character is looked at more than a few times.

    A quoted value ends at the next such quote, as in browsers. Where there is none the quote
    means nothing, and the tag ends at the next ``>`` or with the page."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.lone: set[str] = set()  # quotes that do not come again

    def next(self, at: int) -> tuple[int, int]:
        """Start and end of the next tag, comment or declaration; both the length if none."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            after = page[start + 1 : start + 2]
            if after.isascii() and after.isalpha() or (after == "/" and TAG_START.match(page, start)):
                return start, self._tag_end(start)
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3
            if after in ("!", "?") and after:
                end = page.find(">", start)
                return start, len(page) if end < 0 else end + 1
            at = start + 1
        return len(page), len(page)

    def _tag_end(self, at: int) -> int:
        page = self.page
        while found := STOP.search(page, at):
            sign, at = found.group()[-1], found.end()
            if sign == ">":
                return at
            if sign not in self.lone:
                close = page.find(sign, at)
                if close < 0:
                    self.lone.add(sign)
                else:
                    at = close + 1
        return len(page)


def blocks(page: str) -> Iterator[tuple[str, tuple[Element, ...]]]:
    """The page's text blocks in order: (text, block elements around it from the root)."""
    stack: list[Element] = []
    held: Counter = Counter()  # open elements by name
    parts: list[str] = []
    scanner = _Scanner(page)
    at = 0
    muted, depth = "", 0  # inline element set apart whose text is passed over, and its nesting

    def end() -> Iterator[tuple[str, tuple[Element, ...]]]:
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                yield text, tuple(stack)

    def cut(to: int) -> None:
        held.subtract(s[0] for s in stack[to:])
        del stack[to:]

    while at < len(page):
        start, after = scanner.next(at)
        if start > at and not depth:
            parts.append(page[at:start])
        tag, at = page[start:after], after
        named = NAME.match(tag)
        if not named:
            continue
        name = named.group(1).lower()
        if name in RAW:
            if tag[1] != "/" and not tag.endswith("/>"):
                close = re.compile(rf"</{re.escape(name)}[\s/>]", re.IGNORECASE).search(page, at)
                at = len(page) if not close else close.start()
            continue
        if name in INLINE:
            # Inline elements only matter where they are set apart: up to their end, or that
            # of the block.
            if depth:
                depth += (-1 if tag[1] == "/" else 1) * (name == muted)
            elif tag[1] != "/" and name not in VOID and not tag.endswith("/>") and _marks(name, tag)[0] != OPEN:
                muted, depth = name, 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in VOID and name != "hr":
            continue
        yield from end()
        depth = 0
        if name in VOID:
            continue
        if tag[1] == "/":
            if held[name] > 0:
                cut(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if name in CLOSES_P and stack and stack[-1][0] == "p":
            cut(len(stack) - 1)
        if stack and stack[-1][0] in CLOSED_BY.get(name, ()):
            cut(len(stack) - 1)
        if name == "body":
            kept = [s for s in stack if s[0] == "html"]
            cut(0)
            stack.extend(kept)
            held.update(s[0] for s in kept)
        if not tag.endswith("/>") and len(stack) < DEPTH:
            stack.append((name, *_marks(name, tag), at))
            held[name] += 1
    yield from end()


def _weight(around: tuple[Element, ...]) -> float:
    """What the marks around a block make of its path's ratio."""
    inside = [i for i, s in enumerate(around) if s[2]]
    first, last = (inside[0], inside[-1]) if inside else (len(around), -1)
    mark = OPEN
    for i, (name, own, _, _) in enumerate(around):
        # A form around the article is a page's frame; a header is the article's only inside of it.
        if name == "form" and i < last:
            continue
        mark = max(mark, APART_FROM if name == "header" and i <= first else own)
    return {OPEN: 1.0, DOUBTFUL: WEIGHT_DOUBT, APART_FROM: WEIGHT_APART}[mark] * (WEIGHT_ARTICLE if inside else 1.0)


def _smooth(values: np.ndarray, stems: list[str]) -> np.ndarray:
    """Each path's value, a quarter of it taken from the mean of the paths of the same parent."""
    number = {stem: i for i, stem in enumerate(dict.fromkeys(stems))}
    group = np.array([number[stem] for stem in stems], dtype=np.int64)
    mean = np.bincount(group, weights=values) / np.bincount(group)
    return 0.75 * values + 0.25 * mean[group]


def _ratios(found: list[tuple[str, tuple[Element, ...]]], weights: list[float]) -> list[float]:
    """Each block's fused tag-path ratio: between 0 and 1, relative to the page's best path
    that is not set apart, times its weight."""
    keys = [("/".join(s[0] for s in around), w) for (_, around), w in zip(found, weights)]
    paths = list(dict.fromkeys(keys))
    place = {p: i for i, p in enumerate(paths)}
    length, signs = np.zeros(len(paths)), np.zeros(len(paths))
    for key, (text, _) in zip(keys, found):
        length[place[key]] += len(text)
        signs[place[key]] += len(SIGNS.findall(text))
    stems = [p.rpartition("/")[0] for p, _ in paths]
    length, signs = _smooth(length, stems), _smooth(signs + 1, stems)
    weight = np.array([w for _, w in paths])
    free = weight >= WEIGHT_DOUBT
    if not free.any() or not length[free].max() > 0:
        return [0.0] * len(found)
    fused = np.sqrt(np.minimum(length / length[free].max(), 1) * np.minimum(signs / signs[free].max(), 1)) * weight
    return [float(fused[place[key]]) for key in keys]


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by line feeds; empty if there is none.

    Text length and punctuation signs are added up per tag path from root to block, each
    smoothed with the paths of the same parent and taken relative to the page's largest; their
    geometric mean is the path's ratio. Marks of the page shift it: half more within an
    article, less than a third where a class or id may set a part aside, a fiftieth in what is
    set apart for certain. The blocks of paths from a fifth of the best ratio on are content.

    The lowest element that holds most of the content is its container. What stands in it
    beside the content, such as headings, lists and short paragraphs, belongs to it unless set
    apart; content outside of it has to be a good part of the text.
    """
    found = list(blocks(page or ""))
    if not found:
        return ""
    weights = [_weight(around) for _, around in found]
    scores = _ratios(found, weights)
    best = max(scores)
    if best <= 0:
        return ""
    seed = [score >= CONTENT * best for score in scores]
    held: dict[int, int] = {}  # the content in each element
    inside = [_elements(around) for _, around in found]
    owner = [elements[-1][3] if elements else -1 for elements in inside]
    own: dict[int, int] = {}
    for (text, _), elements, is_seed, o in zip(found, inside, seed, owner):
        if is_seed:
            own[o] = own.get(o, 0) + len(text)
            for s in elements:
                held[s[3]] = held.get(s[3], 0) + len(text)
    most = CONTAINED * sum(own.values())
    largest = max(own.values())

    def content(at: int) -> bool:
        around = found[at][1]
        depth = max((i for i, s in enumerate(around) if held.get(s[3], 0) >= most), default=-1)
        if depth < 0 or any(held.get(s[3], 0) >= most for s in below.get(around[depth][3], ())):
            return seed[at] and own.get(owner[at], 0) >= BESIDES * largest
        rest = around[depth + 1 :]
        if any(s[1] != OPEN for s in rest):
            return False
        if around[depth][0] in ("html", "body"):
            return (seed[at] and own.get(owner[at], 0) >= BESIDES * largest) or (len(rest) == 1 and rest[0][0] in TEXT_PARTS)
        if not rest or any(s[2] for s in around[: depth + 1]):
            return True
        return rest[0][0] in TEXT_PARTS or held.get(rest[0][3], 0) > 0

    # Children that themselves hold most of the content: their parent is not the container.
    below: dict[int, set[Element]] = {}
    for _, around in found:
        for outer, inner in zip(around, around[1:]):
            if held.get(inner[3], 0) >= most:
                below.setdefault(outer[3], set()).add(inner)
    return "\n".join(text for at, (text, _) in enumerate(found) if content(at))


def _elements(around: tuple[Element, ...]) -> tuple[Element, ...]:
    """The elements that a block is a part of: without the paragraph, list or heading it is."""
    to = len(around)
    while to and around[to - 1][0] in TEXT_PARTS:
        to -= 1
    return around[:to]


def extract(df: DataFrame, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Per row the columns ``keep``, ``text`` and ``n_chars`` (code points).

    A null page is an empty one, which has the empty text. Rows are independent: repeated ones
    give equal results, an empty table gives none. Other columns are left aside.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    narrow = df.select(*keep, F.col(page).cast("string").alias("__page"))
    return narrow.mapInArrow(run, f"{schema}, text string, n_chars long")
