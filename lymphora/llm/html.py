"""Operator 2, main text of web pages by line-block distribution."""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .common import small_batches, table

#: Fixed values of the HTML standard: elements without an end tag, with raw content, and that break a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe")
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
#: Elements that never hold main text.
DROP = frozenset("nav footer aside form script style head title noscript template iframe svg object canvas audio video button input select textarea label fieldset datalist dialog menu noembed noframes xmp map math search".split())
#: Words of class, id and role that mark boilerplate.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising adsense adsbygoogle alert banner breadcrumb breadcrumbs comment comments comment-list commentlist complementary contentinfo consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion related respond search share sharing shoutbox sidebar signup skyscraper social sponsor sponsored subscribe subscription tags toolbar topbar widget".split())
#: A class with one of these parts tells the state of an element, not what it is.
STATE = frozenset("no not non with without has have is layout fixed".split())
#: Elements that a mark in their class doesn't remove.
KEEP = frozenset("html body article main h1 h2 h3 h4 h5 h6 p".split())
#: Containers whose lines are the article, if the page has any.
MAIN = frozenset("article main".split())
#: A start tag of the key closes an open one of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Lines of a window. Text of a window above which the text surges; it dives where a window has none.
#: By how much text counts less on that side of article and main that has less of the page.
WINDOW, SURGE, MINOR = 3, 80, 4

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTR = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORD = re.compile(r"[a-z0-9]+")
RAW_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in RAW}


def is_mark(token: str) -> bool:
    """Whether a class is a mark as a whole, or begins or ends with one, as in cookie-notice or site-footer."""
    if token in MARKS:
        return True
    parts = WORD.findall(token)
    return bool(parts) and (parts[0] in MARKS or parts[-1] in MARKS) and STATE.isdisjoint(parts)


def hidden(attrs: str) -> bool:
    """Whether the attributes say that the element isn't shown."""
    for name, a, b, c in ATTR.findall(attrs):
        value, name = (a or b or c).lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def marked(tag: str, attrs: str) -> bool:
    """Whether class, id or role say that the element is boilerplate."""
    return tag not in KEEP and any(a[0].lower() in ("class", "id", "role") and any(map(is_mark, (a[1] or a[2] or a[3]).lower().split())) for a in ATTR.findall(attrs))


def spared(found: list[tuple[str, bool, bool, int, tuple[int, ...]]]) -> set[int]:
    """Marked elements that hold most of the text in article and main elements, or of the page's if it has none there."""
    shown = [(len(t), marks) for t, inside, off, _, marks in found if inside and not off] or [(len(t), marks) for t, _, off, _, marks in found if not off]
    held: dict[int, int] = {}
    for n, marks in shown:
        for m in marks:
            held[m] = held.get(m, 0) + n
    total = sum(n for n, _ in shown)
    return {m for m, n in held.items() if 2 * n > total}


def lines(page: str) -> list[tuple[str, bool, bool, int]]:
    """The page's blocks of text in order: (text, in an article or main element, boilerplate, characters in links)."""
    out: list[tuple[str, bool, bool, int, tuple[int, ...]]] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements, whether each is dropped, whether each is marked
    marks: list[int] = []  # numbers of the open elements that are marked
    parts: list[str] = []
    dropped = inside = links = numbered = 0
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((text, inside > 0, dropped > 0, linked, tuple(marks)))
            parts.clear()
        linked = 0

    def pop():
        nonlocal dropped, inside, links
        tag, off, mark = stack.pop()
        if tag in BLOCKS or off or mark:
            flush()
        dropped -= off
        if mark:
            marks.pop()
        inside -= tag in MAIN
        links -= tag == "a"

    def text(s: str):
        nonlocal linked
        if s:
            parts.append(s)
            if links:
                linked += len(s.strip())

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if any(t == tag for t, _, _ in stack):
                if tag not in BLOCKS:  # an inline end tag doesn't close a block
                    k = len(stack) - 1
                    while stack[k][0] != tag and stack[k][0] not in BLOCKS:
                        k -= 1
                    if stack[k][0] != tag:
                        continue
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag in BLOCKS:
                flush()
            continue
        if tag in BLOCKS:
            if stack and any(t == "p" for t, _, _ in stack[-6:]):  # a block ends an open paragraph
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p" or stack[k][0] in BLOCKS), -1)
                if k >= 0 and stack[k][0] == "p":
                    while len(stack) > k:
                        pop()
            if tag in CLOSES:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in CLOSES[tag] or stack[k][0] in ("ul", "ol", "dl", "table", "select", "menu")), -1)
                if k >= 0 and stack[k][0] in CLOSES[tag]:
                    while len(stack) > k:
                        pop()
            flush()
        if tag == "br":
            parts.append(" ")
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            close = RAW_END[tag].search(page, at)
            if tag in BLOCKS:
                flush()
            at = close.end() if close else end
            continue
        off = tag in DROP or tag == "header" and not inside or hidden(m[3])
        mark = not off and marked(tag, m[3])
        if off or mark:
            flush()
        stack.append((tag, off, mark))
        dropped += off
        if mark:
            numbered += 1
            marks.append(numbered)
        inside += tag in MAIN
        links += tag == "a"
    flush()
    free = spared(out)
    return [(t, inside, off or any(k not in free for k in own), n) for t, inside, off, n, own in out]


def main_text(page: str | None) -> str:
    """Blocks between the points where the text surges and dives, joined by newlines.

    A boilerplate block counts as a line without text, as does one that is mostly links and in no article or
    main element. Lines in such elements and lines outside are two sides; a page's home is the side with more
    text, that in the elements counting twice, and on the other side text counts a MINOR-th. Over sliding
    windows of WINDOW lines of a side the text lengths are summed. A stretch begins at the first line with text
    of a window above SURGE, or above a quarter of the page's largest window if that is less, and ends before
    windows without text, on the other side before windows that don't surge. At home in an article or main element, lines adjoining a stretch belong
    to it, and the next line with text beyond boilerplate stays too; else a line right beside a stretch does.
    """
    if not page:
        return ""
    found = lines(page)
    size = [0 if off or not inside and linked * 2 > len(t) else len(t) for t, inside, off, linked in found]
    side = [inside for _, inside, _, _ in found]
    within = sum(n for n, inside in zip(size, side) if inside)
    home = 2 * within >= sum(size) - within if within else False
    size = [n if inside == home else -(-n // MINOR) for n, inside in zip(size, side)]
    sums = [sum(n for n, at in zip(size[k : k + WINDOW], side[k : k + WINDOW]) if at == side[k]) for k in range(len(size))]
    least = min(SURGE, max(sums, default=0) // 4)
    held, up = [False] * len(size), {True: False, False: False}
    for k, n in enumerate(sums):
        up[side[k]] = n > least or up[side[k]] and n > 0 and side[k] == home
        held[k] = up[side[k]] and size[k] > 0
    for k in [*range(1, len(size)), *range(len(size) - 2, -1, -1)] if home else []:
        held[k] |= size[k] > 0 and any(held[j] and side[j] == side[k] == home for j in (k - 1, k + 1) if 0 <= j < len(size))
    keep = list(held)
    texts = [k for k, n in enumerate(size) if n and side[k] == home]
    for i, k in enumerate(texts):
        near = [j for j in texts[max(i - 1, 0) : i + 2] if j != k and (home or abs(j - k) == 1)]
        keep[k] = keep[k] or any(held[j] for j in near)
    return "\n".join(t for (t, _, _, _), kept in zip(found, keep) if kept)


def extract(pages: DataFrame) -> DataFrame:
    """pages with the columns page_id, url, text and n_chars only.

    A null or empty html gives an empty text; repeated rows are extracted each; an empty table gives no
    rows; other columns are not read. Broken markup is read to its end.
    """

    def run(parts):
        for pdf in parts:
            text = [main_text(h) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": text, "n_chars": [len(t) for t in text]})

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the main text of every page."""
    small_batches(spark)
    return extract(table(spark, sf_dir, "pages"))
