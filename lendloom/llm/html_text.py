"""Main text of web pages by the distribution of text over lines.

Markup is stripped and every block element becomes a line. Lines in elements that by name, role or class are not the article
(menus, headers, footers, sidebars, notices, adverts, forms, comments) are left out. If the page has an <article> or <main>, its
other lines are the text. Else the text lengths of the lines, link text counted in headings and paragraphs only, are summed over a
sliding window of ``WINDOW`` lines; text begins where the sum surges to ``SURGE`` characters, or before it with the lines of the
same container that lead up to it, and ends where it dives to nothing; what lies between is kept, short lines included. If
nothing surges, all lines that are not links are kept.

Scripts, styles, text areas and titles that are not closed run to the end; of other embedded elements only those that are closed
are left out whole. Character references are decoded, white space inside a line becomes one space, lines are joined by one space in page order.
Null and empty pages give an empty text. Output columns that clash with an input column replace it.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WINDOW, SURGE = 3, 80
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>", re.S | re.I)
EMBEDDED = {t: re.compile(rf"</{t}\s*>", re.I) for t in "noscript template svg math iframe object canvas audio video".split()}
BLOCKS = frozenset(
    "address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
SPOKEN = frozenset("p h1 h2 h3 h4 h5 h6".split())
HOLDERS = BLOCKS - SPOKEN - frozenset("br li dt dd pre hr hgroup summary caption figcaption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav footer aside form button select menu dialog search fieldset label input head".split())
BODY = frozenset("article main".split())
WHOLE = frozenset("html body article main".split())
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
HINT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|site-?header|page-?header"
    r"|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscribe|share|sharing|social|related|recommended|comments?|commentlist|disqus|replies|respond"
    r"|widget|pagination|pager|toolbar|login|signup|search)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
IMPLIED = {"p": BLOCKS - {"br"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
OUTPUT = (("text", T.StringType()), ("n_chars", T.LongType()))


def _is_aside(tag: str, attributes: str, in_body: bool) -> bool:
    if tag in ASIDE or (tag == "header" and not in_body):
        return True
    if tag in WHOLE or not attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value.lower() in ROLES):
            return True
        if name in ("class", "id") and HINT.search(value):
            return True
    return False


def lines(page: str) -> list[tuple[str, int, bool, int]]:
    """(text, characters outside links, inside an article, number of its container) of every line that is not left out.

    Link text in headings and paragraphs counts.
    """
    found: list[tuple[str, int, bool, int]] = []
    text: list[str] = []
    plain = 0
    stack: list[tuple[str, bool]] = []
    asides = bodies = links = spoken = holder = 0
    holders = [0]

    def close() -> None:
        nonlocal plain, text
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                found.append((whole, plain, bodies > 0, holders[-1]))
        text, plain = [], 0

    def pop() -> None:
        nonlocal asides, bodies, links, spoken
        tag, aside = stack.pop()
        asides -= aside
        bodies -= tag in BODY
        links -= tag == "a"
        spoken -= tag in SPOKEN
        if tag in HOLDERS:
            holders.pop()

    def put(raw: str) -> None:
        nonlocal plain
        if raw and not asides:
            said = html.unescape(raw)
            text.append(said)
            if spoken or not links:
                plain += len(said.strip())

    at = 0
    unclosed: set[str] = set()
    while m := MARKUP.search(page, at):
        put(page[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in EMBEDDED and not m[2] and not m[4].endswith("/") and tag not in unclosed:
            if end := EMBEDDED[tag].search(page, at):
                at = end.end()
                continue
            unclosed.add(tag)
        if tag in BLOCKS:
            close()
        if m[2]:
            if any(name == tag for name, _ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
        else:
            while stack and tag in IMPLIED.get(stack[-1][0], ()):
                pop()
            if tag == "body":
                while stack and stack[-1][0] == "head":
                    pop()
            if tag not in VOID and not m[4].endswith("/"):
                aside = _is_aside(tag, m[4], bodies > 0)
                stack.append((tag, aside))
                asides += aside
                bodies += tag in BODY
                links += tag == "a"
                spoken += tag in SPOKEN
                if tag in HOLDERS:
                    holder += 1
                    holders.append(holder)
    put(page[at:])
    close()
    return found


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    found = lines(page or "")
    inside = [text for text, _, body, _ in found if body]
    if inside:
        return " ".join(inside)
    if not found:
        return ""
    sizes = np.array([n for _, n, _, _ in found], np.int64)
    sums = np.convolve(sizes, np.ones(window, np.int64))[window - 1:]
    rises = sums >= surge
    keep = np.zeros(len(found), bool)
    open_ = False
    for i in range(len(found)):
        if not open_ and rises[i] and sizes[i] > 0:
            open_ = True
            back = i
            while back and not keep[back - 1] and sizes[back - 1] > 0 and found[back - 1][3] == found[i][3]:
                back -= 1
            keep[back:i] = True
        if open_ and sums[i] == 0:
            open_ = False
        keep[i] = open_
    if not keep.any():
        keep = sizes > 0
    return " ".join(t for (t, *_), k in zip(found, keep) if k)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """The pages with ``text`` and ``n_chars`` instead of the html."""
    names = [n for n in pages.columns if n not in dict(OUTPUT) and n != column]
    fields = [f for f in pages.schema.fields if f.name in names]

    def work(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(column)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*names, *dict(OUTPUT)])

    return pages.select(*names, column).mapInArrow(work, T.StructType([*fields, *(T.StructField(n, t) for n, t in OUTPUT)]))
