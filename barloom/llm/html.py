"""HTML extraction by the line-block distribution of text lengths."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Lines that one window sums.
WINDOW = 3

# Comments and declarations; elements whose content is no text; tags; a tag cut off at the end.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|math|iframe|object|canvas|video|audio|select)\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
# Name and value of an attribute; a value is consumed whole, so nothing in it is taken for a name.
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Elements without content, and those that stay in the line of the text around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br".split()
)
# Elements that a page often leaves open.
LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option".split())
# Elements, roles and words of class and id that mark what is not the article.
ASIDE = frozenset("nav aside footer form button dialog menu head fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments discussion replies "
    "respond disqus share sharing social related recommended widget toolbar pagination pager copyright".split()
)
ARTICLE = frozenset(("article", "main"))


def _aside(name: str, attrs: str, in_article: bool) -> bool:
    """Whether an element is apart from the article; a header in the article belongs to it."""
    if name in ASIDE or (name == "header" and not in_article):
        return True
    if name in ("html", "body") or "=" not in attrs and "hidden" not in attrs.lower():
        return False
    for key, *values in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), "".join(values)
        if key in ("class", "id"):
            for token in value.split():
                words = [w.lower() for w in WORDS.findall(token)]
                if words and words[0] not in ("has", "no", "with", "without"):
                    if not ASIDE_WORDS.isdisjoint(words) or ("header" in words and not in_article):
                        return True
        elif key == "role" and value.lower() in ASIDE_ROLES:
            return True
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def lines(html: str) -> list[tuple[str, int, bool]]:
    """Lines of the page: text, its length that counts, whether it is in an article element.

    A line is the text between two tags of blocks; what markup sets apart is an empty
    line, but none in an article element, which is not divided. Linked text counts only
    in an article element, where it is rarely a menu.
    """
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool]] = []  # name, apart, in an article
    apart = in_article = False

    def flush() -> None:
        nonlocal linked
        line = " ".join("".join(text).split())
        if line:
            out.append((line, len(line) if in_article else len(line.replace(" ", "")) - linked, in_article))
        text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not apart:
            piece = unescape(piece)
            text.append(piece)
            if links:
                linked += len("".join(piece.split()))

    links, at = 0, 0
    for token in TOKEN.finditer(html):
        add(html[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name in INLINE:
            if name == "br":
                add(" ")
            elif name == "a":
                links = max(0, links + (-1 if token["close"] else 1))
            if token["close"] or name in VOID or not _aside(name, token["attrs"], in_article):
                if not (token["close"] and any(s[0] == name for s in stack)):
                    continue
        if name not in INLINE:
            flush()
        if token["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        elif name not in VOID and not token["attrs"].rstrip().endswith("/"):
            if name in LOOSE:
                for i in range(len(stack) - 1, -1, -1):  # a new paragraph or item ends the one before
                    if stack[i][0] not in LOOSE and stack[i][0] not in INLINE:
                        break
                    if stack[i][0] == name:
                        del stack[i:]
                        break
            outside, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            is_apart = _aside(name, token["attrs"], inside)
            if is_apart and not outside and not inside:
                out.append(("", 0, False))
            if name not in LOOSE or is_apart:
                stack.append((name, outside or is_apart, inside or (name in ARTICLE and not is_apart)))
        before = in_article
        apart, in_article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        if before != in_article:
            out.extend([("", 0, False)] * WINDOW)
            links = 0
    add(html[at:])
    flush()
    return out


def main_text(html: str | None) -> str:
    """The lines between the surge and the dive of the densest run of windows, by newlines."""
    found = lines(html or "")
    if any(inside and text for text, _, inside in found):
        found = [(text, n if inside else 0, inside) for text, n, inside in found]
    sizes = [n for _, n, _ in found]
    # A window that begins at i holds text if the running sums at its ends differ.
    sums = [0]
    for n in sizes:
        sums.append(sums[-1] + n)
    best, surge = (0, 0, 0), None
    for i in range(len(sizes) + 1):
        heavy = i < len(sizes) and sums[min(i + WINDOW, len(sizes))] > sums[i]
        if heavy and surge is None:
            surge = i
        elif not heavy and surge is not None:
            best = max(best, (sums[i] - sums[surge], -surge, i))
            surge = None
    _, start, dive = best[0], -best[1], best[2]
    while start < dive and sizes[start] == 0:  # the window sees the surge ahead
        start += 1
    return "\n".join(text for text, _, _ in found[start:dive] if text)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars (code points) of every page.

    Markup is stripped to lines, one a block, with white space turned into one space and
    character references decoded. Menus, headers, footers, sidebars, notices, adverts,
    forms and comments, as far as elements, roles or names of classes tell them, leave an
    empty line. Lengths are summed over windows of WINDOW lines; a run of windows with
    text lies between a surge and a dive, and the run with the most text is kept, whole.
    Where the page has an article or main element with text, only its lines count, and
    what is apart in it leaves nothing; of elements beside each other the one with the
    most text is kept.

    A null or empty page gives an empty text. Repeated rows and null ids are rows like any
    other; other columns are not read. Cut-off and unclosed tags end with the page.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    [id_col, url_col, "text", "n_chars"],
                )

    fields = [pages.schema[id_col], pages.schema[url_col], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return pages.select(id_col, url_col, html_col).mapInArrow(work, T.StructType(fields))
