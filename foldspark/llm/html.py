"""Main text of web pages by composite text density.

A page becomes a tree of its block elements. Elements that cannot be the
article by their kind or by what their class, id or role calls them are left out (a name counts if all of
its words speak of such a part; body and main always stay, and where nothing would be left, so do forms and named
parts that hold the headline). For every other
node, characters, tags, and the characters and tags of links in its subtree give
the composite text density: characters per tag, damped by the share of links.
The node whose children have the greatest sum of densities is the target; the
smallest density on its way up to the body is the threshold, and other nodes
that reach it give their own best subtree too, and so do headings and paragraphs that stand in the target's
own containers. Where the page marks its article
(article, main), the target grows to that element and is taken with its lists of
links. On pages without such a mark, lists of links are menus and are left out.

Text is joined by blocks: character references are decoded, white space in a
block becomes one space, blocks are joined by line feeds in page order.

Defined cases: a null page is empty and has the empty text, as has a page without
text; tags that are never closed end with their parent; a tag cut off by the page's
end is no text; repeated rows are rows like any other; an empty table gives no
rows; other columns of the input are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldspark.llm.shared import whole

# fixed values: kinds of HTML elements
_BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noscript ol p pre section summary table tbody td
    tfoot th thead tr ul head title caption""".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_NEVER = frozenset(
    """aside audio button canvas datalist dialog footer form head iframe input math menu nav noembed noframes noscript object
    script select style svg template textarea title video xmp""".split()
)
_CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
}
_SCOPE = frozenset("ul ol dl table body html article section div".split())
_MARKS_ARTICLE = frozenset(["article", "main"])
_BAD_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
# what names of parts that are not the article are made of: at least one of these words
_BAD_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot banner banners billboard breadcrumb
    breadcrumbs comment comments commentlist consent cookie cookies disclaimer discussion disqus footer gdpr header login masthead
    menu menus menubar modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promos promoted
    promotion recommended related replies respond share sharing sidebar sidebars signup skyscraper social sponsor sponsored
    sponsors subscribe subscription tagcloud teaser teasers toolbar widget widgets""".split()
)
# and otherwise only words for a part's form and place; any other word makes it a name of its own ("notice-board", "social-science",
# "layout-sidebar-right", "comments-open")
_PART_WORDS = frozenset(
    """a all and area article articles aside author bar block blocks body bottom box btn button buttons cards col column container
    content count counts desktop div entry fb feed fixed float footer form frame global google group head heading holder icon icons
    image images img in inline inner item items js left link links list lists main message messages meta mid middle mobile module nav
    of outer page pages panel post posts primary print rail right roll row section secondary site slot small square stories story strip
    tab table tag text thread title tools top twitter ul unit user users wp wrap wrapper zone""".split()
)
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_TEXT_BLOCKS = _HEADINGS | {"p", "blockquote", "pre"}
_OWN_HEADLINE = re.compile(r"<(?:article|main|h1)\b", re.IGNORECASE)
_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*')|[^<>=]|=)*+)>|[!?/][^>]*>)",
    re.DOTALL,
)
_CUT_OFF = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# the attribute itself, outside of quoted values
_HIDDEN = re.compile(r"""^(?:[^"']|"[^"]*"|'[^']*')*?\shidden(?:\s|=|/|$)""", re.IGNORECASE)


def _names_other_part(value: str) -> bool:
    """Whether a class or id has a name that is made of words for parts beside the article."""
    for token in value.split():
        words = [w.lower() for w in _WORDS.findall(token)]
        if any(w in _BAD_WORDS for w in words) and all(w in _BAD_WORDS or w in _PART_WORDS or len(w) == 1 for w in words):
            return True
    return False


def _unwanted(name: str, rest: str, in_article: bool) -> bool:
    """Whether an element is no part of an article by its kind or its names."""
    if name in _NEVER or (name == "header" and not in_article):
        return True
    if name in ("body", "html", "main"):
        return False
    if "=" in rest:
        for kind, *values in _ATTRIBUTE.findall(rest):
            value = "".join(values)
            if kind.lower() == "role":
                if value.strip().lower() in _BAD_ROLES:
                    return True
            elif name == "article":
                if any("comment" in t.lower() and _names_other_part(t) for t in value.split()):
                    return True
            elif not (in_article and name in _HEADINGS) and _names_other_part(value):
                return not (name == "header" or (in_article and "header" in value.lower() and "comment" not in value.lower()))
    lower = rest.lower()
    return ("hidden" in lower and bool(_HIDDEN.search(rest))) or "display:none" in lower.replace(" ", "")


class _Tree:
    """Block elements of a page, in page order: a node's parent comes before it."""

    def __init__(self, page: str, lenient: bool = False):
        self.lenient = lenient  # a form, or a part by its names, is kept if the page's headline or article is behind it
        self.parent, self.name = [-1], ["#page"]
        self.chars, self.tags, self.link_chars, self.link_tags = [0], [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []  # node, text
        self._read(page)

    def _read(self, page: str) -> None:
        stack = [0]  # open wanted blocks
        skipped: list[str] = []  # open elements inside an unwanted one, itself first
        pieces: list[str] = []
        linked: list[str] = []
        link_at = -1  # the block in which the open link began
        articles = 0

        def flush() -> None:
            text = " ".join("".join(pieces).split())
            if text:
                node = stack[-1]
                self.blocks.append((node, text))
                self.chars[node] += len(text)
                self.link_chars[node] += min(len(text), len(" ".join("".join(linked).split())))
            pieces.clear()
            linked.clear()

        def add(raw: str) -> None:
            if raw and not skipped:
                text = unescape(raw) if "&" in raw else raw
                pieces.append(text)
                if link_at >= 0:
                    linked.append(text)

        def close(to: int) -> None:
            nonlocal link_at, articles
            flush()
            while len(stack) > to:
                node = stack.pop()
                articles -= self.name[node] in _MARKS_ARTICLE
                if link_at == node:
                    link_at = -1

        at, size = 0, len(page)
        while at < size:
            found = _TAG.search(page, at)
            if found is None:
                add(_CUT_OFF.sub("", page[at:]))
                break
            add(page[at : found.start()])
            at = found.end()
            name = found["name"]
            if name is None:
                continue
            name = name.lower()
            if found["end"]:
                if skipped:
                    if name in skipped:
                        del skipped[len(skipped) - 1 - skipped[::-1].index(name) :]
                    elif any(self.name[n] == name for n in stack[1:]):
                        skipped.clear()  # its parent ends
                    if skipped or name not in _BLOCKS:
                        continue
                if name == "a":
                    link_at = -1
                elif name in _BLOCKS:
                    for k in range(len(stack) - 1, 0, -1):
                        if self.name[stack[k]] == name:
                            close(k)
                            break
                    else:
                        flush()
                continue
            rest = found["rest"] or ""
            if name in _RAW:
                # everything up to its end is not markup
                end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else size
                continue
            if skipped:
                if name not in _VOID:
                    skipped.append(name)
                continue
            unwanted = name not in _VOID and _unwanted(name, rest, articles > 0)
            if unwanted and self.lenient and (name == "form" or name not in _NEVER) and _OWN_HEADLINE.search(page, at):
                unwanted = False
            if unwanted:
                if name in _BLOCKS:
                    flush()
                if not rest.endswith("/"):
                    skipped.append(name)
                continue
            if name == "a":
                self.link_tags[stack[-1]] += 1
                self.tags[stack[-1]] += 1
                link_at = stack[-1]
            elif name == "br":
                add(" ")
            elif name in _BLOCKS:
                flush()
                if name in _VOID:
                    continue
                closes = _CLOSES.get(name)
                for k in range(len(stack) - 1, 0, -1):
                    own = self.name[stack[k]]
                    if own == "p" or (closes and own in closes):
                        close(k)
                        if own != "p":
                            break
                    elif own in _SCOPE:
                        break
                stack.append(len(self.parent))
                self.parent.append(stack[-2])
                self.name.append(name)
                for counts in (self.chars, self.tags, self.link_chars, self.link_tags):
                    counts.append(0)
                articles += name in _MARKS_ARTICLE
        flush()

    def densities(self) -> tuple[list[float], list[float]]:
        """Composite text density of each node, and the sum over its children."""
        n = len(self.parent)
        chars, tags = list(self.chars), list(self.tags)
        link_chars, link_tags = list(self.link_chars), list(self.link_tags)
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i]
        self.all_chars, self.all_link_chars, self.all_link_tags = chars, link_chars, link_tags
        share = link_chars[0] / max(chars[0], 1)
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            c = chars[i]
            if c:
                t, lc, lt = max(tags[i], 1), link_chars[i], max(link_tags[i], 1)
                base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
                value = c / t * math.log(c / max(lc, 1) * t / lt) / math.log(base) if base > 1.0000001 else 0.0
                plain = c / t  # without links the logarithm's base is e or more, its argument at least c
                density[i] = max(0.0, value) if lc or share else plain * math.log(max(c * t, math.e))
            if i:
                sums[self.parent[i]] += density[i]
        return density, sums


def main_text(page: str) -> str:
    """The article's text of one page."""
    # a wrapper around the whole page may be a form, or carry a misleading name
    return _best_text(_Tree(page)) or _best_text(_Tree(page, lenient=True))


def _best_text(tree: _Tree) -> str:
    if not tree.blocks:
        return ""
    density, sums = tree.densities()
    n = len(tree.parent)
    # leaves count with their own density, so that a page of bare text has a target
    score = [sums[i] if sums[i] else density[i] * 0.5 for i in range(n)]
    target = max(range(n), key=lambda i: (score[i], -i))
    path, node = [], target
    while node > 0 and tree.name[node] != "body":
        path.append(node)
        node = tree.parent[node]
    threshold = min((density[i] for i in path), default=density[target])
    marked = next((i for i in path if tree.name[i] in _MARKS_ARTICLE), None)
    chosen = [False] * n
    chosen[target if marked is None else marked] = True
    if marked is None:
        # other parts as dense as the way to the target, beside it
        above = set(path)
        for i in range(1, n):
            if density[i] >= threshold > 0:
                chosen[i] = chosen[i] or i not in above
        # headings and paragraphs that stand directly beside the chosen part, in its containers below the body
        containers = {tree.parent[i] for i in path if tree.parent[i] > 0 and tree.name[tree.parent[i]] not in ("body", "html")}
        for i in range(1, n):
            if tree.name[i] in _TEXT_BLOCKS and (tree.parent[i] in containers or tree.parent[i] == target):
                chosen[i] = True
    inside, menu, own = [False] * n, [False] * n, [False] * n
    for i in range(n):
        p = tree.parent[i]
        inside[i] = chosen[i] or (p >= 0 and inside[p])
        links = tree.all_link_chars[i] * 2 > tree.all_chars[i] and tree.all_link_tags[i] >= 3
        own[i] = i == marked or (p >= 0 and own[p])
        menu[i] = not own[i] and ((links and tree.name[i] not in ("#page", "body", "article", "main")) or (p >= 0 and menu[p]))
    return "\n".join(text for i, text in tree.blocks if inside[i] and not menu[i])


@F.pandas_udf(T.StringType())
def _extracted(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text).astype(object)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns of every page, its main text, and n_chars (code points of the text)."""
    found = pages.select(*keep, _extracted(whole(html_col)).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
