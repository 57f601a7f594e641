"""Main text of web pages by removal of site templates.

1. A page is read into a tree of elements. Every element's subtree (its tags and words) is hashed; the hashes
   are counted per host, once for each different content (the article if the page names one, or else all of
   it), so that copies of a page count once. Subtrees that recur on `PAGES` of them are that host's template,
   however large the host is.
2. A page is read again: template subtrees are deleted, and so is what its markup names as not being the
   article: menus, headers and footers of the page, sidebars, notices, adverts, forms, scripts, styles,
   reader comments. A class or id names a part if it is such a name or ends in one (`site-footer`,
   `sidebar-left`), not if the name only stands somewhere in it (`has-sidebar`, `form-text`). Names never
   drop `html`, `body`, `main` or `article` (but for comments set as articles), a part that holds more than half
   of the page's text, or the part with the title of a named article.
3. Of what is left, the text is taken from the article: the outermost `article` or `main` elements if the page
   has any, or else its body. Template deletion spares the text blocks (paragraphs, headings, lists, tables)
   of a named article and whatever holds more than half of its text: copies of an article on one host are
   no template.

Character references are decoded, white space in a block becomes one space, blocks are joined by two
newlines in page order. Unclosed and misnested tags, cut pages and plain text are read as they stand.

Null and empty pages have no text. Pages without a host in their url are one host. Null ids and repeated rows
are rows like any other. Pages of a host with a third of all rows are counted by all tasks and never
gathered. Templates are sent to all tasks while every host has few; beyond that pages meet their own template
subtrees in shuffles, so nothing bounds a template's size. Empty table: empty result.
"""

from __future__ import annotations

import functools
import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.session import materialize

PAGES = 8
HOSTS_BROADCAST, LIST_ROWS = 20_000, 2_000

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*(?:\"|$)|'[^']*(?:'|$))[^>\"']*)*)(?:>|$)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_WORDS = re.compile(r"[a-z0-9]+")

# Element names of HTML by their role, and names that pages give to what is not the article.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style template noscript svg canvas iframe object embed head title nav aside footer form button select"
    " textarea option dialog menu noembed noframes xmp input".split()
)
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1"
    " h2 h3 h4 h5 h6 header hgroup hr legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul"
    " caption".split()
)
TEXT_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption".split()
)
MAIN = frozenset("article main".split())
MAIN_ROLES = frozenset("main article".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
DROPPED_NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead footer sidebar side widget widgets ad ads advert"
    " adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice"
    " notices popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended"
    " recommendations comment comments respond disqus replies reply form search pagination pager toolbar".split()
)
# Reader comments are none of the page's own text, however long: these names drop any element that names may drop.
COMMENT_NAMES = frozenset("comment comments respond disqus reply replies".split())
# Parts of a name that follow its role, and first parts of names that tell a state of the page instead.
TRAILING = frozenset(
    "area bar block body bottom box btn button buttons card cards col column container content group holder icon icons"
    " inner item items left link links list module outer panel post posts primary right row secondary section slot"
    " stories top unit widget wrap wrapper zone".split()
)
STATES = frozenset("has have no non not with without is are show hide hidden js".split())
HEADERS = frozenset("header masthead".split())
OF_ARTICLE = frozenset("article entry post story title headline".split())
# Names say nothing about the page itself, words in a sentence, cells of a table, and code: `token comment` is part of it.
UNNAMED = frozenset(
    "html body main a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark math q rp rt ruby s samp small span"
    " strong sub sup time tt u var pre table caption colgroup thead tbody tfoot tr td th".split()
)
# What ends an open paragraph, and what ends before a sibling of its own kind.
_CLOSES_P = BLOCKS - frozenset("html body td th tr tbody thead tfoot caption li dd dt".split())
_PARAGRAPH, _NOT_PARAGRAPH = frozenset(["p"]), BLOCKS - {"p"}
_CLOSES = {
    tag: (frozenset(ended.split()), frozenset(within.split()))
    for tag, ended, within in (
        ("li", "li p", "ul ol menu"),
        ("dt", "dt dd p", "dl"),
        ("dd", "dt dd p", "dl"),
        ("tr", "tr td th p", "table"),
        ("td", "td th p", "tr table"),
        ("th", "td th p", "tr table"),
        ("option", "option", "select"),
    )
}
_RAW_ENDS = {tag: re.compile(rf"</{tag}\s*/?>", re.IGNORECASE) for tag in RAW}


class Element:
    __slots__ = ("tag", "children", "dropped", "main", "key", "length", "named")

    def __init__(self, tag: str, dropped: bool = False, main: bool = False, named: bool = False):
        self.tag, self.dropped, self.main, self.named = tag, dropped, main, named
        self.children: list = []
        self.key, self.length = 0, 0


@functools.lru_cache(maxsize=1 << 16)
def role_of(name: str) -> tuple[str, bool]:
    """What a class or id says its element is ("" if nothing that is dropped), and whether it is the article's."""
    parts = _WORDS.findall(name)
    if not parts or parts[0] in STATES:
        return "", False
    while len(parts) > 1 and parts[-1] not in DROPPED_NAMES and (parts[-1] in TRAILING or parts[-1].isdigit()):
        parts.pop()
    return (parts[-1] if parts[-1] in DROPPED_NAMES else ""), not OF_ARTICLE.isdisjoint(parts[:-1])


def _described(tag: str, attributes: str, in_main: bool) -> Element:
    named = False
    dropped, main = tag in DROPPED or (tag == "header" and not in_main), tag in MAIN
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes and not attributes.isspace() else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "role":
            dropped |= value in DROPPED_ROLES
            main |= value in MAIN_ROLES
        elif name in ("class", "id"):
            for role, of_article in map(role_of, value.split()) if tag not in UNNAMED else ():
                if role in COMMENT_NAMES:
                    dropped = True
                elif role:
                    named |= not (role in HEADERS and (in_main or of_article))
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            dropped = True
    return Element(tag, dropped, main and not dropped, named and not (dropped or main))


def _open_depth(stack: list[Element], ended: frozenset, within: frozenset) -> int:
    """Depth of the outermost open element of `ended` above the innermost of `within`."""
    depth = len(stack)
    for i in range(len(stack) - 1, 0, -1):
        tag = stack[i].tag
        if tag in within:
            break
        if tag in ended:
            depth = i
    return depth


def parse(page: str) -> Element:
    """The tree of a page: elements and pieces of text as written. Missing end tags are supplied; what is inside
    dropped elements is not kept."""
    root = Element("#page")
    stack, at, mains, dropped, named = [root], 0, 0, 0, False

    def close(depth: int) -> None:
        nonlocal mains, dropped
        for element in stack[depth:]:
            mains -= element.main
            dropped -= element.dropped
        del stack[depth:]

    for match in iter(lambda: _TAG.search(page, at), None):
        if match.start() > at and not dropped:
            stack[-1].children.append(page[at : match.start()])
        at = match.end()
        tag = match[2]
        if tag is None:
            if match[0].startswith("<![CDATA[") and not dropped:
                stack[-1].children.append(html.escape(match[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if match[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                close(depth)
            continue
        if tag in _CLOSES_P:
            close(_open_depth(stack, _PARAGRAPH, _NOT_PARAGRAPH))
        elif tag in _CLOSES:
            close(_open_depth(stack, *_CLOSES[tag]))
        element = _described(tag, match[3], mains > 0)
        if not dropped:
            stack[-1].children.append(element)
            named |= element.named
        if tag in RAW:
            end = _RAW_ENDS[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID:
            stack.append(element)
            mains += element.main
            dropped += element.dropped
    if at < len(page) and not dropped:
        stack[-1].children.append(page[at:])
    if named:
        _drop_named(root)
    return root


def _drop_named(root: Element) -> None:
    """Drop the parts that are named as not being the article, unless they hold most of the text or its title."""
    order = measure(root, keys=False)
    titles = {id(e) for e in order if e.tag == "h1" and e.length}
    for element in reversed(order):
        if any(id(c) in titles for c in element.children):
            titles.add(id(element))
    pending = [(root, False)]
    while pending:
        element, in_main = pending.pop()
        if element.named and 2 * element.length <= root.length and not (in_main and id(element) in titles):
            element.dropped, element.children = True, []
        in_main |= element.main
        pending.extend((c, in_main) for c in element.children if isinstance(c, Element) and not c.dropped)


def measure(root: Element, keys: bool = True) -> list[Element]:
    """Text lengths and, if asked for, hashes of all subtrees, bottom up; gives the elements that aren't dropped."""
    order, pending = [], [root]
    while pending:
        element = pending.pop()
        order.append(element)
        pending.extend(c for c in element.children if isinstance(c, Element) and not c.dropped)
    for element in reversed(order):
        parts, length = [element.tag], 0
        for child in element.children:
            if isinstance(child, Element):
                parts.append(str(child.key))
                length += child.length
            elif not child.isspace():
                length += len(child)
                if keys:
                    parts.append("'" + " ".join(child.split()))
        if keys:
            element.key = xxhash.xxh3_64_intdigest("\x00".join(parts))
        element.length = length
    return order


def _mains(root: Element) -> list[Element]:
    """Outermost elements that the page names as its article, outside of dropped ones."""
    found, pending = [], [root]
    while pending:
        element = pending.pop()
        if element.dropped:
            continue
        if element.main:
            found.append(element)
        else:
            pending.extend(c for c in reversed(element.children) if isinstance(c, Element))
    return found


def extract(page: str | None, template: frozenset | set = frozenset()) -> str:
    """Main text of a page whose host's template subtrees are `template`."""
    if not page:
        return ""
    root = parse(page)
    measure(root, bool(template))
    mains = [m for m in _mains(root) if m.length]
    named, limit = bool(mains), sum(m.length for m in mains) / 2
    blocks: list[list[str]] = [[]]

    def deleted(element: Element) -> bool:
        if element.dropped:
            return True
        if element.key not in template or not element.length:
            return False
        return not (named and (element.tag in TEXT_BLOCKS or element.length > limit or element.tag not in BLOCKS))

    pending: list = list(reversed(mains or [root]))
    while pending:
        node = pending.pop()
        if node is None:
            blocks.append([])
        elif isinstance(node, str):
            blocks[-1].append(html.unescape(node))
        elif node.tag == "br":
            blocks[-1].append(" ")
        elif not deleted(node):
            if node.tag in BLOCKS:
                blocks.append([])
                pending.append(None)
            pending.extend(reversed(node.children))
    texts = (" ".join("".join(block).split()) for block in blocks)
    return "\n\n".join(text for text in texts if text)


def _subtrees(batches):
    """Keys of each page's elements that have text, once per page, with its host, content and row."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("host", "html", "row"))
        hosts, rows, contents, keys = [], [], [], []
        for host, page, row in zip(*columns, strict=True):
            if page:
                root = parse(page)
                found = {e.key for e in measure(root)[1:] if e.length and e.tag in BLOCKS}
                mains = [m.key for m in _mains(root) if m.length]
                content = xxhash.xxh3_64_intdigest(repr(mains)) if mains else root.key
                keys.extend(found)
                hosts.extend([host] * len(found))
                contents.extend([content] * len(found))
                rows.extend([row] * len(found))
        yield pa.RecordBatch.from_pydict(
            {
                "host": pa.array(hosts, pa.string()),
                "row": pa.array(rows, pa.int64()),
                "content": pa.array(map(_signed, contents), pa.int64()),
                "subtree": pa.array(map(_signed, keys), pa.int64()),
            }
        )


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _hosted(pages: DataFrame) -> DataFrame:
    """Pages with `host` and `row`, which equal pages of a host share."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        host_of(F.col("url")).alias("host"),
    )
    return rows.withColumn("row", F.xxhash64("host", "html"))


def _page_subtrees(pages: DataFrame) -> DataFrame:
    return _hosted(pages).select("host", "html", "row").mapInArrow(
        _subtrees, "host string, row bigint, content bigint, subtree bigint"
    )


def site_templates(spark: SparkSession, pages: DataFrame, least_pages: int = PAGES) -> DataFrame:
    """`host`, `subtree` (hash) of all template subtrees, a row for each."""
    contents = _page_subtrees(pages).select("host", "subtree", "content").distinct()
    recurring = contents.groupBy("host", "subtree").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages)
    return materialize(spark, recurring.select("host", "subtree"), "templates")


def _page_templates(spark: SparkSession, pages: DataFrame, templates: DataFrame) -> DataFrame:
    """`row`, `template` (the template subtrees it holds) of the pages that hold any."""
    found = _page_subtrees(pages).select("host", "subtree", "row").join(templates, ["host", "subtree"])
    return materialize(spark, found.groupBy("row").agg(F.collect_set("subtree").alias("template")), "page-templates")


def _texts(batches):
    for batch in batches:
        texts, sets = [], {}
        columns = (batch.column(c).to_pylist() for c in ("html", "of", "template"))
        for page, of, template in zip(*columns, strict=True):
            if of not in sets:
                sets[of] = frozenset(k & ((1 << 64) - 1) for k in template or ())
            texts.append(extract(page, sets[of]))
        kept = [n for n in batch.schema.names if n not in ("html", "of", "template")]
        yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in kept} | {"text": pa.array(texts, pa.string())})


def main_texts(
    spark: SparkSession, pages: DataFrame, *, least_pages: int = PAGES, list_rows: int = LIST_ROWS
) -> DataFrame:
    """`page_id`, `url`, `text`, `n_chars` of each row of `pages` (`page_id`, `url`, `html`).

    `list_rows`: templates of more subtrees are not sent to all tasks; the result is the same.
    """
    templates = site_templates(spark, pages, least_pages)
    sizes = templates.groupBy("host").agg(F.count("*").alias("n")).agg(F.count("*").alias("hosts"), F.max("n").alias("most")).first()
    rows = _hosted(pages)
    if sizes.hosts <= HOSTS_BROADCAST and (sizes.most or 0) <= list_rows:
        lists = F.broadcast(templates.groupBy("host").agg(F.collect_list("subtree").alias("template")))
        with_template = rows.join(lists, "host", "left").withColumnRenamed("host", "of").drop("row")
    else:
        lists = _page_templates(spark, pages, templates)
        with_template = rows.join(lists, "row", "left").withColumnRenamed("row", "of").drop("host")
    return with_template.mapInArrow(_texts, "page_id bigint, url string, text string").withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
