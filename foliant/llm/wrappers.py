"""Main text of web pages through wrappers inferred per host.

A wrapper is a union-free regular expression over the tags and texts of a host's pages.
Pages are aligned one after the other: equal tags match and are aligned within; a tag
that only one side has becomes optional; tags that come again among the children of an
element become a repeated group; texts that differ become a slot, equal ones stay as
part of the template. Aligning two wrappers is the same as aligning a wrapper and a
page. Every page becomes a wrapper of its own, those of equal pages of a host are cut to one by a shuffle; then
every task aligns its own wrappers of a host, and of a host, however large, only one
per task is shuffled and aligned to the end.

From a host's wrapper follows where its main text is: from the root down as long as one
container holds all text in slots outside menus, headers, footers and the like. What
the others hold is the same on all pages, so no slot of any page is left behind.
Pages then give the texts found along that path, without such elements and without the
texts that are the same on all of at least four distinct pages of the host. Within an
article or main element no text counts as the same, and a header is the article's own. A class that has a
word for furniture in it marks a group that is not around the article, or, on pages without
one, that holds less than half of the page's text; a form around the main text is no
furniture. A page that does not fit its wrapper
is judged by a wrapper of its own, and where all of its text lies in menus and the like,
all of it is given.

Defined results: a NULL or empty page has no text; NULL and unreadable urls share a host;
repeated rows are pages of their own but count once for what is the same on all pages; further columns are
ignored; an empty table gives an empty result. Pages are read whole, and truncated ones
as far as they go; elements nested more than 200 levels deep give their text to their
ancestor at that level.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from foliant.llm.common import materialize

# Fixed values of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea iframe svg math object canvas title select".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"br", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
CONTAINER = set("#page html body main article section div center table tbody tr td".split())
# Elements whose class may hint at furniture: groups, not the pieces of a text.
HINTS = set("div section ul ol dl table span iframe figure center".split())
# Levels of elements; what is nested deeper is read as if it stood at this level.
DEEPEST = 200
FURNITURE = set("aside button dialog footer form head header menu nav search".split())
# Words of class, id and role that name what is not the article.
NAMES = set(
    "ad ads adbox adsense adslot advert adverts advertisement alert banner banners breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disclaimer disqus feedback footer gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification pager pagination popup promo promoted promotion related recommended respond search share "
    "sharebar sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)

# A quote counts where it follows an equals sign only.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|<(/?)([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*[\"']?true)", re.I)
RAW_END = {tag: re.compile(rf"</{tag}\s*>|\Z", re.I) for tag in RAW}
# What a paragraph end or beginning closes at most, and what starts anew within its like.
SCOPES = set("#page html body table td th div article section main li ul ol aside header footer nav form blockquote dd dl".split())
ALIKE = {"li": "ul ol menu", "dd": "dl", "dt": "dl", "tr": "table tbody thead tfoot", "td": "tr table", "th": "tr table", "option": "select"}


class Node:
    """``main``: an article or around one; ``hinted``: perhaps furniture; ``size``: letters in it, furniture left out."""

    __slots__ = ("tag", "key", "kids", "furniture", "hinted", "main", "size")

    def __init__(self, tag: str, key: str, furniture: bool, hinted: bool = False):
        self.tag, self.key, self.furniture, self.hinted, self.kids = tag, key, furniture, hinted, []
        self.main, self.size = tag in ("article", "main"), 0


# Words that turn a name into a statement about an element, as in has-sidebar.
STATES = set("has no not is with without and".split())


def _parts(token: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower())


def _named(token: str) -> bool:
    """Is a whole class, id or role made of nothing but ``NAMES``? (``ad-banner`` and ``navMenu`` are, ``has-sidebar`` is not.)"""
    if token.lower() in NAMES:
        return True
    parts = _parts(token)
    return bool(parts) and all(p in NAMES for p in parts)


def _hinted(token: str) -> bool:
    """Does a part of a class, id or role name furniture? (``site-header`` and ``comment-list`` do.)"""
    parts = _parts(token)
    return any(p in NAMES for p in parts) and not any(p in STATES for p in parts)


def _open(tag: str, attributes: str, within: bool) -> Node:
    """``within``: in an article, whose header is no page's."""
    names, furniture, hinted = "", tag in FURNITURE and not (within and tag == "header"), False
    if attributes:
        for kind, value in ATTRIBUTE.findall(attributes):
            value = value.strip("\"'")
            if kind.lower() != "role":
                names += "." + re.sub(r"\d+", "", " ".join(value.split()))
            if tag not in ("html", "body", "main", "article"):
                furniture = furniture or any(map(_named, value.split()))
                hinted = hinted or tag in HINTS and any(map(_hinted, value.split()))
        furniture = furniture or bool(HIDDEN.search(attributes))
    return Node(tag, tag + names, furniture, hinted)


def parse(page: str) -> Node:
    """The tree of a page, with the omitted and misplaced end tags of ordinary pages."""
    root = Node("#page", "#page", False)
    stack = [root]
    # Open elements beyond ``DEEPEST``, how many of each tag, and how many of them are furniture.
    deep: list[tuple[str, bool]] = []
    counts: dict[str, int] = {}
    hidden = within = 0
    at, n = 0, len(page)

    def text(part: str) -> None:
        if hidden:
            return
        if part and not part.isspace():
            stack[-1].kids.append(entities.unescape(part) if "&" in part else part)
        elif part and stack[-1].kids:
            stack[-1].kids.append(" ")

    def close() -> None:
        nonlocal within
        node = stack.pop()
        within -= node.tag in ("article", "main")
        if node.main and len(stack) > 0:
            stack[-1].main = True

    def close_to(size: int) -> None:
        """Leave ``size`` elements open."""
        nonlocal hidden
        deep.clear()
        counts.clear()
        hidden = 0
        while len(stack) > size:
            close()

    def close_deep(tag: str) -> None:
        nonlocal hidden
        while deep:
            last, furniture = deep.pop()
            counts[last] -= 1
            hidden -= furniture
            if last in BLOCK:
                stack[-1].kids.append(Node(last, last, False))
            if last == tag:
                return

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        slash, tag = (m[1], m[2]) if m[2] else (m[4], m[5])
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if tag == "br":
                stack[-1].kids.append(Node("br", "br", False))
                continue
            if counts.get(tag):
                close_deep(tag)
                continue
            if deep and tag not in BLOCK:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close_to(i)
                    break
                if tag not in BLOCK and stack[i].tag in SCOPES:
                    break
            continue
        if tag in RAW:
            if not (m[3] or "").rstrip().endswith("/"):
                at = RAW_END[tag].search(page, at).end()
            continue
        if tag in CLOSES_P:
            if counts.get("p"):
                close_deep("p")
            elif not deep:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        close_to(i)
                        break
                    if stack[i].tag in SCOPES:
                        break
        if tag in ALIKE and not deep:
            stops = ALIKE[tag].split()
            same = ("dd", "dt") if tag in ("dd", "dt") else ("td", "th") if tag in ("td", "th") else (tag,)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in same:
                    close_to(i)
                    break
                if stack[i].tag in stops:
                    break
        node = _open(tag, m[3] or "", within > 0)
        leaf = tag in VOID or (m[3] or "").endswith("/")
        if len(stack) <= DEEPEST:
            stack[-1].kids.append(node)
            if not leaf:
                stack.append(node)
                within += tag in ("article", "main")
            continue
        # Too deep for an element of its own: its text is its ancestor's, a block still ends the line.
        if tag in BLOCK:
            stack[-1].kids.append(Node(tag, tag, False))
        if not leaf:
            deep.append((tag, node.furniture))
            counts[tag] = counts.get(tag, 0) + 1
            hidden += node.furniture
    close_to(1)
    _judge(root)
    return root


def _judge(root: Node) -> None:
    """Settle what only the whole page tells: hints beside the main text, and forms around it."""

    def measure(node: Node) -> int:
        node.size = sum(len(k) if isinstance(k, str) else measure(k) for k in node.kids)
        return 0 if node.furniture else node.size

    def settle(node: Node, total: int, within: bool) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                continue
            inside = within or kid.tag in ("article", "main")
            # Without an article the main text is where most of the page's is.
            if kid.hinted and not kid.main and (root.main or 2 * kid.size < total):
                kid.furniture = True
            if kid.tag == "form" and not within and (kid.main or not root.main and 2 * kid.size > total):
                kid.furniture = False
            settle(kid, total, inside)

    outside = measure(root)
    forms = _forms(root)
    settle(root, max(outside, outside + forms), False)


def _forms(root: Node) -> int:
    """Letters in the outermost forms."""
    total, todo = 0, [root]
    while todo:
        node = todo.pop()
        for kid in node.kids:
            if isinstance(kid, str):
                continue
            if kid.tag == "form":
                total += kid.size
            elif not kid.furniture:
                todo.append(kid)
    return total


def _dropped(node: Node) -> bool:
    """Furniture, unless it is a mere name of something around the article."""
    return node.furniture and (node.tag in FURNITURE or not node.main or node.tag in ("article", "main"))


# --- wrappers: [key, pages, text in slots, template text or "*" or "", repeated, children] ---

def _fold(kids: list[list]) -> list[list]:
    """Children with distinct keys: what comes again is aligned with the first and, with all between, repeated."""
    out: list[list] = []
    for kid in kids:
        at = next((i for i, x in enumerate(out) if x[0] == kid[0]), None)
        if at is None:
            out.append(kid)
        else:
            both = align(out[at], kid)
            both[1] = max(out[at][1], kid[1])
            out[at] = both
            for x in out[at:]:
                x[4] = 1
    return out


def wrapper(node: Node) -> list:
    """A page, or a part of one, as a wrapper."""
    kids, words = [], []
    for kid in node.kids:
        if isinstance(kid, str):
            words.append(kid)
        elif not _dropped(kid):
            kids.append(wrapper(kid))
    text = " ".join("".join(words).split())
    if text:
        kids.append(["#", 1, len(text), f"{zlib.crc32(text.encode('utf-8', 'replace')):08x}", 0, []])
    return [node.key, 1, 0, "", 0, _fold(kids)]


def align(a: list, b: list) -> list:
    """The wrapper of all that ``a`` and ``b`` stand for; both have the same key."""
    x, y, out, i, j = a[5], b[5], [], 0, 0
    places = {kid[0]: k for k, kid in enumerate(y)}
    while i < len(x):
        at = places.get(x[i][0])
        if at is None or at < j:
            out.append(x[i])
        else:
            out.extend(y[j:at])
            out.append(align(x[i], y[at]))
            j = at + 1
        i += 1
    out.extend(y[j:])
    text = a[3] if a[3] == b[3] else "*"
    return [a[0], a[1] + b[1], a[2] + b[2], text, a[4] | b[4], _fold(out)]


def expression(w: list, pages: int | None = None) -> str:
    """The wrapper as a regular expression; # is a slot and "..." template text."""
    if w[0] == "#":
        inner = "#" if w[3] == "*" else f'"{w[3]}"'
    else:
        inner = f"<{w[0]}>" + "".join(expression(k, w[1]) for k in w[5]) + f"</{w[0].split('.')[0]}>"
    lacks = pages is not None and w[1] < pages
    return f"({inner})" + ("*" if lacks and w[4] else "+" if w[4] else "?") if lacks or w[4] else inner


LEAST = 4


def _same(w: list, least: int) -> bool:
    """Is this text the same on all of at least ``least`` pages?"""
    return w[3] != "*" and w[1] >= least and not w[4]


def _is_content(w: list) -> bool:
    return w[0].split(".")[0] in ("article", "main")


def _in_slots(w: list, least: int, content: bool = False) -> bool:
    """Does this part of a wrapper hold any text that is within the content or not the same on all pages?"""
    if w[0] == "#":
        return content or not _same(w, least)
    content = content or _is_content(w)
    return any(_in_slots(k, least, content) for k in w[5])


def content_path(w: list, least: int = LEAST) -> list[str]:
    """Keys from the root to the innermost container with all text in slots."""
    path: list[str] = []
    while True:
        live = [k for k in w[5] if _in_slots(k, least, any(x.split(".")[0] in ("article", "main") for x in path))]
        if len(live) != 1 or live[0][0].split(".")[0] not in CONTAINER:
            return path
        w = live[0]
        path.append(w[0])


def template_texts(w: list, least: int, path: tuple[str, ...] = ()) -> list[str]:
    """Places and hashes of the texts outside the content that are the same on all of at least ``least`` pages."""
    out = []
    for kid in w[5]:
        if kid[0] == "#":
            if _same(kid, least):
                out.append("/".join(path) + "=" + kid[3])
        elif not _is_content(kid):
            out += template_texts(kid, least, (*path, kid[0]))
    return out


def _blocks(node: Node, path: tuple[str, ...], fixed: set[str], out: list[list[str]]) -> None:
    if fixed:
        own = " ".join("".join(k for k in node.kids if isinstance(k, str)).split())
        if own and "/".join(path) + f"={zlib.crc32(own.encode('utf-8', 'replace')):08x}" in fixed:
            kids = [k for k in node.kids if not isinstance(k, str)]
        else:
            kids = node.kids
    else:
        kids = node.kids
    for kid in kids:
        if isinstance(kid, str):
            out[-1].append(kid)
        elif not _dropped(kid):
            block = kid.tag in BLOCK
            if block:
                out.append([])
            if kid.kids:
                _blocks(kid, (*path, kid.key) if fixed else path, fixed, out)
            if block:
                out.append([])


def main_text(root: Node, path: list[str], fixed: set[str] = frozenset()) -> str:
    """The blocks along ``path``, white space made one blank, one block per line."""
    nodes = [root]
    for key in path:
        nodes = [k for n in nodes for k in n.kids if not isinstance(k, str) and k.key == key and not _dropped(k)]
    out: list[list[str]] = [[]]
    for node in nodes:
        out.append([])
        _blocks(node, tuple(path), fixed, out)
        out.append([])
    lines = (" ".join("".join(parts).split()) for parts in out)
    return "\n".join(x for x in lines if x)


def _unmarked(node: Node) -> Node:
    """The same tree, nothing in it taken for furniture."""
    node.furniture = False
    for kid in node.kids:
        if not isinstance(kid, str):
            _unmarked(kid)
    return node


def extract(page: str | None, rule: dict | None) -> str:
    """The main text of one page by its host's rule."""
    if not page:
        return ""
    root = parse(page)
    if rule:
        text = main_text(root, rule["path"])
        if text and rule["fixed"]:
            # Where little else is left the host's pages are copies, and it was no template.
            rest = main_text(root, rule["path"], set(rule["fixed"]))
            text = rest if 2 * len(rest) >= len(text) else text
        if text:
            return text
    return main_text(root, content_path(wrapper(root))) or main_text(_unmarked(root), [])


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def _host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))


def infer(pages: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` (JSON) from the distinct pages with host and html, aligned in tasks first."""

    def own(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[str, int]] = set()
        for frame in frames:
            out = []
            for host, page, mark in zip(frame["host"], frame["html"], frame["mark"]):
                if page and (host, mark) not in seen:
                    seen.add((host, mark))
                    out.append((host, mark, json.dumps(wrapper(parse(page)))))
            if out:
                yield pd.DataFrame(out, columns=["host", "mark", "wrapper"])

    def tasks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, list] = {}
        for frame in frames:
            for host, told in zip(frame["host"], frame["wrapper"]):
                w = json.loads(told)
                found[host] = align(found[host], w) if host in found else w
            if len(found) > 2000:
                yield pd.DataFrame({"host": list(found), "wrapper": [json.dumps(w) for w in found.values()]})
                found = {}
        if found:
            yield pd.DataFrame({"host": list(found), "wrapper": [json.dumps(w) for w in found.values()]})

    def all_tasks(frame: pd.DataFrame) -> pd.DataFrame:
        both = None
        for told in frame["wrapper"].sort_values():
            w = json.loads(told)
            both = w if both is None else align(both, w)
        return pd.DataFrame({"host": frame["host"].iloc[:1], "wrapper": [json.dumps(both)]})

    each = pages.select("host", "html", F.xxhash64("html").alias("mark")).mapInPandas(own, "host string, mark bigint, wrapper string")
    distinct = each.groupBy("host", "mark").agg(F.first("wrapper").alias("wrapper")).sortWithinPartitions("host", "mark")
    partly = distinct.select("host", "wrapper").mapInPandas(tasks, "host string, wrapper string")
    return partly.groupBy("host").applyInPandas(all_tasks, "host string, wrapper string")


def wrappers(pages: DataFrame) -> DataFrame:
    """``host``, its wrapper as an expression, and the rule that follows from it."""

    def rules(told: pd.Series) -> pd.DataFrame:
        rows = []
        for x in told:
            w = json.loads(x)
            rows.append((expression(w), json.dumps({"path": content_path(w), "fixed": template_texts(w, LEAST)})))
        return pd.DataFrame(rows, columns=["expression", "rule"])

    inferred = infer(pages.select(_host().alias("host"), "html"))
    told = F.pandas_udf(rules, "expression string, rule string")("wrapper")
    return inferred.select("host", told.alias("x")).select("host", "x.*")


def main_texts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars."""
    # A written table: broadcast if small, else joined with hot hosts split.
    rules = materialize(wrappers(pages).select(F.col("host").alias("_host"), F.col("rule").alias("_rule")), "wrapper-rules")
    rows = pages.select("page_id", "url", "html", _host().alias("_host")).join(rules, "_host", "left")

    def texts(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[str, dict] = {}
        for page, told in frames:
            out = []
            for p, t in zip(page, told):
                if t is not None and t not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[t] = json.loads(t)
                out.append(extract(p, known.get(t)))
            yield pd.Series(out, dtype="object")

    rows = rows.select("page_id", "url", F.pandas_udf(texts, "string")("html", "_rule").alias("text"))
    return rows.select("*", F.length("text").cast("bigint").alias("n_chars"))
