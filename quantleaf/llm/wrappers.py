"""HTML extraction by wrapper induction.

1. A page is parsed to a tree of its block elements (label: tag, class, id); repeated siblings of equal shape
   count once. The most frequent shape among a host's distinct pages is the host's template tree.
2. Every page of the host is aligned to it by simple tree matching. Over all distinct pages, text that is the same at
   a template node on most pages is template; what varies is a content slot.
3. The slots that hold the article are the varying ones below the template's main container: an article or
   main element, or else the lowest node with most of the varying text that is not links. Menus, headers, footers,
   asides, forms, adverts, notices and reader comments are known by tag, role, class or id. A name is a hint that the slots overrule:
   a part of a class or id, such as "post-header" or "has-sidebar" (inside an article or main element also a whole one), gives way
   where the text below it is mostly outside links and differs between the host's pages, and outside articles no name drops an
   element that holds more than half of the page's text outside links. Only comments, adverts and teasers don't give way. Inside an article or main
   element a part of an id such as "side-effects" names nothing, and a part of a class counts only where most text is links. Headings
   and paragraphs are known by whole class names at most, inside an article by none.

Blocks are joined in page order. Parsing forgives unclosed and misplaced tags and pages that break off: a head ends at the
first text or element that can't be in it; an unclosed button, select, svg, math or object ends with its parent, or at the
next block element if no end tag for it is left on the page.

Pages of a host whose blocks outside menus, notices and the like have the same texts are one page to all counts, however many
copies there are: copies of an article don't make it a template. All counts are sums over (host, page), (host, node) or
(host, node, text) with partial aggregation, so a host with a third of all pages is no hot group; pages meet their template by a join on the host that Spark broadcasts while the
templates are small and otherwise splits where skewed.

Defined results: a null or empty page, or one without content, gives the empty text and 0 characters. A null url, or
one without a host, belongs to the host "". Equal rows give equal rows, one each. A text on fewer than
``MIN_PAGES`` distinct pages of a host is never constant. Elements nested below ``MAX_DEPTH`` count as part of the one above; their
text stays. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_tasks, materialise, text_slices

MIN_PAGES = 10
CONSTANT_SHARE = 0.6
CONTAINER_SHARE = 0.7
MAX_DEPTH = 100
# Pages for a task of the tables by host and by text at a node, which are small: each file that a task writes costs more than its rows.
HOST_PAGES, TEXT_PAGES = 50_000, 5_000

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
HIDDEN = frozenset("object svg math select button".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())
NEVER = frozenset("nav aside footer form dialog menu".split())
HOLDERS = frozenset("article body center details div fieldset form html main section table tbody td tr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "button": {"button"}, "select": {"select"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_P_LIMITS = BLOCKS - {"p"}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_WORDS = (
    r"ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|menu|nav\w*|breadcrumbs?|sidebar|side|aside|footer|foot|"
    r"masthead|topbar|header|cookies?|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|"
    r"social|comments?|replies|disqus|related|recommend\w*|teasers?|widget|toolbar|pagination|pager|search|skip|legal")
NAMES = re.compile(rf"(?:^|[\s_-])(?:{_WORDS})(?:$|[\s_-])", re.I)
WHOLE = re.compile(_WORDS, re.I)
FOREIGN = re.compile(r"comments?(?:[_-](?:area|box|list|section|threads?|wrapper))?|replies|disqus|ads?(?:[_-](?:banner|box|slot|unit|wrapper))?|"
                     r"advert\w*|adsense|sponsor\w*|promo\w*", re.I)
_FOREIGN_PART = re.compile(r"(?:^|[\s_-])(?:comments?|replies|disqus|ads?|advert\w*|adsense|sponsor\w*|promo\w*|related|recommend\w*|teasers?)(?:$|[\s_-])", re.I)
HARD, SOFT, IN_CLASS, WHOLE_NAME, PART = 1, 2, 3, 4, 5
_COMMENT_ID = re.compile(r"(?:\w+-)?(?:comments?|teasers?|related)(?:[_-]?[0-9]+)?", re.I)
MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|articlebody|post|entry|story|main|content)(?:$|[\s_-])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)|"
    r"<[a-zA-Z][^<>]*+\Z", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass
class Page:
    """Block elements in page order (0 is the root) and the pieces of text with their element."""
    label: list[str] = field(default_factory=lambda: ["#"])
    parent: list[int] = field(default_factory=lambda: [-1])
    never: list[bool] = field(default_factory=lambda: [False])
    banned: list[bool] = field(default_factory=lambda: [False])     # by its own tag, role or state
    named: list[int] = field(default_factory=lambda: [0])       # by its own class or id: 0, HARD or SOFT
    soft: list[int] = field(default_factory=lambda: [0])        # of never ones, the lowest SOFT element around, if no other cause (0: none)
    main: list[int] = field(default_factory=lambda: [0])        # 2: article or main, 1: named like one
    pieces: list[tuple[int, int, str, bool]] = field(default_factory=list)      # element, block, text, in a link


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _named(tag: str, given: dict[str, str], inside: bool) -> int:
    """Whether class or id names an element as no content: HARD for comments and adverts (outside articles also teasers). Inside an
    article or main element, SOFT for other whole names, IN_CLASS for a part of a class name, which counts where the text is mostly
    links. Outside, WHOLE_NAME for whole names and PART for parts of them."""
    names = f"{given.get('class', '')} {given.get('id', '')}".strip()
    if not names or tag in ("html", "body", "article", "main"):
        return 0
    plain = tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6")
    if inside and plain:
        return 0
    whole = given.get("class", "").split() if plain else [*given.get("class", "").split(), given.get("id", "").strip()]
    if any(FOREIGN.fullmatch(w) for w in whole):
        return HARD
    if any(WHOLE.fullmatch(w) for w in whole):
        return SOFT if inside else WHOLE_NAME
    if not inside:
        return 0 if plain or not NAMES.search(names) else HARD if _FOREIGN_PART.search(names) else PART
    return IN_CLASS if NAMES.search(given.get("class", "")) else 0


def _after_raw(source: str, tag: str, at: int) -> int:
    """The place after the end tag of a raw element whose content begins at ``at``; its content is not markup."""
    m = _RAW_END[tag].search(source, at)
    return m.end() if m else len(source)


def parse(source: str | None) -> Page:
    page, source = Page(), source or ""
    stack: list[tuple[str, int]] = [("#", 0)]       # open elements: tag, element of the page
    block, links, hidden, at, in_head = 0, 0, 0, 0, False
    inside = [False]        # of an article or main element
    last_end: dict[str, int] = {}       # where the last end tag of a hidden element is

    def close(k: int) -> None:
        nonlocal links, hidden
        for t, _ in stack[k:]:
            links -= t == "a"
            hidden -= t in HIDDEN
        del stack[k:]

    def text(start: int, end: int) -> None:
        nonlocal in_head
        if in_head:
            if source[start:end].isspace():
                return
            in_head = False
        if not hidden:
            page.pieces.append((stack[-1][1], block, source[start:end], links > 0))

    tokens = _TOKEN.finditer(source)
    while (m := next(tokens, None)) is not None:
        start = m.start()
        if start > at:
            text(at, start)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            in_head = in_head and tag not in ("head", "body", "html")
            was = hidden
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                if stack[k][0] in ("table", "td", "th") and tag not in BLOCKS:
                    break
            if tag in BLOCKS and not (hidden and hidden == was):
                block += 1
            continue
        if tag == "head":
            in_head = True
        in_head = in_head and tag in IN_HEAD
        if (tag == "br" or tag == "hr") and not hidden:
            block += 1
        if tag in VOID or tag == "head":
            continue
        given = m[3] or m[6] or ""
        if tag in RAW:
            if not given.endswith("/"):
                at = _after_raw(source, tag, at)
                tokens = _TOKEN.finditer(source, at)
            continue
        if (hidden or tag in HIDDEN) and given.endswith("/"):
            continue
        if hidden and tag in BLOCKS:        # ends the outermost hidden element that has no end tag ahead, and what is in it
            for k in range(1, len(stack)):
                t = stack[k][0]
                if t in HIDDEN:
                    if t not in last_end:
                        last_end[t] = max((e.start() for e in re.finditer(rf"</{t}(?=[\s/>])", source, re.I)), default=-1)
                    if last_end[t] < at:
                        close(k)
                        break
        closing = CLOSES.get(tag, frozenset()) | ({"p"} if tag in BLOCKS else frozenset())
        limits = LIMITS.get(tag, _P_LIMITS if "p" in closing else frozenset())
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in closing and (stack[k][0] != "p" or not hidden or not any(t in HIDDEN for t, _ in stack[k:])):
                close(k)
                break
            if stack[k][0] in limits:
                break
        if tag not in BLOCKS or hidden:
            links += tag == "a"
            hidden += tag in HIDDEN
            stack.append((tag, stack[-1][1]))
            continue
        block += 1
        above = stack[-1][1]
        if len(stack) > MAX_DEPTH:
            stack.append((tag, above))
            continue
        a = _attributes(given) if given.strip() else {}
        names = f"{a.get('class', '')} {a.get('id', '')}".strip()
        in_article = any(t == "article" for t, _ in stack)
        banned = (tag in NEVER or (tag == "header" and not in_article) or a.get("role", "").lower() in ROLES or "hidden" in a
                  or a.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(a.get("style", "")))
                  or (tag == "article" and bool(names) and bool(re.search(r"comment|teaser|related", a.get("class", ""), re.I)
                                                                or _COMMENT_ID.fullmatch(a.get("id", "").strip()))))
        main = 2 if tag in ("article", "main") or a.get("role", "").lower() == "main" else 1 if names and MAIN_NAMES.search(names) else 0
        page.label.append(f"{tag}.{'.'.join(sorted(set(re.sub(r'[0-9]+', '0', names).split())))}" if names else tag)
        page.parent.append(above)
        page.banned.append(banned)
        page.named.append(_named(tag, a, inside[above]))
        page.main.append(main)
        inside.append(inside[above] or main == 2)
        stack.append((tag, len(page.label) - 1))
    if at < len(source):
        text(at, len(source))
    _judge_classes(page)
    _judge_names(page)
    _mark(page, frozenset())
    _spare_article(page)
    return page


def _judge_classes(page: Page) -> None:
    """IN_CLASS becomes HARD for elements with more text in links than outside, and 0 for others."""
    if IN_CLASS not in page.named:
        return
    balance = [0] * len(page.label)
    for element, _, text, link in page.pieces:
        size = len("".join(text.split()))
        balance[element] += size if link else -size
    for i in range(len(page.label) - 1, 0, -1):
        if page.named[i] == IN_CLASS:
            page.named[i] = HARD if balance[i] > 0 else 0
        balance[page.parent[i]] += balance[i]


def _judge_names(page: Page) -> None:
    """WHOLE_NAME becomes HARD and PART SOFT, but 0 for elements that hold more than half of the page's text outside links, comments
    and the like."""
    if not any(k in (PART, WHOLE_NAME) for k in page.named):
        return
    n = len(page.label)
    out, size = [False] * n, [0] * n
    for i in range(1, n):
        out[i] = out[page.parent[i]] or page.banned[i] or page.named[i] == HARD
    for element, _, text, link in page.pieces:
        if not link and not out[element]:
            size[element] += len("".join(text.split()))
    for i in range(n - 1, 0, -1):
        size[page.parent[i]] += size[i]
    for i in range(1, n):
        if page.named[i] in (PART, WHOLE_NAME):
            page.named[i] = 0 if 2 * size[i] > size[0] else HARD if page.named[i] == WHOLE_NAME else SOFT


def _mark(page: Page, around: set[int] | frozenset[int]) -> None:
    """Fills ``never`` and ``soft``; names of the elements ``around`` don't count."""
    page.never, page.soft = [False], [0]
    for i in range(1, len(page.label)):
        above, named = page.parent[i], 0 if i in around else page.named[i]
        page.never.append(page.never[above] or page.banned[i] or bool(named))
        if page.banned[i] or named == HARD or (page.never[above] and not page.soft[above]):
            page.soft.append(0)
        else:
            page.soft.append(i if named else page.soft[above])


def _spare_article(page: Page) -> None:
    """A name such as "has-sidebar" on an element around the only article does not make the article a sidebar."""
    articles = [i for i, m in enumerate(page.main) if m == 2 and not page.banned[i]]
    if not articles or not all(page.never[i] for i in articles):
        return
    around = set()
    for i in articles:
        while i >= 0:
            around.add(i)
            i = page.parent[i]
    _mark(page, around)


def shape(page: Page) -> tuple[str, list[int]]:
    """The page's shape as text (JSON of [label, child, ...]), and the number of each element in it, in page order.
    Neighbouring siblings of equal shape share their numbers."""
    n = len(page.label)
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[page.parent[i]].append(i)
    text, size = [""] * n, [1] * n
    for i in range(n - 1, -1, -1):
        parts, last = [json.dumps(page.label[i])], None
        for c in children[i]:
            if text[c] != last:
                parts.append(text[c])
                size[i] += size[c]
            last = text[c]
        text[i] = "[" + ",".join(parts) + "]"
    number = [0] * n
    for i in range(n):
        following, last, begun = number[i] + 1, None, 0
        for c in children[i]:
            if text[c] != last:
                begun, following = following, following + size[c]
            number[c] = begun
            last = text[c]
    return text[0], number


def _numbered(tree: list) -> tuple[str, int, list]:
    """[label, child, ...] as (label, number, children), numbered in page order."""
    count = 0

    def walk(node):
        nonlocal count
        own, count = count, count + 1
        return node[0], own, [walk(c) for c in node[1:]]

    return walk(tree)


def match_trees(a: list, b: list) -> dict[int, int]:
    """Simple tree matching: numbers of nodes of ``a`` to those of ``b`` in a largest order-keeping match of equal labels."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def match(x, y) -> tuple[int, list]:
        if x[0] != y[0]:
            return 0, []
        key = (x[1], y[1])
        if key not in memo:
            rows, cols = x[2], y[2]
            best = [[0] * (len(cols) + 1) for _ in range(len(rows) + 1)]
            for i, r in enumerate(rows, start=1):
                for j, c in enumerate(cols, start=1):
                    best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + match(r, c)[0])
            pairs, i, j = [], len(rows), len(cols)
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    pairs.append((rows[i - 1], cols[j - 1]))
                    i, j = i - 1, j - 1
            memo[key] = 1 + best[len(rows)][len(cols)], pairs
        return memo[key]

    found: dict[int, int] = {}
    todo = [(_numbered(a), _numbered(b))]
    while todo:
        x, y = todo.pop()
        size, pairs = match(x, y)
        if size:
            found[x[1]] = y[1]
            todo.extend(pairs)
    return found


class Aligner:
    """Matches of page shapes to one template tree after another; remembers those met in this task."""

    def __init__(self, remember: int = 5000):
        self.remember, self.known = remember, {}

    def __call__(self, page_shape: str, template: str | None) -> dict[int, int]:
        if template is None:
            return {}
        key = (page_shape, template)
        if key not in self.known:
            if len(self.known) >= self.remember:
                self.known.clear()
            self.known[key] = match_trees(json.loads(page_shape), json.loads(template))
        return self.known[key]


def blocks_of(page: Page) -> list[tuple[int, str, int, int]]:
    """(element, text, characters, characters in links) of each block with text."""
    out, k, pieces = [], 0, page.pieces
    while k < len(pieces):
        block, run = pieces[k][1], []
        while k < len(pieces) and pieces[k][1] == block:
            run.append(pieces[k])
            k += 1
        text = " ".join(html.unescape("".join(p[2] for p in run)).split())
        if text:
            out.append((run[0][0], text, len(text), min(len(text), sum(len(p[2]) for p in run if p[3]))))
    return out


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def identity(page: Page) -> int:
    """The same for pages whose blocks that can be content have the same texts."""
    return text_hash("\n".join(t for e, t, _, _ in blocks_of(page) if not page.never[e] or page.soft[e]))


def soft_slot(to: dict[int, int], number: list[int], element: int) -> int | None:
    """The slot of all text below a SOFT element: below -1, so that it is none of its template node's own."""
    node = to.get(number[element])
    return None if node is None else -2 - node


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "html"):
            pages = [parse(t) for t in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("host"), pa.array([identity(p) for p in pages], pa.int64()),
                                              pa.array([shape(p)[0] for p in pages], pa.string())], ["host", "page", "shape"])


class Wrappers:
    """What the rows of a host have in common, read from the first of them: a batch holds it once for each row, Python once for each
    host met. ``names``: the columns, a function may follow."""

    def __init__(self, remember: int = 200, **names):
        self.remember, self.names, self.known = remember, names, {}

    def __call__(self, part: pa.RecordBatch, hosts: list[str], row: int) -> tuple:
        found = self.known.get(hosts[row])
        if found is None:
            if len(self.known) >= self.remember:
                self.known.clear()
            found = self.known[hosts[row]] = tuple(read(part.column(c)[row].as_py()) for c, read in self.names.items())
        return found


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text at a template node of a page: host, page, node, text, chars, link_chars (text null: the page itself)."""
    align, wrapper = Aligner(), Wrappers(template=str)
    for batch in batches:
        for part in text_slices(batch, "html"):
            rows, hosts = [], part.column("host").to_pylist()
            for i, (host, source) in enumerate(zip(hosts, part.column("html").to_pylist(), strict=True)):
                page = parse(source)
                text, number = shape(page)
                to = align(text, *wrapper(part, hosts, i))
                same = identity(page)
                rows.append((host, same, -1, None, 0, 0))
                seen = set()
                for element, words, chars, link_chars in blocks_of(page):
                    nodes, soft = [] if page.never[element] else [to.get(number[element])], page.soft[element]
                    while soft:
                        nodes.append(soft_slot(to, number, soft))
                        soft = page.soft[page.parent[soft]]
                    for node in nodes:
                        if node is not None and (node, words) not in seen:
                            seen.add((node, words))
                            rows.append((host, same, node, text_hash(words), chars, link_chars))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t)
                 for k, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["host", "page", "node", "text", "chars", "link_chars"])


def _container(template: str, weight: dict[int, int]) -> int | None:
    """The lowest template node that holds most of the varying text outside links: an element that holds others, as repeated
    paragraphs share one node, which would leave out the headline between them."""
    best, todo = None, [_numbered(json.loads(template))]
    total = sum(weight.values())
    if not total:
        return None

    def inside(node) -> int:
        return weight.get(node[1], 0) + sum(inside(c) for c in node[2])

    while todo:
        node = todo.pop()
        if inside(node) >= CONTAINER_SHARE * total:
            best, todo = node[1], [c for c in node[2] if c[0].split(".")[0] in HOLDERS]
    return best


def induce(pages: DataFrame) -> DataFrame:
    """Templates of ``pages`` (host, html): host, template, constants (node and hash of the text), container, spared (slots of
    SOFT elements that are content)."""
    n = pages.count()
    # Copies of a page are one page, here and below.
    shapes = (pages.select("host", "html").mapInArrow(_shapes, "host string, page long, shape string")
                   .groupBy("host", "page").agg(F.min("shape").alias("shape"))
                   .groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n")))
    seeds = shapes.groupBy("host").agg(F.max_by("shape", F.struct("n", "shape")).alias("template"))
    seeds = materialise(in_tasks(seeds, n, HOST_PAGES), "templates")
    slots = pages.join(seeds, "host").select("host", "html", "template").mapInArrow(
        _slots, "host string, page long, node int, text long, chars long, link_chars long")
    # One row per distinct page and text at a node, so that counts are counts of distinct pages.
    slots = slots.groupBy("host", "node", "text", "page").agg(F.max("chars").alias("chars"), F.max("link_chars").alias("link_chars"))
    texts = slots.groupBy("host", "node", "text").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("link_chars").alias("link_chars"))
    texts = materialise(in_tasks(texts, n, TEXT_PAGES), "slots")
    totals = texts.where("node = -1").select("host", F.col("n").alias("n_pages"))
    judged = texts.where("node <> -1").join(totals, "host").withColumn(
        "constant", (F.col("n") >= MIN_PAGES) & (F.col("n") >= CONSTANT_SHARE * F.col("n_pages")))
    constants = judged.where("constant").groupBy("host").agg(F.collect_list(F.struct("node", "text")).alias("constants"))
    nodes = judged.where("node >= 0 AND NOT constant").groupBy("host", "node").agg(F.sum(F.col("chars") - F.col("link_chars")).alias("weight"))

    # Text below a SOFT element that is mostly outside links and differs from page to page is content.
    own = (F.col("n") < MIN_PAGES) & (F.col("n") < CONSTANT_SHARE * F.col("n_pages"))
    spared = (judged.where((F.col("node") < -1) & (F.col("n_pages") >= MIN_PAGES)).groupBy("host", "node").agg(
        F.sum("chars").alias("chars"), F.sum(F.when(own, F.col("chars") - F.col("link_chars")).otherwise(0)).alias("varying"))
        .where("2 * varying > chars"))
    # The container is found over all content, so spared slots weigh at their template node.
    weights = (nodes.unionByName(spared.select("host", (-2 - F.col("node")).alias("node"), F.col("varying").alias("weight")))
               .groupBy("host", "node").agg(F.sum("weight").alias("weight"))
               .groupBy("host").agg(F.collect_list(F.struct("node", "weight")).alias("weights")))
    spared = spared.groupBy("host").agg(F.collect_list("node").alias("spared"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = [_container(t, {w["node"]: w["weight"] for w in ws or []})
                      for t, ws in zip(batch.column("template").to_pylist(), batch.column("weights").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("template"), batch.column("constants"),
                                              pa.array(picked, pa.int32()), batch.column("spared")],
                                             ["host", "template", "constants", "container", "spared"])

    joined = seeds.join(constants, "host", "left").join(weights, "host", "left").join(spared, "host", "left").select(
        "host", "template", "constants", "weights", "spared")
    return materialise(in_tasks(joined, n, HOST_PAGES).mapInArrow(
        choose, "host string, template string, constants array<struct<node:int,text:bigint>>, container int, spared array<int>"), "wrappers")


def text_hash(text: str) -> int:
    """What xxhash64() gives for a string column."""
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


def main_text(page: Page, to: dict[int, int], number: list[int], constant: set[tuple[int, int]], container: int | None,
              spared: set[int] | frozenset[int] = frozenset()) -> str:
    blocks = blocks_of(page)
    n = len(page.label)
    never = page.never
    if spared:
        never = [False] * n
        for i in range(1, n):
            never[i] = never[page.parent[i]] or (page.never[i] and not page.soft[i]) or (
                page.soft[i] == i and soft_slot(to, number, i) not in spared)

    def below(chosen: list[bool]) -> list[bool]:
        inside = chosen[:]
        for i in range(1, n):
            inside[i] = inside[i] or inside[page.parent[i]]
        return inside

    def content(inside: list[bool]) -> list[tuple[int, str]]:
        return [(e, t) for e, t, _, _ in blocks if inside[e] and not never[e]]

    inside = [True] * n
    for strength in (2, 1):
        # The outermost elements that are marked as the article, of those with the most text.
        marked = [i for i in range(n) if page.main[i] == strength and not never[i]]
        if strength == 2:
            articles = [i for i in marked if page.label[i].split(".")[0] == "article"]
            marked = articles or marked
        if marked:
            own = below([i in set(marked) for i in range(n)])
            if content(own):
                inside = own
                break
    else:
        if container is not None:
            own = below([to.get(number[i]) == container for i in range(n)])
            if content(own):
                inside = own
    kept = content(inside)
    if constant:
        kept = [(e, t) for e, t in kept if (
            soft_slot(to, number, page.soft[e]) if page.soft[e] else to.get(number[e], -1), text_hash(t)) not in constant]
    return "\n".join(t for _, t in kept)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    align = Aligner()
    wrapper = Wrappers(template=lambda t: t, constants=lambda cs: {(c["node"], c["text"]) for c in cs or []}, container=lambda c: c,
                       spared=lambda nodes: set(nodes or []))
    for batch in batches:
        for part in text_slices(batch, "html"):
            texts, hosts = [], part.column("host").to_pylist()
            for i, source in enumerate(part.column("html").to_pylist()):
                page = parse(source)
                shaped, number = shape(page)
                template, constant, container, spared = wrapper(part, hosts, i)
                texts.append(main_text(page, align(shaped, template), number, constant, container, spared))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host_of(F.col(url_col)).alias("host"))
    wrappers = induce(rows)
    return rows.join(wrappers, "host", "left").select("page_id", "url", "host", "html", "template", "constants", "container", "spared").mapInArrow(
        _extracted, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")


def op4_query(pages: DataFrame) -> DataFrame:
    return extract(pages)
