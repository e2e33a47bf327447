"""Main text of web pages by tag-path ratios.

A page is read into *nodes* (the text of one block) in page order, each with
its tag path from the root, a number in a tree of paths.  Nodes under elements
that are never the article (``SKIP``, or hidden) are left out, and so is a block
that holds nothing but controls (a button or label inside a sentence belongs to
it).  Elements whose class, id, role or aria-label names boilerplate are set
apart.  Hidden or so named elements that hold ``article``, ``main`` or ``MOST`` of
the page's text are taken like others.  For the nodes that are left:

1. Aggregate by path: characters and punctuation marks per node, without the
   characters inside links: an ``a`` with ``href``, until it or its enclosing
   block ends.
2. Smooth both ratios over the nodes in page order (a Gaussian window), so a
   heading or a short line between paragraphs follows its neighbours.
3. Fuse: the root of the product of the two ratios, each with one added, times
   a weight for paths inside ``article`` or ``main``, and a small one for named
   elements in there that hold more than all that is not set apart, in blocks
   ``RICHER`` times as long.
4. Threshold: a path is content if the mean of its nodes reaches ``SHARE`` of
   the best path's, or if it lies inside the container of content.  Paths that
   are mostly links are menus, but inside ``article``, and other paths set apart
   are content only where nothing else is.

The text is the content nodes' blocks: character references decoded, white
space made one space, trimmed, joined by two ``\\n``.  Nothing is cut off.
The work of a page grows with its length, however deep its elements nest.

Defined cases: null html is empty and gives the empty text; unclosed or
misnested elements close as their parents do; unclosed comments, scripts and
tags end with the page; pages of any length are read whole; paths that tie are
treated alike; repeated rows and null ``page_id`` or ``url`` keep their rows; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import re
from math import exp, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 0.1
SIGMA = 1.0
ROOT_WEIGHT = 4.0
MOST = 2 / 3     # share of the page's characters that only an element around the article has
RICHER = 4.0     # blocks so many times as long as those outside make up for a name inside the article
NAMED_WEIGHT = 0.08
LINKS = 0.6      # share of link characters that makes a path a menu

# Element classes of the HTML standard.
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template".split())
SKIP = frozenset("""head script style title textarea noscript iframe noembed noframes template nav footer aside
    form fieldset button select option datalist label svg canvas object audio video map dialog menu""".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
    ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul""".split())
CONTROL = frozenset("button label".split())     # text of a sentence, if there is other text in its block
UNSEEN = frozenset("select svg canvas object audio video map datalist".split())  # left out of a sentence, don't end it
INSIDE = CONTROL | UNSEEN                       # not blocks, kept on the path
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: an open element (key) ends where one of these starts
ENDED_BY = {
    "p": BLOCK - {"body", "html", "head", "caption", "legend", "optgroup", "option", "tbody", "td", "tfoot", "th",
                  "thead", "tr"},
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "head": frozenset(["body"]),
}
#: an element (key) ends these where it starts
ENDS = {name: frozenset(k for k, v in ENDED_BY.items() if name in v) for name in BLOCK | INSIDE}
#: an element is not ended from inside these
SCOPE = frozenset("ul ol dl table select article section div blockquote body html main aside nav".split())

TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>|<[a-zA-Z/!?][^>]*+\Z""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
#: words in class, id or role that name what is not the article
BOILERPLATE = frozenset("""ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner
    sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent
    notice notices alert disclaimer popup modal overlay newsletter subscribe signup login search share sharing
    social related recommended comment comments replies respond disqus pagination pager widget
    commentlist commenters discussions complementary contentinfo skip""".split())
#: words that say nothing beside them, as in site-footer or comments-area
NEUTRAL = frozenset("""area bar block bottom box button buttons container form global inner item items left link links
    list outer page post posts primary right secondary section site top wrap wrapper""".split())
#: a first word that tells of a state, not of what the element is
STATE = frozenset("has have with no not is without show hide js can".split())
PAGE_HEADER = frozenset(["header"])
MARKS = re.compile(r"[^\w\s]")
_WORD = re.compile(r"[a-z]+")
CLOSED = re.compile(r"""(?:^|[\s"'])/$""")   # a slash that no unquoted value ends with


class Node:
    __slots__ = ("path", "text", "links")

    def __init__(self, path: int, text: str, links: int):
        self.path, self.text, self.links = path, text, links


class Paths:
    """A tree of tag paths.  Number 0 is the empty path; parents come before
    their children.  An element that is set apart has a path of its own."""

    def __init__(self):
        self.number: dict[tuple[int, str, int], int] = {}
        self.parent, self.name, self.apart = [0], [""], [-1]
        self.inside, self.article = [False], [False]     # article or main, article on the path

    def of(self, parent: int, name: str, apart: int = -1) -> int:
        found = self.number.get((parent, name, apart))
        if found is None:
            found = self.number[parent, name, apart] = len(self.parent)
            self.parent.append(parent)
            self.name.append(name)
            self.apart.append(apart)
            self.article.append(self.article[parent] or name == "article")
            self.inside.append(self.inside[parent] or name in ("article", "main"))
        return found


def _attributes(attrs: str) -> dict[str, str]:
    """Values by lower-case name; of a repeated name the first."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attrs):
        out.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
    return out


def _boilerplate(token: str, phrase: bool = False) -> bool:
    """Whether a class or id, or a whole ``phrase``, names boilerplate: all its
    words that say something do, or of a class or id the last of them."""
    words = [w for w in _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower()) if w not in NEUTRAL]
    if not words or words[0] in STATE:
        return False
    return all(w in BOILERPLATE for w in words) or (not phrase and words[-1] in BOILERPLATE)


def _kind(attrs: str) -> str:
    """``hidden``, ``named`` (as not the article) or nothing."""
    if not attrs or attrs.isspace():
        return ""
    a = _attributes(attrs)
    if (("hidden" in a and a["hidden"].lower() != "until-found") or a.get("aria-hidden", "").strip().lower() == "true"
            or NO_DISPLAY.search(a.get("style", ""))):
        return "hidden"
    tokens = [t for k in ("class", "id", "role") for t in a.get(k, "").split()]
    return "named" if any(map(_boilerplate, tokens)) or _boilerplate(a.get("aria-label", ""), True) else ""


def nodes(page: str) -> tuple[list[Node], Paths, list[str]]:
    """Text nodes outside of what is never content, in page order, their paths,
    and which paths are set apart (``named``) or ``rich`` in spite of a name."""
    out: list[Node] = []
    paths = Paths()
    stack: list[tuple[str, bool, int]] = []  # (name, left out, path)
    is_open: dict[str, int] = {}
    kinds: list[str] = []                    # of the hidden or named elements
    holds: list[bool] = []                   # the article
    around = {0}                             # paths around an article
    text: list[tuple[str, bool]] = []        # pieces, and whether they are in a control
    links = at = 0
    unseen_at = -1                           # elements open where the outermost unseen element began, or -1
    link_at = -1                             # elements open where the open link began, or -1

    def here() -> int:
        return stack[-1][2] if stack else 0

    def flush() -> None:
        nonlocal text, links
        if any(not control and not piece.isspace() for piece, control in text):
            body = " ".join(html.unescape("".join(piece for piece, _ in text)).split())
            if body:
                out.append(Node(here(), body, links))
        text, links = [], 0

    def off() -> bool:
        return bool(stack) and stack[-1][1]

    def data(s: str) -> None:
        nonlocal links
        if s and not off():
            text.append((s, bool(stack) and stack[-1][0] in CONTROL))
            if link_at >= 0:
                links += len(s.strip())

    def push(name: str, skip: bool, path: int) -> None:
        nonlocal unseen_at
        if name in UNSEEN and unseen_at < 0:
            unseen_at = len(stack)
        stack.append((name, skip, path))
        is_open[name] = is_open.get(name, 0) + 1

    def pop() -> str:
        nonlocal unseen_at
        name = stack.pop()[0]
        is_open[name] -= 1
        if len(stack) == unseen_at:
            unseen_at = -1
        return name

    def end_link() -> None:
        nonlocal link_at
        if len(stack) < link_at:
            link_at = -1

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            data(page[at:])
            break
        data(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name = name.lower()
        if m[1] or m[4]:                      # end tag
            if name == "a":
                link_at = -1
            elif name in BLOCK or name in INSIDE:
                if not is_open.get(name):
                    if name in BLOCK and unseen_at < 0:
                        flush()
                    continue
                start = len(stack) - 1
                while stack[start][0] != name:
                    start -= 1
                # a control ends no block, nor does what an unseen element holds
                if unseen_at < 0 or start < unseen_at:
                    if any(stack[i][0] in BLOCK for i in range(start, len(stack))):
                        flush()
                while len(stack) > start:
                    pop()
                end_link()
            continue
        attrs = m[3] if m[2] else m[6]
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            if end:
                close = page.find(">", at)
                at = close + 1 if close >= 0 else len(page)
            continue
        if name == "br":
            data(" ")
        elif name == "a":
            link_at = len(stack) if not CLOSED.search(attrs) and "href" in _attributes(attrs) else -1
        if name in VOID and name != "hr":
            continue
        if name in INSIDE:
            push(name, off() or name in UNSEEN, here())
        elif name in BLOCK and unseen_at >= 0 and name in ("option", "optgroup", "hr"):
            continue
        elif name in BLOCK:
            if unseen_at < 0:
                flush()
            if name == "hr":
                continue
            if any(is_open.get(k) for k in ENDS[name]):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ENDS[name]:
                        while len(stack) > i:
                            pop()
                        if name not in ("tr", "tbody", "tfoot"):
                            break
                    elif stack[i][0] in SCOPE:
                        break
            end_link()
            parent = here()
            skip = off() or name in SKIP or is_open.get("button", 0) > 0 or (name in PAGE_HEADER and not paths.inside[parent])
            number = -1
            if name in ("article", "main"):
                if not paths.inside[parent] and not skip:
                    above = parent
                    while above not in around:
                        around.add(above)
                        if paths.apart[above] >= 0:
                            holds[paths.apart[above]] = True
                        above = paths.parent[above]
            elif not skip and name not in ("html", "body"):
                kind = _kind(attrs)
                if kind:
                    number = len(kinds)
                    kinds.append(kind)
                    holds.append(False)
            push(name, skip, parent if skip else paths.of(parent, name, number))
    flush()
    return _outside(out, paths, kinds, holds)


def _outside(found: list[Node], paths: Paths, kinds: list[str], holds: list[bool]) -> tuple[list[Node], Paths, list[str]]:
    """Nodes that are not hidden, on paths without the elements' numbers, and
    which of these paths are named or rich."""
    n = len(paths.parent)
    size, blocks = [0] * n, [0] * n    # characters and nodes at and below a path
    loose = [True] * n                 # nothing on the path is set apart
    for i in range(1, n):
        loose[i] = loose[paths.parent[i]] and paths.apart[i] < 0
    whole = plain = plain_blocks = 0
    for node in found:
        size[node.path] += len(node.text)
        blocks[node.path] += 1
        whole += len(node.text)
        if loose[node.path]:
            plain += len(node.text)
            plain_blocks += 1
    for i in range(n - 1, 0, -1):
        size[paths.parent[i]] += size[i]
        blocks[paths.parent[i]] += blocks[i]
    out, same, hidden, named = Paths(), [0] * n, [False] * n, [""]
    for i in range(1, n):
        up, number = paths.parent[i], paths.apart[i]
        kind = "" if number < 0 or holds[number] or size[i] > MOST * whole else kinds[number]
        if (kind == "named" and paths.inside[i] and size[i] > plain
                and size[i] * plain_blocks >= RICHER * plain * blocks[i]):
            kind = "rich"
        hidden[i] = hidden[up] or kind == "hidden"
        same[i] = out.of(same[up], paths.name[i], ("", "named", "rich", "hidden").index(kind) - 1)
        if same[i] == len(named):
            above = named[same[up]]
            named.append(above if above == "named" or not kind else kind)
    kept = []
    for node in found:
        if not hidden[node.path]:
            node.path = same[node.path]
            kept.append(node)
    return kept, out, named


def _smooth(values: list[float], sigma: float) -> list[float]:
    reach = max(1, round(2 * sigma))
    w = [exp(-k * k / (2 * sigma * sigma)) for k in range(reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - reach), min(len(values), i + reach + 1)):
            total += w[abs(i - j)] * values[j]
            weight += w[abs(i - j)]
        out.append(total / weight)
    return out


def content_paths(found: list[Node], paths: Paths, named: list[str]) -> set[int]:
    """Paths whose fused, smoothed ratios reach the threshold."""
    chars: dict[int, list[float]] = {}
    for n in found:
        c = chars.setdefault(n.path, [0.0, 0.0, 0.0, 0.0])
        c[0] += max(0, len(n.text) - n.links)
        c[1] += len(MARKS.findall(n.text)) * (n.links < len(n.text))
        c[2] += 1
        c[3] += n.links
    length = _smooth([chars[n.path][0] / chars[n.path][2] for n in found], SIGMA)
    marks = _smooth([chars[n.path][1] / chars[n.path][2] for n in found], SIGMA)
    score: dict[int, float] = {}
    for n, a, b in zip(found, length, marks, strict=True):
        fused = sqrt((1 + a) * (1 + b)) * (ROOT_WEIGHT if paths.inside[n.path] else 1.0) * (NAMED_WEIGHT if named[n.path] else 1.0)
        score[n.path] = score.get(n.path, 0.0) + fused / chars[n.path][2]
    menu = {p for p, c in chars.items() if c[3] > LINKS * (c[0] + c[3]) and not paths.article[p]}
    open_to = {p for p in score if p not in menu and named[p] != "named"} or {p for p in score if p not in menu}
    best = max((score[p] for p in open_to), default=0.0)
    good = {p for p in open_to if score[p] >= SHARE * best}
    if any(paths.inside[p] for p in good):   # an article element holds the article
        good = {p for p in good if paths.inside[p]}
    holders = {paths.parent[p] for p in good}
    within = [False] * len(paths.parent)
    for p in range(1, len(within)):
        root = paths.name[p] in ("html", "body") and paths.parent[paths.parent[p]] == 0
        within[p] = (p in holders and not root) or (within[paths.parent[p]] and paths.apart[p] < 0)
    return good | {p for p in score if p not in menu and within[p]}


def main_text(page: str) -> str:
    found, paths, named = nodes(page)
    if not found:
        return ""
    keep = content_paths(found, paths, named)
    return "\n\n".join(n.text for n in found if n.path in keep)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    types = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def run(batches):
        for b in batches:
            text = [main_text(x or "") for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                 pa.array(list(map(len, text)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", F.col("html")).mapInArrow(
        run, f"page_id {types[0]}, url {types[1]}, text string, n_chars long")
