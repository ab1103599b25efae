"""Main text of HTML pages by host consensus.

Each page's containers are scored by their own text; the generalised paths (tags with
classes, digits removed) of the best ones are votes for their host.  Pages are then
extracted again from the containers on a winning path of their host, their own best
one if it wins; a page without a host or whose text on those paths is small beside its
own best container uses that one.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from releasemill.llm.frames import extended, slices
from releasemill.llm.urlfilter import host_and_path
from releasemill.workspace import materialise, small_side

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
DIGITS = re.compile(r"\d+")
PARTS = re.compile(r"[-_:]+")
WORD = re.compile(r"[a-z]+")

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp template svg annotation"
                " annotation-xml".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol"
    " option p pre section select summary table tbody tfoot thead title tr ul".split()
)
CELLS = frozenset(["td", "th", "br"])
CONTAINERS = frozenset("article body blockquote dd div main section td".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike"
    " strong sub sup tt u var".split()
)
# A start tag ends an open element of these names, unless a container lies between.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
SCOPES = frozenset(
    "article aside blockquote body dl div fieldset footer form header html main nav ol section table"
    " td th ul li dd".split()
)
CHROME = frozenset("nav footer aside form menu button select dialog canvas object audio video".split())
CHROME_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search"
    " toolbar".split()
)
# A class or id is chrome if each of its parts is one of these words, or an addition to one.
CHROME_WORDS = frozenset(
    "ad ads adbox adslot adunit advert adverts advertisement advertisements advertising foot footer"
    " header nav navbar navigation navigator side sidebar sidebars menu menus menubar alert alerts login"
    " share sharing top topbar bottombar toolbar hidden skip sponsor sponsors sponsored promo promos"
    " promotion promotions banner banners breadcrumb breadcrumbs masthead cookie cookies consent gdpr"
    " notice notices notification notifications popup popups modal modals newsletter newsletters"
    " subscribe subscription signup social related recommended recommendations comment comments"
    " commentlist disqus reply replies respond widget widgets pagination disclaimer".split()
)
CHROME_ADDITIONS = frozenset(
    "site page global main primary secondary left right bottom box bar wrap wrapper container inner outer"
    " list item items links link icons icon buttons button block area section unit slot form".split()
)
CONTENT_STEMS = ("article", "content", "entry", "main", "post", "story", "text", "body")

# Containers of a page that get a vote, and the share of its best one that they need.
VOTES = 3
LEAST_SHARE = 0.5
# Share of a host's pages whose best container a path must be to win beside the first.
WINNING_SHARE = 0.2
# Least value of a page's containers on a winning path, beside its own best one.
OVERRULING_SHARE = 0.25


class Node:
    __slots__ = ("parent", "tag", "words", "label", "key", "reach", "depth", "chrome", "soft", "inside",
                 "linked", "size", "links", "whole")

    def __init__(self, parent, tag, words, label, chrome, soft):
        self.parent, self.tag, self.words, self.label = parent, tag, words, label
        self.key = 0  # of equal paths in a page the same number
        self.reach = parent.reach + 1 + len(label) if parent else len(label)  # length of the path
        self.depth = parent.depth + 1 if parent else 0
        self.chrome, self.soft = chrome, soft  # soft: judged by its class alone
        self.inside = tag in ("article", "main") or bool(parent and parent.inside)
        self.linked = tag == "a" or bool(parent and parent.linked)
        self.size = self.links = self.whole = 0  # whole: with class-judged chrome

    def path(self) -> str:
        """Labels from the root down; made when asked for, as all of a deep page are quadratic."""
        labels, node = [], self
        while node is not None:
            labels.append(node.label)
            node = node.parent
        return ">".join(reversed(labels))


def _label(tag: str, rest: str) -> tuple[str, list[str], list[str], str, bool]:
    """Generalised name, words of class and id, the classes and id, role, hidden."""
    if not rest or rest.isspace():
        return tag, [], [], "", False
    classes, ident, role, hidden = [], "", "", False
    for name, *values in ATTRIBUTE.findall(rest):
        name = name.lower()
        if name not in ("class", "id", "role", "hidden"):
            continue
        value = entities.unescape("".join(values)).lower()
        if name == "class":
            classes = sorted(set(DIGITS.sub("", value).split()))
        elif name == "id":
            ident = DIGITS.sub("", value)
        elif name == "role":
            role = value.strip()
        else:
            hidden = True
    words = WORD.findall(" ".join([*classes, ident]))
    return ".".join([tag, *classes]), words, [*classes, *ident.split()], role, hidden


def _is_chrome_name(name: str, inside: bool) -> bool:
    """Whether a class or id names chrome, as a whole."""
    parts = [p for p in PARTS.split(name) if p]
    known = [p for p in parts if p in CHROME_WORDS and not (inside and p == "header")]
    return bool(known) and all(p in known or p in CHROME_ADDITIONS for p in parts)


class Page:
    """Nodes and text runs of one page, tolerant of unclosed and stray tags."""

    def __init__(self, source: str):
        self.root = Node(None, "html", [], "html", False, False)
        self.nodes = [self.root]
        self.runs: list[tuple[Node, str]] = []  # text; "\n" alone ends a block
        self.opened: Counter[str] = Counter()  # tags on the stack
        self.keys: dict[tuple[int, str], int] = {}
        stack, at, size, last = [self.root], 0, len(source), source.rfind(">")
        while at < size:
            start = source.find("<", at)
            if start > last and not source.startswith(("<!--", "<![CDATA["), start):
                self._text(stack[-1], source[at:])  # no mark ends any more
                break
            found = MARKUP.match(source, start) if start >= 0 else None
            if not found:  # text up to the next mark; a mark that begins no tag is text
                end = source.find("<", start + 1) if start >= 0 else -1
                end = end if end >= 0 else size
                self._text(stack[-1], source[at:end])
                at = end
                continue
            if start > at:
                self._text(stack[-1], source[at:start])
            at = found.end()
            tag = found["tag"] or found["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if found["close"] or found["close2"]:
                self._close(stack, tag)
                continue
            rest = found["rest"] if found["tag"] else found["rest2"]
            if tag in RAW and not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else size
                continue
            self._open(stack, tag, rest)
        self._settle()

    def _text(self, node: Node, raw: str) -> None:
        self.runs.append((node, entities.unescape(raw) if "&" in raw else raw))

    def _break(self, node: Node, tag: str) -> None:
        if tag in BLOCKS:
            self.runs.append((node, "\n"))
        elif tag in CELLS:
            self.runs.append((node, " "))

    def _pop(self, stack: list[Node], names: tuple[str, ...], scopes=frozenset()) -> bool:
        """End the nearest open element of these names, if no scope lies between."""
        if not any(self.opened[name] for name in names):
            return False
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                self._cut(stack, k)
                return True
            if stack[k].tag in scopes:
                return False
        return False

    def _cut(self, stack: list[Node], start: int) -> None:
        self.opened.subtract(node.tag for node in stack[start:])
        del stack[start:]

    def _open(self, stack: list[Node], tag: str, rest: str) -> None:
        if tag in ("html", "body", "head"):
            if tag == "body":
                self._cut(stack, 1)
                self._push(stack, tag, rest)
            return
        if tag in ENDS:
            self._pop(stack, ENDS[tag], SCOPES - frozenset(ENDS[tag]))
        if tag in BLOCKS and tag != "option":
            self._pop(stack, ("p",), SCOPES)
        if tag in VOID or rest.endswith("/") and tag not in CONTAINERS:
            self._break(stack[-1], tag)
            return
        self._push(stack, tag, rest)
        self._break(stack[-1], tag)

    def _push(self, stack: list[Node], tag: str, rest: str) -> None:
        parent = stack[-1]
        label, words, names, role, hidden = _label(tag, rest)
        hard = parent.chrome or hidden or tag in CHROME or role in CHROME_ROLES
        hard = hard or tag == "header" and not parent.inside
        own = tag in ("article", "main", "body")
        soft = not hard and not own and any(_is_chrome_name(n, parent.inside) for n in names)
        node = Node(parent, tag, words, label, hard and not (own and not parent.chrome), soft)
        if own and not soft:  # the article itself is never inside its page's soft chrome
            up = parent
            while up is not None and tag in ("article", "main"):
                up.soft = False  # those above another article have lost theirs to it
                up = None if up.tag in ("article", "main") else up.parent
        node.key = self.keys.setdefault((parent.key, label), len(self.keys) + 1)
        self.nodes.append(node)
        self.opened[tag] += 1
        stack.append(node)

    def _close(self, stack: list[Node], tag: str) -> None:
        if tag in ("html", "body", "head"):
            return
        node = stack[-1]
        if tag in INLINE:
            self._pop(stack, (tag,), BLOCKS)
            return
        if self._pop(stack, (tag,)) or tag in BLOCKS:
            self._break(node, tag)

    def _settle(self) -> None:
        """Spread chrome downwards, then add up text sizes upwards.

        On a page that names no article, a node judged by its class that holds most of
        the page's own text is no chrome.
        """
        if any(n.soft for n in self.nodes) and not any(n.tag in ("article", "main") for n in self.nodes):
            self._unsoften()
        for node in self.nodes:
            if node.soft or node.parent is not None and node.parent.chrome:
                node.chrome = True
        for node, text in self.runs:
            size = len(text) - text.count(" ") - text.count("\n")
            if not size or node.chrome or text.isspace():
                continue
            node.size += size
            if node.linked:
                node.links += size
        for node in reversed(self.nodes):
            if node.parent is not None:
                node.parent.size += node.size
                node.parent.links += node.links

    def _unsoften(self) -> None:
        hard: dict[int, bool] = {}
        for node in self.nodes:
            up = node.parent
            hard[id(node)] = node.chrome or up is not None and hard[id(up)]
        for node, text in self.runs:
            if not hard[id(node)] and not node.linked:
                node.whole += len(text) - sum(map(text.count, " \n\t\r"))
        for node in reversed(self.nodes):
            if node.parent is not None:
                node.parent.whole += node.whole
        for node in self.nodes:
            if node.soft and 2 * node.whole > self.root.whole:
                node.soft = False

    def value(self, node: Node) -> float:
        hint = 1.25 if node.tag in ("article", "main") else 1.0
        if hint == 1.0 and any(w.startswith(CONTENT_STEMS) for w in node.words):
            hint = 1.1
        return hint * (node.size - 2 * node.links)

    def best(self) -> list[tuple[float, Node]]:
        """Containers with text, best first; of equals the deeper one, then the first."""
        scored = [
            (self.value(n), n) for n in self.nodes if (n.tag in CONTAINERS or n is self.root) and not n.chrome and n.size
        ]
        scored = [(v, n) for v, n in scored if v > 0] or [(1.0, n) for _, n in scored]
        scored.sort(key=lambda pair: (-pair[0], -pair[1].depth))
        return scored

    def on_path(self, path: str) -> list[Node]:
        """The nodes on a path that are no chrome."""
        likely = {n.key: n for n in self.nodes if n.reach == len(path) and path.endswith(n.label)}
        keys = {key for key, node in likely.items() if node.path() == path}
        return [n for n in self.nodes if n.key in keys and not n.chrome]

    def text(self, chosen: set[int]) -> str:
        """Blocks of the chosen nodes in page order."""
        inside: dict[int, bool] = {}
        for node in self.nodes:
            up = node.parent
            inside[id(node)] = id(node) in chosen or up is not None and inside[id(up)]
        blocks, held = [], []
        for node, text in self.runs:
            if text == "\n":
                blocks.append("".join(held))
                held = []
            elif inside[id(node)] and not node.chrome:
                held.append(text)
        blocks.append("".join(held))
        return "\n".join(b for b in (" ".join(block.split()) for block in blocks) if b)


def votes(source: str | None) -> Iterator[tuple[str, int]]:
    """Paths of a page's best containers with their votes.

    The best has 1000 votes, the next ones their share of its value over their rank.
    """
    best = Page(source or "").best()
    seen = set()
    for value, node in best:
        share = value / best[0][0]
        if len(seen) == VOTES or share < LEAST_SHARE:
            return
        if node.key not in seen:
            seen.add(node.key)
            yield node.path(), round(1000 * share / len(seen))


def extract(source: str | None, path: str | list[str] | None) -> str:
    """Text of the containers on a winning path, else of the page's best container, else of the page.

    Of several paths the one of the page's best container counts, else that with most
    text.  A path on which the page has little beside its best container does not
    count: the page has another template, and the path holds no more than a teaser.
    """
    page = Page(source or "")
    best = page.best()
    if not best:
        return page.text({id(page.root)})
    value, top = best[0]
    paths = [path] if isinstance(path, str) else path or []
    found = [nodes for nodes in map(page.on_path, paths) if nodes]
    own = [nodes for nodes in found if nodes[0].key == top.key]
    worth = [n for n in own or found if sum(map(page.value, n)) >= OVERRULING_SHARE * value]
    text = max((page.text(set(map(id, nodes))) for nodes in worth), key=len, default="")
    return text or page.text({id(top)})


def consensus(pages: DataFrame, host: str, html: str) -> DataFrame:
    """`host, path`: the path with most votes of each host, and those best on a real share of its pages."""

    def run(batches):
        for batch in slices(batches):
            hosts, paths, shares = [], [], []
            for name, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                for path, share in votes(source):
                    hosts.append(name)
                    paths.append(path)
                    shares.append(share)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())],
                names=["host", "path", "share"],
            )

    cast = pages.select(F.col(host).alias("host"), F.col(html).alias("html"))
    voted = cast.mapInArrow(run, "host string, path string, share long")
    first = F.when(F.col("share") == 1000, 1).otherwise(0)  # only a page's best container has so many
    paths = materialise(
        voted.groupBy("host", "path").agg(F.sum("share").alias("votes"), F.sum(first).alias("firsts")), "votes"
    )
    tops = materialise(
        paths.groupBy(F.col("host").alias("of")).agg(
            F.max(F.struct("votes", F.length("path"), "path")).alias("top"), F.sum("firsts").alias("pages")
        ),
        "tops",
    )
    wins = (F.col("path") == F.col("top.path")) | (F.col("firsts") >= WINNING_SHARE * F.col("pages"))
    return (
        paths.join(small_side(tops, tops.count()), F.col("host").eqNullSafe(F.col("of"))).where(wins)
        .select("host", "path")
    )


def extracted(pages: DataFrame, id_column: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """`id, url, text, n_chars` of every row.

    Null and empty pages, and pages of chrome alone, have an empty text.  Pages
    without a host, or of a rarer template of theirs, use their own best container.  Blocks are trimmed, white space inside is one
    space, and one line feed joins them.  Repeated rows all come back.
    """
    source = pages.select(
        F.col(f"`{id_column}`").alias("__id"), F.col(f"`{url}`").alias("__url"),
        host_and_path(F.col(f"`{url}`").cast("string"))[0].alias("host"),
        F.col(f"`{html}`").cast("string").alias("html"),
    )
    winners = consensus(source.where("host != ''"), "host", "html")
    winners = materialise(
        winners.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("path")), "paths"
    )
    joined = source.join(small_side(winners, winners.count()), "host", "left").select(
        "__id", "__url", F.struct("html", "path").alias("__page")
    )

    def make():
        return lambda rows: [[extract(r["html"], r["path"]) for r in rows]]

    texts = extended(joined, "__page", [("text", "string", pa.string())], make)
    return texts.select(
        F.col("__id").alias(id_column), F.col("__url").alias(url), "text",
        F.length("text").cast("long").alias("n_chars"),
    )
