"""Main text of web pages by a consensus of paths per host.

1. Every page's containers are scored by the text of their blocks, less what
   stands in links. Around the best one the article's region is marked out: it
   climbs to a parent that has running text of its own around it, and takes in
   siblings of the same family of classes (``post-title``, ``post-body``). The
   page votes for the way of tags with classes from the root to that region,
   digits generalised.
2. Votes are added up per host and path, with partial sums before the shuffle,
   and a host's strongest paths win.
3. Every page is read again with the winning paths of its host: the first that
   finds text gives the article. A page with none of them uses its own region,
   and a page without containers its body.

The table of winners has at most ``WINNERS`` rows per host. Pages meet it by an
equi-join on the host, which adaptive execution broadcasts if it is small and
splits if a host is hot. A page is parsed alone, in Arrow batches, in time and
memory in proportion to its length: ways are kept as parent links and running
hashes, open elements are found by name.

Menus, asides, footers, forms, scripts and styles are left out by their tags.
Words in classes, ids and roles (adverts, notices, comments, sidebars, ...) make
a box suspicious; what becomes of it depends on its content. A box with the main
heading stays. A box named by such words alone goes, unless it holds most of the
page's running text and there is no article beside it; reader comments go in any
case. A box that is also named otherwise (``share-price``) goes only if it is
mostly links or has no running text. Single paragraphs go only as adverts or
notices. Character references are decoded, white space inside a block becomes
one space, blocks are joined by an empty line. Nothing is capped.

Special cases: null or empty pages, and pages without text, give the empty text.
A page without a host (null url or no "://") votes for the empty host. Unclosed
and misnested tags are tolerated; a tag that is never ended is text. Very long
pages are read whole. Of containers with equal scores the first in the page is
taken. Repeated rows vote and come back once each, an empty table gives
no rows. Extra columns are handed through; columns called like an added one are
replaced.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .url_templates import url_host
from .words import free_name, quoted

WINNERS = 3  # paths that a host may have

# Names of HTML elements.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr "
    "ul".split()
)
_CLOSES_P = _BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "option"}
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"},
}
_SCOPE = frozenset("table ul ol dl select article section div main body html".split())
_CONTAINERS = frozenset("article main section div td body blockquote".split())
# Elements that never hold the article's text.
_DROPPED = frozenset(
    "head script style noscript template iframe object svg math nav aside footer form button "
    "input select textarea dialog menu canvas audio video noembed noframes xmp title".split()
)
# Words of classes, ids and roles: of what is not the article, of comments among it, of single
# paragraphs that go, of the article itself, and words that say nothing.
_NOT_TEXT = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos "
    "promotion banner banners cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer "
    "sidebar sidebars aside related recommended recommendations share sharing social comment "
    "comments disqus respond reply replies subscribe subscription newsletter signup login search "
    "pagination pager toolbar widget widgets contentinfo complementary hidden".split()
)
_COMMENTS = frozenset("comment comments disqus respond reply replies".split())
_LEAF_NOT_TEXT = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos "
    "cookie cookies consent gdpr notice notices".split()
)
_TEXT = frozenset("article articles post posts entry story content body headline title text".split())
_PLAIN = frozenset(
    "area bar bars block bottom box boxes center col column container group inner items item left "
    "line link links list main outer page panel posts right row section site slot top unit user "
    "wrap wrapper".split()
)
# The same as parts of longer names, where they cannot be mistaken.
_NOT_TEXT_STEMS = re.compile(
    "comment|sidebar|footer|cookie|advert|breadcrumb|newsletter|masthead|disqus|popup|subscribe"
)
_BOXES = _CONTAINERS | frozenset(
    "ul ol dl table header details fieldset figure center hgroup search".split()
)
_FACTORS = {"article": 1.5, "main": 1.2, "body": 0.8}
_KEPT_TAGS = frozenset("html body main article".split())
RUNNING = 25  # characters from which a block is running text and no label
TAG_LENGTH = 1 << 16  # characters in which quotes of a tag are observed

_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?"
    r"|[\"'])*+)>"
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.DOTALL
)
_WORDS = re.compile(r"[a-z]+|(?<=[a-z])[A-Z][a-z]*|[A-Z][a-z]*")
_DIGITS = re.compile(r"\d+")
_FAMILY = re.compile(r"[A-Za-z]{3,}")

_COMMENT_END = re.compile("--!?>")
_TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")

_NO, _WEAK, _STRONG, _COMMENT = 0, 1, 2, 3  # how suspicious a box is


class _Open:
    """An open element."""

    __slots__ = ("tag", "dropped", "container", "article", "box")

    def __init__(self, tag: str, dropped: bool, container: int, article: bool, box: int) -> None:
        self.tag, self.dropped, self.container = tag, dropped, container
        self.article, self.box = article, box


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        found.setdefault(m[1].lower(), entities.unescape(value))
    return found


def _suspicion(value: str) -> int:
    """How much a class, id or role says that something is not the article."""
    most = _NO
    for name in value.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if not {"no", "has", "with", "without"}.isdisjoint(words):
            continue
        listed = [w for w in words if w in _NOT_TEXT]
        if not _COMMENTS.isdisjoint(words) or "comment" in name.lower():
            return _COMMENT
        if _NOT_TEXT_STEMS.search(name.lower()):
            most = max(most, _STRONG)
        elif listed and _TEXT.isdisjoint(words):
            rest = [w for w in words if w not in _NOT_TEXT and w not in _PLAIN]
            most = max(most, _WEAK if rest else _STRONG)
    return most


def _names(attributes: dict[str, str]) -> str:
    return " ".join(attributes[k] for k in ("class", "id", "role") if k in attributes)


def _step(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted({_DIGITS.sub("#", c) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes]).replace(">", "").replace(" ", "")


class Page:
    """Blocks of text of a page, with the containers they stand in."""

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        # Of each way: its last step, the way above, and a hash of all steps.
        self._ways: list[tuple[str, int, int]] = [("", -1, 0)]
        self._way_of: dict[tuple[int, str], int] = {}
        self._ways_open = [0]
        # Of each container: its way, its parent and its tag.
        self.ways = [0]
        self.parents = [-1]
        self.tags = [""]
        self.titled: set[int] = set()  # containers with a main heading of their own
        # Of each box: suspicion, the box around it, main heading, characters, linked, running.
        self._boxes: list[list] = [[_NO, 0, False, 0, 0, 0]]
        self._block_boxes: list[int] = []
        self._text: list[str] = []
        self._linked = 0
        self._links = 0
        self._stack = [_Open("", False, 0, False, 0)]
        self._open: dict[str, list[int]] = {}  # places of open elements by tag
        self._scopes: list[int] = []
        self._walls: list[int] = []  # open containers
        self._in_article = False  # whether text stands in an article or main part, outside boxes
        self._read(source)
        self._flush()
        self._judge_boxes()

    # -- building

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                top = self._stack[-1]
                linked = min(self._linked, len(text))
                self.blocks.append((top.container, text, linked))
                self._block_boxes.append(top.box)
                box = self._boxes[top.box]
                box[3] += len(text)
                box[4] += linked
                running = len(text) >= RUNNING and 2 * linked < len(text)
                box[5] += len(text) if running else 0
                self._in_article |= top.article and not top.box
                titles = self._open.get("h1")
                if titles and self._stack[titles[-1]].container == top.container:
                    self.titled.add(top.container)
            self._text, self._linked = [], 0

    def _say(self, raw: str) -> None:
        if raw and not self._stack[-1].dropped:
            text = entities.unescape(raw) if "&" in raw else raw
            self._text.append(text)
            if self._links:
                self._linked += len(text.strip())

    def _push(self, element: _Open) -> None:
        at = len(self._stack)
        self._stack.append(element)
        self._open.setdefault(element.tag, []).append(at)
        if element.tag in _SCOPE:
            self._scopes.append(at)
        if element.tag in _CONTAINERS:
            self._walls.append(at)
        self._links += element.tag == "a"

    def _pop_to(self, depth: int) -> None:
        """Close the elements from ``depth`` on."""
        stack, opened = self._stack, self._open
        if self._text:
            for at in range(len(stack) - 1, depth - 1, -1):
                if stack[at].tag in _BLOCK:
                    self._flush()
                    break
        while len(stack) > depth:
            tag = stack.pop().tag
            opened[tag].pop()
            if tag in _BLOCK:
                self._ways_open.pop()
                if tag in _SCOPE:
                    self._scopes.pop()
                if tag in _CONTAINERS:
                    self._walls.pop()
            elif tag == "a":
                self._links -= 1
            elif tag in _SCOPE:
                self._scopes.pop()

    def _close_implied(self, tag: str) -> None:
        """Close what a start tag ends unsaid, inside the nearest scope."""
        scope = self._scopes[-1] if self._scopes else 0
        found = []
        for ended in (("p",) if tag in _CLOSES_P else ()) + tuple(_ENDS.get(tag, ())):
            places = self._open.get(ended)
            if places and places[-1] > scope:
                all_of_them = ended == "p" or tag in ("tr", "tbody")
                found.append(places[bisect_right(places, scope)] if all_of_them else places[-1])
        if found:
            self._pop_to(min(found))

    def _start(self, tag: str, raw: str) -> None:
        if tag == "br":
            self._say(" ")
            return
        if tag in _BLOCK:
            self._close_implied(tag)
            if self._text:
                self._flush()
        if tag in _VOID:
            return
        above = self._stack[-1]
        attributes = _attributes(raw) if raw and not raw.isspace() else {}
        dropped = (
            above.dropped
            or tag in _DROPPED
            or (tag == "header" and not above.article)
            or (tag not in _KEPT_TAGS and "hidden" in attributes)
            or (tag not in _KEPT_TAGS and attributes.get("aria-hidden") == "true")
        )
        box = above.box
        if attributes and not dropped and (names := _names(attributes)):
            if tag in _BOXES and (tag not in _KEPT_TAGS or (tag == "article" and above.article)):
                if suspicion := _suspicion(names):
                    box = len(self._boxes)
                    self._boxes.append([suspicion, above.box, False, 0, 0, 0])
            elif tag in ("p", "li") and _suspicion(names) == _STRONG:
                words = {w.lower() for w in _WORDS.findall(names)}
                dropped = not _LEAF_NOT_TEXT.isdisjoint(words)
        container = above.container
        if tag in _BLOCK:
            way = self._ways_open[-1]
            if not dropped:
                step = _step(tag, attributes)
                key = (way, step)
                if (found := self._way_of.get(key)) is None:
                    found = self._way_of[key] = len(self._ways)
                    self._ways.append((step, way, hash((self._ways[way][2], step))))
                way = found
                if tag in _CONTAINERS:
                    container = len(self.ways)
                    self.ways.append(way)
                    self.parents.append(above.container)
                    self.tags.append(tag)
                if tag == "h1":
                    self._boxes[box][2] = True
            self._ways_open.append(way)
        article = above.article or tag in ("article", "main")
        self._push(_Open(tag, dropped, container, article, box))

    def _end(self, tag: str) -> None:
        places = self._open.get(tag)
        if not places:
            return
        if tag not in _BLOCK and self._walls and self._walls[-1] > places[-1]:
            return  # an inline end tag does not close a container
        self._pop_to(places[-1])

    def _read(self, source: str) -> None:
        at, size, lower = 0, len(source), None
        last = source.rfind(">")  # no tag ends after this
        match = _TAG.match
        while at < size:
            start = source.find("<", at)
            if start < 0 or start > last:
                self._say(source[at:])
                return
            found = match(source, start, start + TAG_LENGTH)
            if found is not None:
                m = (found[1], found[2], found[3], found.end())
            else:
                follows = source[start + 1 : start + 2]
                if follows in ("!", "?"):
                    if start > at:
                        self._say(source[at:start])
                    if source.startswith("<!--", start):
                        found = _COMMENT_END.search(source, start + 4)
                        at = found.end() if found else size
                    else:
                        at = source.find(">", start) + 1
                    continue
                name = _TAG_NAME.match(source, start)
                if name is None:
                    self._say(source[at : start + 1])
                    at = start + 1
                    continue
                # Quotes that do not end, or a very long tag: it ends at the next ">".
                end = source.find(">", name.end())
                m = (name[1], name[2], source[name.end() : end], end + 1)
            if start > at:
                self._say(source[at:start])
            closing, tag, raw, at = m
            tag = tag.lower()
            if closing:
                self._end(tag)
                continue
            self._start(tag, raw)
            if tag in _RAW:
                lower = source.lower() if lower is None else lower
                end = lower.find(f"</{tag}", at) if len(lower) == size else None
                if end is None:
                    found = re.compile(f"</{tag}", re.IGNORECASE).search(source, at)
                    end = found.start() if found else -1
                if end < 0:
                    return
                at = end

    def _judge_boxes(self) -> None:
        """Decide which suspicious boxes stay, from their content, and take out the others."""
        boxes = self._boxes
        if len(boxes) == 1:
            return
        running = sum(b[5] for b in boxes)
        for i in range(len(boxes) - 1, 0, -1):  # a box comes after the one around it
            above = boxes[boxes[i][1]]
            above[2] |= boxes[i][2]
            for k in (3, 4, 5):
                above[k] += boxes[i][k]
        gone = [False] * len(boxes)
        for i, (suspicion, above, titled, size, linked, own) in enumerate(boxes[1:], 1):
            most = 2 * own > running and 3 * linked < size and not self._in_article
            few = not own or 5 * linked > 2 * size
            gone[i] = gone[above] or not (titled or most) and (suspicion > _WEAK or few)
            if suspicion == _COMMENT:
                gone[i] = True
        kept = [not gone[b] for b in self._block_boxes]
        self.blocks = [b for b, k in zip(self.blocks, kept) if k]

    # -- asking

    def path(self, container: int) -> str:
        """The way to a container, written out."""
        steps, way = [], self.ways[container]
        while way > 0:
            step, way, _ = self._ways[way]
            steps.append(step)
        return ">".join(reversed(steps))

    def region(self) -> list[int]:
        """The containers that hold the article: the best one, and what belongs to it.

        Blocks count whole for the container they stand in and by half one level up;
        for an article, a main part or a container with the main heading, whole.
        """
        n = len(self.ways)
        own, direct = [0.0] * n, [0] * n
        for container, text, linked in self.blocks:
            worth = max(len(text) - 2 * linked, 0)
            own[container] += worth * (1.0 if len(text) >= RUNNING else 0.5)
            direct[container] += worth if len(text) >= RUNNING else 0
        score, total = own[:], own[:]
        by_way: dict[int, float] = {}
        for i in range(n - 1, 0, -1):
            way = self.ways[i]
            by_way[way] = by_way.get(way, 0.0) + score[i] * _FACTORS.get(self.tags[i], 1.0)
            parent = self.parents[i]
            if parent > 0:
                whole = self.tags[parent] in ("article", "main") or parent in self.titled
                score[parent] += score[i] * (1.0 if whole else 0.5)
            total[parent] += total[i]
        best = max(by_way.values(), default=0.0)
        if best <= 0:
            return []
        first = next(i for i in range(1, n) if by_way[self.ways[i]] == best)
        inside = [i for i in range(1, n) if self.ways[i] == self.ways[first]]
        while len(inside) == 1 and (parent := self.parents[inside[0]]) > 0:
            root = inside[0]
            around = total[parent] - total[root]
            named = self.tags[parent] in ("article", "main")
            # Running text of its own around the best part, or the part of a whole that says so.
            if around > 0 and (
                named
                or (direct[parent] > 0 and self.tags[parent] != "body")
                or (direct[parent] > total[root] and self.tags[root] == "blockquote")
            ):
                inside = [parent]
                continue
            family = self._family(root)
            kin = [
                i
                for i in self._children().get(parent, ())
                if i == root or (family and self._family(i) == family and total[i] > 0)
            ]
            if len(kin) > 1:
                return kin
            if around > 0 or parent <= 0 or self.tags[parent] == "body":
                break
            inside = [parent]
        if len(inside) == 1 and total[inside[0]] > 0:
            return self._narrowed(inside[0], total, first)
        return inside

    def _narrowed(self, top: int, total: list[float], best: int) -> list[int]:
        """Of containers around the best one that hold nothing else, the innermost."""
        at = best
        while at != top and total[at] < total[top]:
            at = self.parents[at]
        return [at]

    def _children(self) -> dict[int, list[int]]:
        if not hasattr(self, "_kids"):
            self._kids: dict[int, list[int]] = {}
            for i in range(1, len(self.parents)):
                self._kids.setdefault(self.parents[i], []).append(i)
        return self._kids

    def _family(self, container: int) -> str:
        """The first word of a container's first class: ``post`` of ``post-body``."""
        step = self._ways[self.ways[container]][0]
        name = step.partition(".")[2]
        found = _FAMILY.search(name)
        return found[0].lower() if found and found[0].lower() not in _PLAIN else ""

    def votes(self) -> list[tuple[str, float]]:
        """The paths of the page's article, joined by blanks, with their share: one vote."""
        paths = sorted({self.path(i) for i in self.region()})
        return [(" ".join(paths), 1.0)] if paths else []

    def _found(self, paths: str) -> list[bool]:
        """Which containers lie inside the ways of ``paths``."""
        hashes = set()
        for path in paths.split(" "):
            value = 0
            for step in path.split(">"):
                value = hash((value, step))
            hashes.add(value)
        inside = [False] * len(self.ways)
        for i in range(1, len(self.ways)):
            inside[i] = self._ways[self.ways[i]][2] in hashes or inside[self.parents[i]]
        return inside

    def text(self, paths: str | None = None) -> str:
        """The blocks inside the containers of these ways, or all blocks."""
        if paths is None:
            return "\n\n".join([text for _, text, _ in self.blocks])
        inside = self._found(paths)
        return "\n\n".join([text for c, text, _ in self.blocks if inside[c]])

    def article(self, winners: list[str]) -> tuple[str, str]:
        """The text and the paths it was found by (empty: the whole body)."""
        for paths in winners:
            if text := self.text(paths):
                return text, paths
        for paths, _ in self.votes():
            if text := self.text(paths):
                return text, paths
        return self.text(), ""


def container_votes(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``votes``: an array of (path, share)."""

    @F.pandas_udf("array<struct<path: string, share: double>>")
    def vote(sources: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in sources:
            yield pd.Series(
                [[{"path": p, "share": s} for p, s in Page(h or "").votes()] for h in batch]
            )

    return pages.withColumn("votes", vote(quoted(html_col)))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, winners): each host's strongest paths, strongest first.

    A path counts by the pages that put it first, then by its shares.
    """
    voted = container_votes(
        pages.select(url_host(quoted(url_col)).alias("host"), quoted(html_col).alias("html")), "html"
    )
    # Shares are added as whole millionths, so that the order of tasks makes no difference.
    tally = (
        voted.select("host", F.posexplode("votes").alias("at", "vote"))
        .groupBy("host", F.col("vote.path").alias("path"))
        .agg(
            F.count_if(F.col("at") == 0).alias("first"),
            F.sum(F.round(F.col("vote.share") * 1000000).cast("bigint")).alias("shares"),
        )
    )
    place = Window.partitionBy("host").orderBy(F.desc("first"), F.desc("shares"), "path")
    top = tally.where(F.col("first") > 0).withColumn("place", F.row_number().over(place))
    return (
        top.where(F.col("place") <= WINNERS)
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("place", "path"))).alias("ranked"))
        .select("host", F.col("ranked.path").alias("winners"))
    )


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text, and ``text_path``, the paths that found it."""
    host, won, found = (free_name(pages.columns, c) for c in ("won_host", "won", "found"))
    winners = stage(host_paths(pages, url_col, html_col), "host-paths").select(
        F.col("host").alias(host), F.col("winners").alias(won)
    )

    @F.pandas_udf("struct<text: string, text_path: string>")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for sources, winning in batches:
            rows = [
                Page(h or "").article([] if w is None else list(w))
                for h, w in zip(sources, winning)
            ]
            yield pd.DataFrame(rows, columns=["text", "text_path"])

    added = ["text", "text_path"]
    met = pages.join(winners, url_host(quoted(url_col)) == F.col(host), "left")
    return met.withColumn(found, read(quoted(html_col), F.col(won))).select(
        *[quoted(c) for c in pages.columns if c.lower() not in added],
        *[F.col(found)[c].alias(c) for c in added],
    )
