"""Main text of web pages by consensus paths per host.

A page is read as a sequence of blocks, each with the containers it lies in. Containers are scored per page: characters of
prose in them, less those in links, whether they hold all of the page's prose, and how deep they are. The best container
votes with its path, tags and classes with numbers taken out. Spark counts the votes per host, and each page is read again
with its host's paths, best first; a page in which none of them holds enough of the prose is read with the container it
would have voted for. Boxes are foreign by element, role or parts of names; the last is overruled on a box around the page.

Votes are combined in the tasks, so a host with a third of all pages is one small row per task and path. Pages meet the
paths of their host by a join on the host; the pages' side is split where it is skewed.

Null and empty html give empty text. A null url or one without a host counts as host ''. Repeated rows each get their own
result. Broken markup is read as browsers do where it is cheap: unclosed elements end with their parent, a stray end tag
is passed over. What is known of an element is handed down from the one around it or summed up from those in it, so time grows
with the page's length, however deep its elements lie in each other.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from gustline.llm.arrow import col, pieces
from gustline.storage import materialize

#: Paths kept of each host, best first.
PATHS = 4

_TAG = re.compile(r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>?)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_SPACE = re.compile(r"\s+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Everything up to the end tag is no markup.
_RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea title svg annotation annotation-xml select".split())
#: Elements that do not part words.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span strike strong "
    "sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover semantics".split())
#: A start tag of these ends an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: A start tag ends an open element of the same group, up to the nearest of the bounds.
_SIBLING = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
#: No prose of the article.
_ASIDE = frozenset("nav footer aside menu button dialog fieldset legend output progress meter audio video canvas map head search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar dialog alertdialog alert tablist".split())
#: Parts of class names and ids of what is not the article.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus disclaimer dropdown footer foot gdpr header legal login masthead menu menus modal nav navbar navigation "
    "navi newsletter notice notices notification notifications overlay pager pagination paywall popup popover promo promos promoted promotion "
    "recommend recommended recommendations related replies reply respond responses search share sharing shares sidebar sidenav "
    "signup skip skiplink skyscraper social sponsor sponsored sponsors subscribe subscription tagcloud tags toolbar topbar "
    "widget widgets advertorial outbrain taboola".split())
_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Box:
    """An element that holds blocks."""
    tag: str
    path: int  # number of its path in the page
    above: int
    depth: int
    mark: int  # 0, or _LOOSE or _FIRM: what the element itself says
    head: bool = False  # shows where the article is
    out: bool = False  # not part of the article
    inside: bool = False  # lies in an article or main element
    begin: int = 0
    end: int = 0
    prose: int = 0
    linked: int = 0


@dataclass
class Page:
    boxes: list[Box] = field(default_factory=list)
    #: (text, characters in links, box)
    blocks: list[tuple[str, int, int]] = field(default_factory=list)
    #: Paths by number: the path above and the last step; and the number of each.
    steps: list[tuple[int, str]] = field(default_factory=lambda: [(-1, "")])
    numbers: dict[tuple[int, str], int] = field(default_factory=dict)

    def number(self, above: int, step: str) -> int:
        found = self.numbers.setdefault((above, step), len(self.steps))
        if found == len(self.steps):
            self.steps.append((above, step))
        return found

    def path(self, number: int) -> str:
        steps = []
        while number > 0:
            number, step = self.steps[number]
            steps.append(step)
        return ">".join(reversed(steps))

    def known(self, path: str) -> int:
        """Number of a path, -1 if the page has no such path."""
        at = 0
        for step in path.split(">"):
            at = self.numbers.get((at, step), -1)
            if at < 0:
                return -1
        return at

    def summed(self, own: list[int]) -> list[int]:
        """Sums over every box and the boxes in it; a box comes after the one it lies in."""
        for i in range(len(own) - 1, 0, -1):
            own[self.boxes[i].above] += own[i]
        return own


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw.strip(" /\n\t\r") else {}


def _name_parts(value: str) -> set[str]:
    return {p.lower() for p in _PARTS.findall(value)}


def _signature(tag: str, attrs: dict[str, str]) -> str:
    classes = sorted({re.sub(r"\d+", "#", c).replace(">", "") for c in attrs.get("class", "").split()})
    return ".".join([tag, *classes[:4]])


#: A mark that a box around the page may have by chance, and one that holds anywhere.
_LOOSE, _FIRM = 1, 2


#: Of these names, a box inside the article may be the head of it, as a header element may.
_HEADS = frozenset({"header"})


def _named(attrs: dict[str, str], inside: bool = False) -> bool:
    names = _NAMES - _HEADS if inside else _NAMES
    return bool(names & (_name_parts(attrs.get("class", "")) | _name_parts(attrs.get("id", ""))))


def _mark(tag: str, attrs: dict[str, str], inside: bool) -> int:
    if tag in _ASIDE or (tag == "header" and not inside):
        return _FIRM
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", "")):
        return _FIRM
    role = attrs.get("role", "").lower()
    if role in _ROLES:
        return _FIRM
    if tag == "form" or role == "form":
        return _LOOSE
    return _LOOSE if tag not in ("article", "main", "body", "html") and _named(attrs, inside) else 0


def read(text: str) -> Page:
    """Blocks in page order and the elements they lie in."""
    page = Page()
    boxes = page.boxes
    boxes.append(Box("", 0, -1, 0, 0))
    stack: list[tuple[str, int]] = [("", 0)]  # open elements: tag, box
    count: dict[str, int] = {}  # open elements by tag
    links = 0
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            body = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if body:
                page.blocks.append((body, min(linked, len(body)), stack[-1][1]))
            parts.clear()
        linked = 0

    def close(k: int) -> None:
        """Close open elements from the k-th on."""
        nonlocal links
        if any(t not in _INLINE for t, _ in stack[k:]):
            flush()
        for t, b in reversed(stack[k:]):
            links -= t == "a"
            count[t] -= 1
            if t not in _INLINE:
                boxes[b].end = len(page.blocks)
        del stack[k:]

    at = 0
    size = len(text)
    while at < size:
        cut = text.find("<", at)
        if cut < 0:
            cut = size
        if cut > at:
            parts.append(text[at:cut])
            if links > 0:
                linked += cut - at
            at = cut
        if at >= size:
            break
        m = _TAG.match(text, at)
        if not m:
            parts.append("<")
            at += 1
            continue
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "br":
                parts.append(" ")
                continue
            if not count.get(tag) and not count.get(tag + "!"):
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in (tag, tag + "!"):
                    close(k)
                    break
                if tag in _INLINE and stack[k][0].rstrip("!") not in _INLINE:
                    break
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(text, at)
            parts.append(" ")
            at = end.end() if end else size
            continue
        if tag in _VOID:
            if tag not in ("wbr", "img"):
                parts.append(" ")
            if tag == "hr":
                flush()
            continue
        raw = m[3] if m[2] else m[6]
        if tag in _INLINE:
            attrs = _attributes(raw) if raw else {}
            if attrs and (mark := _mark(tag, attrs, True)):
                flush()
                above = stack[-1][1]
                boxes.append(Box(tag, boxes[above].path, above, boxes[above].depth + 1, mark, begin=len(page.blocks), inside=boxes[above].inside))
                # Its own block: hidden or foreign text must not run into the article's.
                stack.append((tag + "!", len(boxes) - 1))
                count[tag + "!"] = count.get(tag + "!", 0) + 1
                continue
            stack.append((tag, stack[-1][1]))
            count[tag] = count.get(tag, 0) + 1
            links += tag == "a"
            continue
        if tag in _ENDS_P and count.get("p"):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] not in _INLINE:
                    break
        if tag in _SIBLING and any(map(count.get, _SIBLING[tag][0])):
            same, bounds = _SIBLING[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in bounds:
                    break
                if stack[k][0] in same:
                    close(k)
                    if tag != "tr":
                        break
        flush()
        attrs = _attributes(raw) if raw else {}
        above = stack[-1][1]
        box = boxes[above]
        inside = box.inside or box.tag in ("article", "main")
        number = page.number(box.path, _signature(tag, attrs))
        head = tag in ("h1", "main") or (tag == "article" and not _named(attrs))
        boxes.append(Box(tag, number, above, box.depth + 1, _mark(tag, attrs, inside), head, begin=len(page.blocks), inside=inside))
        stack.append((tag, len(boxes) - 1))
        count[tag] = count.get(tag, 0) + 1
    flush()
    for _, b in stack:
        boxes[b].end = len(page.blocks)
    _judge(page)
    return page


#: A loosely marked box with more than this share of the page's prose may be one around the page.
_AROUND = 0.5
#: Less prose than this outside of it is no article.
_REST = 0.1


def _prose(body: str, linked: int) -> int:
    return 0 if 2 * linked > len(body) else len(body) - linked


def _judge(page: Page) -> None:
    """What is not part of the article: boxes with a mark and all in them. A loose mark does not count on a box with most of
    the page's prose, unless the article is seen to be outside: its heading is, and more than a little prose."""
    boxes = page.boxes
    if any(b.mark == _LOOSE for b in boxes):
        _look_around(page)
    for box in boxes[1:]:
        box.out = box.mark > 0 or boxes[box.above].out


def _look_around(page: Page) -> None:
    """Take loose marks off boxes around the page."""
    boxes = page.boxes
    firm = [False] * len(boxes)
    for i, box in enumerate(boxes[1:], 1):
        firm[i] = box.mark == _FIRM or firm[box.above]
    own = [0] * len(boxes)
    for body, linked, b in page.blocks:
        own[b] += 0 if firm[b] else _prose(body, linked)
    held = page.summed(list(own))
    heads = page.summed([int(box.head and not firm[i]) for i, box in enumerate(boxes)])
    # Boxes with more than half lie in each other: a chain, from the outermost on.
    chain = [i for i, box in enumerate(boxes) if box.mark == _LOOSE and not firm[i] and held[i] > _AROUND * held[0]]
    place = {i: k for k, i in enumerate(chain)}
    # Prose that no other mark takes, by the number of boxes of the chain around it.
    other, depth, outside = [False] * len(boxes), [0] * len(boxes), [0] * (len(chain) + 1)
    for i, box in enumerate(boxes):
        if i:
            other[i], depth[i] = other[box.above], depth[box.above]
        if i in place:
            depth[i] += 1
        elif box.mark:
            other[i] = True
        if not other[i]:
            outside[depth[i]] += own[i]
    rest, stays = 0, False
    for k, i in enumerate(chain):
        # What lies outside of the first box that keeps its mark is not taken by the chain.
        rest += 0 if stays else outside[k]
        if heads[i] or not heads[0] or rest < _REST * held[0]:
            boxes[i].mark = 0
        else:
            stays = True


def _weigh(page: Page) -> None:
    """Prose and linked characters in every box."""
    prose, other = [0] * len(page.boxes), [0] * len(page.boxes)
    for body, linked, b in page.blocks:
        n = 0 if page.boxes[b].out else _prose(body, linked)
        prose[b] += n
        other[b] += len(body) - n if not n else linked
    for box, n, k in zip(page.boxes, page.summed(prose), page.summed(other)):
        box.prose, box.linked = n, k


_CONTAINERS = frozenset("article main section div td body html center blockquote".split())
_WHOLE = 0.8


def votes(page: Page) -> list[tuple[str, float]]:
    """Path of the page's container that holds most of its prose, with its score: of several, the deeper one and the one with the
    larger share of prose; an article element counts for more. Such containers lie in each other; of equal ones the outer."""
    found = _vote(page)
    return [(page.path(found[0]), found[1])] if found else []


def _vote(page: Page) -> tuple[int, float] | None:
    _weigh(page)
    total = page.boxes[0].prose
    best = None
    for box in page.boxes[1:] if total else ():
        if box.tag in _CONTAINERS and not box.out and box.prose >= _WHOLE * total:
            pure = box.prose / (box.prose + box.linked)
            score = box.prose / total + pure + 0.05 * min(box.depth, 20) + (0.5 if box.tag in ("article", "main") else 0)
            if best is None or score > best[1]:
                best = box.path, score
    return best


#: Share of a page's prose that a host's path must hold to be taken. It need not be most of it; of a main element, which a
#: page has one of, less will do.
_SHARE, _MAIN_SHARE = 0.3, 0.1


def extract(text: str, paths: list[str]) -> tuple[str, str]:
    """The article's text and the path it was taken from: the first of the paths that holds enough of the page's prose, or
    else the page's own best."""
    page = read(text)
    own = _vote(page)
    if own is None:
        # No prose that stands out: whatever is not foreign to the article.
        return " ".join(b for b, _, x in page.blocks if not page.boxes[x].out), ""
    have: dict[int, int] = {}
    enough: dict[int, float] = {}
    for b in page.boxes[1:]:
        if b.prose and not b.out:
            have[b.path] = have.get(b.path, 0) + b.prose
            enough[b.path] = (_MAIN_SHARE if b.tag == "main" else _SHARE) * page.boxes[0].prose
    path = next((p for p in map(page.known, paths) if have.get(p, 0) >= enough.get(p, 1)), own[0])
    held = [box.path == path for box in page.boxes]
    for i, box in enumerate(page.boxes[1:], 1):
        held[i] = held[i] or held[box.above]
    return " ".join(body for body, _, x in page.blocks if held[x] and not page.boxes[x].out), page.path(path)


def host(url: Column) -> Column:
    """Host of an address, in lower case and without port and user; '' if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


_VOTES = StructType([StructField("host", StringType()), StructField("path", StringType()), StructField("score", DoubleType())])


def consensus(df: DataFrame, url: str = "url", html: str = "html", paths: int = PATHS) -> DataFrame:
    """(host, paths): the paths of every host, most votes first; of equal ones the first by name."""
    source = df.select(host(col(url)).alias("host"), col(html).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "t"):
                out: list[tuple[str, str, float]] = []
                for name, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    out += [(name, p, s) for p, s in votes(read(text or ""))[:1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()),
                     pa.array([o[2] for o in out], pa.float64())], names=["host", "path", "score"])

    counted = source.mapInArrow(run, _VOTES).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("host").orderBy(F.desc("n"), "path")
    best = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= paths)
    return best.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"]).alias("paths"))


def articles(df: DataFrame, keep=None, url: str = "url", html: str = "html", paths: int = PATHS) -> DataFrame:
    """``keep`` (all columns unless given) with ``text`` and ``path``."""
    fields = StructType([StructField("text", StringType()), StructField("path", StringType())])
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("text", "path")]
    schema = StructType([*[StructField(c, df.schema[c].dataType, True) for c in kept], *fields.fields])
    # Written, so that Spark knows its size: a small table of paths is sent to the pages, a large one is exchanged.
    known = materialize(consensus(df, url, html, paths), "paths")
    source = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(kept)], col(html).cast("string").alias("t"), host(col(url)).alias("host"))
    joined = source.join(known, "host", "left").select(*[f"k{i}" for i in range(len(kept))], "paths", "t")
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "t"):
                got = [extract(t or "", p or []) for t, p in zip(piece.columns[-1].to_pylist(), piece.columns[-2].to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:-2], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=names)

    return joined.mapInArrow(run, schema)
