"""Main text of web pages by paths that the pages of a host agree on.

First pass: each page's containers are scored by the running text in them, and
the page votes for the generalised tag-class path of its best one.  Spark
counts the votes per host.  Second pass: a page's text is taken from the
elements at its host's winning path; a page without such an element uses its
own best container.  Both passes read a page alone, so a host of any size is
only counted, never gathered; the winning paths lie in files by the hash of the
host, and a task reads those that its pages need.

An element that a word in its class marks as something else (a sidebar, say) is
left out, unless it holds most of the page's text and a page's main parts too:
then the word describes the page's layout.  Work and memory follow a page's
length, however deep its elements lie.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .storage import read_file, write_file

# Fixed values of HTML: elements by how a parser treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "noframes", "xmp")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold no part of an article.
DROPPED = frozenset(
    "head title nav footer aside form button select option input textarea script style noscript template iframe object "
    "svg canvas audio video map dialog menu noframes label".split()
)
#: Words in class, id or role that mark what isn't the article.
DROPPED_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|side|widget\w*|menu\w*|nav\w*|breadcrumbs?|"
    r"comments?|commentlist|disqus|respond|replies|reply|discussion|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|"
    r"newsletter|subscri\w*|signup|login|share|sharing|social|related|recommend\w*|footer|foot|masthead|pagination|pager|"
    r"toolbar|search\w*|form|hidden|complementary|contentinfo|dialog|feedback|rating|outbrain|taboola|skip|site-?header|page-?header|"
    r"top-?bar|header|tags?|print-only)(?:$|[^a-z])"
)
#: Words in class, id or role that mark the article.
GOOD_WORDS = re.compile(r"(?:^|[^a-z])(?:article\w*|main|content|post|entry|story|text|body|hentry)(?:$|[^a-z])")
#: Words that mark what readers wrote; such an element needs a page's heading in it to be more than that.
READERS = re.compile(r"(?:^|[^a-z])(?:comments?|commentlist|disqus|respond|replies|reply|discussion)(?:$|[^a-z])")
#: An article's own heading, whose class would read like a page's header.
OWN_HEADER = re.compile(r"(?:^|[^a-z])(?:article|entry|post|story|content|main)-?(?:header|head|title)(?:$|[^a-z])")
#: Hosts in a file of paths, about, and files that a worker remembers.
FILE_HOSTS, REMEMBERED_FILES = 2_000, 64

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?=>|$)|[^>]*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
DIGITS = re.compile(r"\d+")


@dataclass
class Element:
    tag: str
    step: str
    parent: "Element | None"
    dropped: bool
    prior: float
    order: int
    soft: bool = False  # a word in its class alone marks it
    inside: bool = False  # an article or main part
    key: int = 0  # of its path
    own: float = 0.0  # what the blocks right below are worth to a container
    score: float = 0.0
    mass: int = 0  # running text below
    main: int = 0  # a page's main part: 1 for an article or the like, 2 for its heading or main element
    readers: bool = False  # marked as what readers wrote
    out: bool = False  # not part of the article, itself or by what is around it
    wanted: bool = False


@dataclass
class Page:
    """A page's blocks in order, (text, chars inside links, the element around it), and its block elements."""

    blocks: list[tuple[str, int, Element]] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)


def host_of(url: str | None) -> str:
    """A page's host in lower case, without a leading www; '' if there is none."""
    try:
        host = urlsplit(url or "").hostname or ""
    except ValueError:
        host = ""
    return host.removeprefix("www.")


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A path's step: the tag and its classes, digits generalised."""
    classes = sorted({DIGITS.sub("0", c) for c in attributes.get("class", "").lower().split()})
    return ".".join([tag, *classes])


def _hidden(attributes: dict[str, str], raw: str) -> bool:
    style = attributes.get("style", "").replace(" ", "").lower()
    return "display:none" in style or "visibility:hidden" in style or attributes.get("aria-hidden") == "true" or bool(
        re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", raw)
    )


def parse(source: str) -> Page:
    """Blocks and elements of a page; badly nested and cut-off markup included."""
    page = Page()
    root = Element("", "", None, False, 1.0, 0)
    page.elements.append(root)
    stack = [root]
    said: list[str] = []
    linked = in_link = 0
    at, n = 0, len(source)

    def flush() -> None:
        nonlocal said, linked
        if said:
            text = " ".join(html.unescape("".join(said)).split())
            if text:
                page.blocks.append((text, min(linked, len(text)), stack[-1]))
        said, linked = [], 0

    def close_until(depth: int) -> None:
        nonlocal in_link
        for element in stack[depth:]:
            if element.tag == "a":
                in_link -= 1
        del stack[depth:]

    while at < n:
        match = TOKEN.search(source, at)
        text = source[at : match.start()] if match else source[at:]
        if text:
            said.append(text)
            if in_link:
                linked += len(text)
        if not match:
            break
        at = match.end()
        tag = match[2]
        if not tag:
            if match[0].startswith("<![CDATA["):
                said.append(match[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        block = tag in BLOCKS
        if match[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if block or stack[depth].soft or stack[depth].dropped != stack[depth].parent.dropped:
                        flush()
                    close_until(depth)
                    break
                if not block and stack[depth].tag in BLOCKS:
                    break
            else:
                if block:
                    flush()
            continue
        if tag == "br":
            said.append(" ")
            continue
        if tag in VOID:
            if block:
                flush()
            continue
        raw = match[3] or ""
        attributes = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)} if "=" in raw else {}
        if block:
            flush()
            for depth in range(len(stack) - 1, 0, -1):  # what the new element ends
                open_tag = stack[depth].tag
                if open_tag == "p" or open_tag in HEADINGS and tag in HEADINGS or open_tag == tag and tag in ("li", "dd", "dt", "tr", "td", "th"):
                    close_until(depth)
                    break
                if open_tag in BLOCKS:
                    break
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = end.end() if end else n
            continue
        parent = stack[-1]
        names = " ".join(attributes.get(k, "") for k in ("class", "id", "role")).lower().replace("_", "-")
        drop, soft = parent.dropped or tag in DROPPED or _hidden(attributes, raw), False
        if not drop and tag not in ("html", "body", "main") and names:
            own = parent.inside and OWN_HEADER.search(names)
            if tag == "article":
                soft = bool(re.search(r"(?:^|[^a-z])(?:comments?|reply|related|promo|ads?|sponsored)(?:$|[^a-z])", names))
            else:
                soft = not own and bool(DROPPED_WORDS.search(names))
        drop = drop or tag == "header" and not parent.inside
        if not block and (drop or soft) and not parent.dropped:
            flush()
        prior = 1.5 if tag in ("article", "main") else 1.25 if names and GOOD_WORDS.search(names) else 1.0
        element = Element(tag, _step(tag, attributes) if block else "", parent, drop, prior, len(page.elements), soft, parent.inside or tag in ("article", "main"))
        element.key = hash((parent.key, element.step)) if block else parent.key
        element.main = 2 if tag in ("main", "h1") else 1 if prior > 1 else 0
        element.readers = soft and bool(READERS.search(names))
        if block or soft:
            page.elements.append(element)
        stack.append(element)
        if tag == "a":
            in_link += 1
    flush()
    _settle(page)
    return page


def _above(element: Element) -> Element | None:
    """The nearest element above that the page lists."""
    element = element.parent
    while element is not None and not (element.tag in BLOCKS or element.soft or element.parent is None):
        element = element.parent
    return element


def _settle(page: Page) -> None:
    """Decide what is not the article: marked elements, unless they hold most of the text and main parts."""
    total = 0
    for text, linked, element in page.blocks:
        if not element.dropped:
            listed = element if element.tag in BLOCKS or element.soft or element.parent is None else _above(element)
            listed.mass += len(text) - linked
            total += len(text) - linked
    holds = [0] * len(page.elements)  # main parts below
    at = {id(e): k for k, e in enumerate(page.elements)}
    for k in range(len(page.elements) - 1, 0, -1):
        above = at[id(_above(page.elements[k]))]
        page.elements[above].mass += page.elements[k].mass
        own = 0 if page.elements[k].dropped or page.elements[k].soft else page.elements[k].main
        holds[above] = max(holds[above], holds[k], own)
    for k, element in enumerate(page.elements):
        if element.soft and max(holds[k], element.main) > element.readers and 2 * element.mass > total:
            element.soft = False
        element.out = element.dropped or element.soft or k > 0 and page.elements[at[id(_above(element))]].out


def _out(element: Element) -> bool:
    """Whether a block inside an element is left out."""
    while element is not None and not (element.tag in BLOCKS or element.out or element.parent is None):
        if element.dropped or element.soft:
            return True
        element = element.parent
    return element is not None and element.out


#: Elements that are too small to be an article's container.
SMALL = HEADINGS | frozenset("p li blockquote pre dd dt ul ol dl".split())


def _container(element: Element | None) -> Element | None:
    """An element, or the nearest one around it, that can hold an article."""
    while element is not None and (element.tag not in BLOCKS or element.tag in SMALL):
        element = element.parent
    return element


def best(page: Page) -> Element | None:
    """The container with the most running text about it: whole for blocks right inside, a half, a quarter, an eighth farther out."""
    mass: dict[int, int] = {}
    for text, linked, element in page.blocks:
        container = _container(element)
        if container is None or _out(element):
            continue
        container.own += (len(text) - linked) * (1.0 if len(text) >= 25 else 0.3)
        mass[container.order] = mass.get(container.order, 0) + len(text) - linked
    holders = [e for e in page.elements if e.tag in BLOCKS and e.tag not in SMALL]
    far: dict[int, float] = {}
    for element in reversed(holders):  # children come after their parents
        below = far[element.order] = far.get(element.order, 0.0) + element.own
        above = _container(element.parent)
        if above is not None:
            far[above.order] = far.get(above.order, 0.0) + below
            mass[above.order] = mass.get(above.order, 0) + mass.get(element.order, 0)
        # the nearest three count more than an eighth
        near, share = element, 1.0
        for _ in range(3):
            if near is None or not element.own:
                break
            near.score += element.own * (share - 0.125)
            near, share = _container(near.parent), share / 2
    found, most = None, 0.0
    for element in holders:
        element.score = (element.score + far[element.order] * 0.125) * element.prior
        if element.score > most:
            found, most = element, element.score
    around, climbed = found, found
    while around is not None:  # an article's section votes for the article
        around_mass = mass.get(around.order, 0)
        if around.tag in ("article", "main") or around.prior > 1 and around.tag not in ("body", "html") and around_mass <= 4 * mass.get(found.order, 0):
            climbed = around
            if around.tag == "article":
                break
        around = around.parent
    return climbed


def path_of(element: Element) -> str:
    """The steps of all block elements down to this one."""
    steps = []
    while element is not None:
        if element.step:
            steps.append(element.step)
        element = element.parent
    return "/" + "/".join(reversed(steps))


def key_of(path: str) -> int:
    """The key that an element at a path has in this process."""
    key = 0
    for step in path.split("/")[1:]:
        key = hash((key, step))
    return key


def extract(source: str | None, path: str | None) -> str:
    """The text at a path, or in the page's own best container."""
    if not source:
        return ""
    page = parse(source)
    key = key_of(path) if path else None
    if key is None or not any(e.key == key and e.step and not e.out for e in page.elements):
        own = best(page)
        key = own.key if own is not None else None
    for element in page.elements[1:]:
        above = _above(element)
        element.wanted = above.wanted or bool(element.step) and element.key == key
    if key is None:
        page.elements[0].wanted = True
        for element in page.elements[1:]:
            element.wanted = True

    def inside(element: Element) -> bool:
        listed = element if element.tag in BLOCKS or element.soft or element.parent is None else _above(element)
        return listed.wanted

    return "\n\n".join(text for text, _, element in page.blocks if inside(element) and not _out(element))


def vote(source: str | None) -> tuple[str | None, float]:
    found = best(parse(source)) if source else None
    return (path_of(found), float(found.mass)) if found is not None else (None, 0.0)


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): each host's path with the most votes, then the most text, then the first by name."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts = [host_of(url) for url in batch.column(0).to_pylist()]
        votes = [vote(source) for source in batch.column(1).to_pylist()]
        columns = [pa.array(hosts, pa.string()), pa.array([v[0] for v in votes], pa.string()), pa.array([int(v[1]) for v in votes], pa.int64())]
        return pa.record_batch(columns, names=["host", "path", "chars"])

    votes = common.map_batches(pages.select("url", "html"), run, "host string, path string, chars long")
    counted = votes.where("path is not null").groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("chars").alias("chars"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("chars"), "path")
    return counted.withColumn("place", F.row_number().over(order)).where("place = 1").select("host", "path")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    `pages` needs page_id, url and html; other columns are not read.  A null
    or empty html has the text ''.  Pages without a usable url share the host
    ''.  Repeated rows vote and are extracted one by one.  Of paths with equal
    votes and text the first by name wins.  A page of any length and depth is
    read whole, in time and memory that follow its length.  No rows give none.
    """
    spark = pages.sparkSession
    folder = common.work_dir(spark, "host-paths")
    chosen = common.written(host_paths(pages), "paths")
    files = max(1, chosen.count() // FILE_HOSTS)

    def place(bucket: int) -> str:
        return f"{folder}/paths-{bucket:08d}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[str, str]] = {}
        for batch in batches:
            for bucket, host, path in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, {})[host] = path
        for bucket, paths in held.items():
            write_file(place(bucket), json.dumps(paths).encode())
            yield pa.record_batch([pa.array([bucket], pa.int32())], names=["bucket"])

    keyed = chosen.select(F.pmod(F.crc32("host"), F.lit(files)).cast("int").alias("bucket"), "host", "path")
    keyed.repartition(max(1, files // 16), "bucket").mapInArrow(write, "bucket int").agg(F.count("*")).collect()  # one number

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = common.resident(("paths", folder), dict)
        texts = []
        for url, source in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            host = host_of(url)
            bucket = zlib.crc32(host.encode("utf-8", "surrogatepass")) % files
            if bucket not in known:
                if len(known) >= REMEMBERED_FILES:
                    known.clear()
                try:
                    known[bucket] = json.loads(bytes(read_file(place(bucket))))
                except FileNotFoundError:  # no host there has a path
                    known[bucket] = {}
            texts.append(extract(source, known[bucket].get(host)))
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])

    return common.map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
