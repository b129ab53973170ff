"""HTML extraction by consensus host paths.

Each page's containers are scored by the prose in them; a page votes for the path of its best container, a chain of tags with
their classes in general form. The votes of a host are counted in Spark; the paths with a large enough share of them win, so that
a host may have several templates. Every page is read again by a winning path: that of its own best container if it is one, else
the one with the most votes that the page has. A page that has none is read by its own best container.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small_batches, table

# Kinds of HTML elements, and words of class and id names.
RAW = "script|style|textarea|title|iframe|noembed|noframes|xmp|template|noscript"
#: Noise elements; one that its own end tag doesn't close holds nothing, so that it can't take the rest of the page along.
EMBEDS = frozenset("svg math select object canvas video audio".split())
FOREIGN = frozenset("svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
CONTAINERS = frozenset("article main section div td body center blockquote".split())
DROPPED = frozenset("nav aside footer button menu dialog label input head".split())
CLOSES_P = BLOCKS - {"body", "html"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl select html body".split())
NOISE = frozenset("ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored banner cookie cookies consent gdpr notice notices alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar side widget widgets share sharing social related recommended recommendations comment comments commentlist respond disqus discussion newsletter subscribe subscription signup login footer masthead topbar toolbar pagination pager promo promotion tags toc skip hidden print outbrain taboola".split())
PROSE = frozenset("article articlebody post entry content story main text body title headline".split())
COMMENTS = frozenset("comment comments commentlist respond disqus discussion".split())
POSTS = frozenset("article articlebody post entry story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|(?P<open><(?P<raw>{RAW})(?=[\s/>])(?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*+>)(?:.*?</(?P=raw)(?=[\s/>])[^>]*>|.*\Z)|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*+)>|<[!?/][^>]*>|<[!?/a-z][^>]*\Z", re.IGNORECASE | re.DOTALL)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.DOTALL)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


#: A path wins that has this share of its host's votes.
WIN = 0.2
#: An element whose names speak of noise isn't noise if it has this share of the page's prose and what nothing speaks against has
#: less than FEW of it in sentences, or if it has that share and an article inside.
MOST, MUCH, FEW = 0.5, 0.3, 0.1
#: Characters of a block that may be a sentence.
SENTENCE = 40
#: How sure it is that an element is noise: by what it is, or by its names.
SURE, NAMED, NAMED_COMMENTS = 3, 2, 1


class Element:
    """path is a hash of the chain of steps; inner says that this is an article or main part that nothing speaks against; head that it
    is a header; post that it is, or is in, an article; linked that its text is a link's."""

    __slots__ = ("tag", "path", "noise", "parent", "prose", "links", "bonus", "inner", "near", "head", "post", "linked")

    def __init__(self, tag: str, path: int, noise: int, parent: int, bonus: float, inner: bool, head: bool = False, post: bool = False, linked: bool = False):
        self.tag, self.path, self.noise, self.parent, self.bonus, self.inner = tag, path, noise, parent, bonus, inner
        self.head, self.post, self.linked = head, post, linked
        self.prose = self.links = 0.0


def _kind(tag: str, attrs: str) -> tuple[str, int, float, bool, bool]:
    """A tag's step in a path, how sure it is that what it holds is noise, how much its names speak for an article, whether it is a
    header that isn't named as an article's, and whether it is an article."""
    bonus = 25.0 if tag == "article" else 10.0 if tag == "main" else 0.0
    sure = SURE if tag in DROPPED or tag in EMBEDS else NAMED if tag == "form" else 0
    if not attrs.strip():
        return tag, sure or NAMED * (tag == "header"), bonus, tag == "header", tag in ("article", "main")
    have = {}
    for k, a, b, c, alone in _ATTR.findall(attrs):
        have.setdefault((k or alone).lower(), a or b or c)
    names = f"{have.get('class', '')} {have.get('id', '')}"
    own = {x.lower() for x in _NAME.findall(names)}
    prose = own & PROSE or "articlebody" in have.get("itemprop", "").lower()
    if "hidden" in have or have.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", have.get("style", "")) is not None:
        sure = SURE
    elif sure < NAMED and (own & NOISE and not (prose and not own & {"ad", "ads", "comment", "comments", "related", "share"}) or have.get("role", "").lower() in ROLES):
        sure = NAMED_COMMENTS if own & COMMENTS else NAMED
    step = ".".join([tag, *sorted({re.sub(r"\d+", "#", x) for x in have.get("class", "").split()})])
    post = tag in ("article", "main") or bool(own & POSTS)
    head = not sure and not own & POSTS and (tag == "header" or "header" in own and tag in BLOCKS)
    return step, 0 if tag in ("html", "body") else NAMED if head else sure, bonus + (15.0 if prose else 0.0), head, post


def parse(page: str) -> tuple[list[Element], list[tuple[int, str | None]]]:
    """Elements of a page and its stream: (element, text), or (element, None) where a block begins or ends. Element 0 is the page."""
    elements, stream, unclosed = _parse(page, frozenset())
    if unclosed:
        elements, stream, _ = _parse(page, frozenset(unclosed))
    _judge(elements, stream)
    return elements, stream


def _titled(elements: list[Element], i: int) -> bool:
    """Whether the block of an element is a heading."""
    while elements[i].tag not in BLOCKS and i:
        i = elements[i].parent
    return elements[i].tag in HEADINGS


def _judge(elements: list[Element], stream: list[tuple[int, str | None]]) -> None:
    """Settle which elements are noise. Names are believed unless the element holds most of the page's prose and little is left
    without it; comments have to hold an article besides. Headers are noise but for an article's own with a heading in it. Lists of
    several links that hold nothing else are menus. What stands in noise is noise. Parents come before their children in the list."""
    n = len(elements)
    size, inner, heading, plain, anchors = [0] * n, [e.inner for e in elements], [e.tag in HEADINGS for e in elements], [False] * n, [0] * n
    sentences, held, owner, ends = [0] * n, 0, 0, False
    for i, raw in [*stream, (0, None)]:
        if raw is None:
            if held >= SENTENCE and ends and not _titled(elements, owner):
                sentences[owner] += held
            held, ends = 0, False
        elif raw and (length := len(raw.strip())):
            if elements[i].linked:
                anchors[i] += 1
            else:
                size[i] += length
                plain[i] = plain[i] or re.search(r"\w", html.unescape(raw)) is not None
                owner = owner if held else i
                held += length
                ends = ends or re.search(r"[.,;:!?。]", raw) is not None
    for i in range(n - 1, 0, -1):
        e = elements[i]
        up = e.parent
        anchors[up] += anchors[i]
        plain[up] = plain[up] or plain[i]
        if e.tag in LISTS and anchors[i] > 1 and not plain[i]:
            e.noise = SURE
        if e.noise == SURE:
            size[i], inner[i], heading[i], sentences[i] = 0, False, False, 0
        size[up] += size[i]
        inner[up] = inner[up] or inner[i]
        heading[up] = heading[up] or heading[i]
        if not e.noise:
            sentences[up] += sentences[i]
    clean = sentences[0]
    for i, e in enumerate(elements):
        if e.head and elements[e.parent].post and heading[i]:
            e.noise = 0
        elif e.noise in (NAMED, NAMED_COMMENTS):
            share = size[i] / max(size[0], 1)
            if share >= MUCH and inner[i] or share >= MOST and e.noise == NAMED and clean < FEW * size[0]:
                e.noise = 0
                clean += sentences[i]
        if i and elements[e.parent].noise:
            e.noise = SURE
        e.near = i if e.tag in CONTAINERS else elements[e.parent].near if i else 0


def _parse(page: str, hollow: frozenset[int]) -> tuple[list[Element], list[tuple[int, str | None]], list[int]]:
    """What parse() returns, the elements of `hollow` holding nothing; EMBEDS that their own end tags don't close."""
    elements, stream, stack, at = [Element("", 0, 0, 0, 0.0, False)], [], [0], 0
    embeds, unclosed, open_ = [], [], Counter()

    def text(until: int) -> None:
        if until > at and (raw := page[at:until]):
            stream.append((stack[-1], raw))

    def close(to: int, ended: bool = False) -> None:
        while len(stack) > to:
            i = stack.pop()
            open_[elements[i].tag] -= 1
            if elements[i].tag in EMBEDS:
                embeds.pop()
                if not ended or len(stack) > to:
                    unclosed.append(i)
            elif elements[i].tag in BLOCKS and not embeds:
                stream.append((stack[-1], None))

    while m := _TOKEN.search(page, at):
        text(m.start())
        at = m.end()
        if m["raw"] and m["open"].endswith("/>") and embeds and elements[embeds[-1]].tag in FOREIGN:
            at = m.end("open")
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if not open_[tag]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if elements[stack[k]].tag == tag:
                    close(k, True)
                    break
            continue
        if tag in VOID:
            # a line break parts words, a rule parts blocks
            stream.append((stack[-1], None if tag == "hr" and not embeds else " ") if tag in ("br", "hr") else (stack[-1], ""))
            continue
        if tag in CLOSES_P and open_["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if elements[stack[k]].tag == "p":
                    close(k)
                    break
                if elements[stack[k]].tag in BLOCKS or elements[stack[k]].tag in EMBEDS:
                    break
        if tag in SIBLINGS and any(open_[x] for x in SIBLINGS[tag]):
            for k in range(len(stack) - 1, 0, -1):
                if elements[stack[k]].tag in SIBLINGS[tag]:
                    close(k)
                    break
                if elements[stack[k]].tag in SCOPES or elements[stack[k]].tag in EMBEDS:
                    break
        step, noise, bonus, head, post = _kind(tag, m["attrs"])
        up = elements[stack[-1]]
        # formatting elements are no part of a path: they are left open by mistake too often
        path = xxhash.xxh64_intdigest(step, up.path) if tag in BLOCKS else up.path
        elements.append(Element(tag, path, noise, stack[-1], bonus, tag in ("article", "main") and not noise, head, post or up.post, tag == "a" and "href" in m["attrs"].lower() or up.linked and tag not in BLOCKS))
        if tag in BLOCKS and not embeds:
            stream.append((stack[-1], None))
        if (not m["attrs"].endswith("/") or tag in BLOCKS or tag in EMBEDS - FOREIGN) and len(elements) - 1 not in hollow:
            stack.append(len(elements) - 1)
            open_[tag] += 1
            if tag in EMBEDS:
                embeds.append(stack[-1])
    text(len(page))
    return elements, stream, unclosed + embeds


def blocks(elements: list[Element], stream: list[tuple[int, str | None]], inside: set[int] | None = None) -> Iterator[tuple[int, str, int]]:
    """(element, text, characters in links) of each block that is not noise, inside the given elements. Blocks of several links with
    nothing but marks between them are menus, other than headings."""
    own, held, owner, links, anchors, others = {0: inside is None or 0 in inside}, [], 0, 0, set(), []

    def within(i: int) -> bool:
        chain = []
        while i not in own:
            if i in inside:
                own[i] = True
                break
            chain.append(i)
            i = elements[i].parent
        for x in chain:
            own[x] = own[i]
        return own[chain[0]] if chain else own[i]

    for i, raw in [*stream, (0, None)]:
        if raw is None:
            if held and (text := " ".join(html.unescape("".join(held)).split())):
                if len(anchors) < 2 or _titled(elements, owner) or re.search(r"\w", html.unescape(" ".join(others))):
                    yield owner, text, links
            held, links, anchors, others = [], 0, set(), []
        elif raw and not elements[i].noise and (inside is None or within(i)):
            if not held:
                owner = i
            held.append(raw)
            if elements[i].linked:
                links += len(raw.strip())
                anchors.add(i)
            else:
                others.append(raw)


def best_container(elements: list[Element], stream: list[tuple[int, str | None]]) -> int:
    """The container with the most prose: a block counts for the nearest container and by half for the one around it."""
    for i, text, links in blocks(elements, stream):
        worth = len(text) * (1 - min(1.0, links / len(text))) + 20 * len(re.findall(r"[,.;:!?]", text)) if len(text) > links else 0.0
        share, i = 1.0, elements[i].near
        while i > 0 and share > 0.2:
            elements[i].prose += share * worth
            elements[i].links += share * links
            share, i = share / 2, elements[elements[i].parent].near
    best = max(range(len(elements)), key=lambda i: (elements[i].prose and elements[i].prose / (1 + elements[i].links / (elements[i].prose + 1)) * (1 + elements[i].bonus / 20), -i))
    return best if elements[best].prose > 0 else 0


def _signed(path: int) -> int:
    return path - (1 << 64) if path >> 63 else path


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, sizes = [], [], []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if page:
                elements, stream = parse(page)
                best = elements[best_container(elements, stream)]
                if best.path:
                    hosts.append(host)
                    paths.append(_signed(best.path))
                    sizes.append(int(best.prose))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.int64()), pa.array(sizes, pa.int64())], ["host", "path", "size"])


def main_text(page: str | None, paths: list[int] | None) -> str:
    """The blocks of the outermost elements with one of the host's paths; of the page's best container where there are none."""
    if not page:
        return ""
    elements, stream = parse(page)
    best = best_container(elements, stream)
    mine = _signed(elements[best].path)
    for path in [mine] if mine in (paths or []) else paths or []:
        chosen = {i for i, e in enumerate(elements) if e.tag in CONTAINERS and not e.noise and _signed(e.path) == path}
        if chosen and (text := "\n".join(t for _, t, _ in blocks(elements, stream, chosen))):
            return text
    return "\n".join(t for _, t, _ in blocks(elements, stream, {best}))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page, paths) for page, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def winning_paths(votes: DataFrame) -> DataFrame:
    """(of, paths): each host's paths with a share of at least WIN of its votes, so 1 / WIN at most, those with more votes first.
    Paths with equally many votes: more prose, then the lesser hash comes first."""
    counts = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("size").alias("size"))
    counts = saved(counts, "html_votes")
    total = counts.groupBy(F.col("host").alias("of")).agg(F.sum("votes").alias("total"))
    won = counts.join(total, F.col("host") == F.col("of")).where(F.col("votes") >= F.col("total") * WIN)
    order = F.array_sort(F.collect_list(F.struct(-F.col("votes"), -F.col("size"), F.col("path"))))
    return won.groupBy("of").agg(F.transform(order, lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of each row of pages (page_id, url, html).

    The text is the article's blocks, one on a line: character references decoded, white space inside a block made one space.
    Null or empty html gives an empty text. Rows without url, or whose url has no host, are one host of their own kind. Repeated
    rows each give their row and their vote; other columns are left out. Memory follows a page's length, however deep it is.
    """
    small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    won = saved(winning_paths(rows.select("host", "html").mapInArrow(_votes, "host string, path long, size long")), "html_paths")
    return rows.join(won, F.col("host") == F.col("of"), "left").select("page_id", "url", "html", "paths").mapInArrow(_texts, "page_id long, url string, text string, n_chars long")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
