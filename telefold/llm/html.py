"""Main text of web pages by consensus of their hosts.

Each page's containers are scored by the text they hold outside links; the path of tags and classes, with numbers
generalised, of the outermost article container around the best one is the page's vote. Votes are counted per host in Spark. Every page is then extracted
again from the containers on its host's winning path, or on its own best path where that one holds no text.

A page is cut into blocks: text between block-level tags. Blocks in menus, footers, sidebars, forms and the like,
by tag or class, belong to no article. A class, id or role marks an element if the whole name is a mark, or marks
with words of place or form (``top-nav``, ``comment-list``), not if it says more (``has-sidebar``). Marks of adverts,
comments and consent count beside any word (``sponsored-content``) but those of a state or a subject
(``no-comments``, ``tag-sponsors``). A mark doesn't count around the only articles of a page, nor, on pages without, around most of its text unless it is of comments.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .columns import aside

#: a value in quotes may hold < and >; a quote that no space, slash or end of the tag follows wasn't closed and is a character
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?>=\s*(?:"[^"]*"|'[^']*')(?=[\s/>])|[^<>])*+)>""", re.S
)
CLASS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+))""", re.I)
NUMBER = re.compile(r"\d+")

RAW = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: never part of an article
OUTSIDE = frozenset("head nav footer aside form menu dialog button select svg math canvas audio video object".split())
CONTAINER = frozenset("html body main article section div td center details figure".split())
BLOCK = CONTAINER | OUTSIDE | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr th header blockquote pre figcaption address hr fieldset legend summary option".split()
)
#: elements that a tag of the same group closes
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: names in class, id or role that mark what isn't article
MARKS = frozenset(
    "ad ads advert advertisement advertising adverts banner sponsor sponsored promo promotion cookie cookies consent notice notices alert popup modal"
    " comment comments disqus reply replies respond responses gdpr nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside footer masthead"
    " share sharing social related recommended newsletter subscribe signup login search toolbar widget skip copyright complementary contentinfo".split()
)
#: words that make names with the marks
FORMS = frozenset(
    "top bottom left right main site page global primary secondary first second sub inner outer upper lower mobile desktop sticky fixed box bar list"
    " area block container wrapper wrap section region zone slot unit row item items link links button buttons btn icon icons form field input text"
    " title label header message overlay thread body post posts article articles story stories entry entries google div".split()
)
#: marks that count beside any word but these
ALWAYS = frozenset("comment comments disqus advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr".split())
SUBJECT = frozenset("no not non has have with without is are hide show open closed off on enabled disabled allow allowed status category cat tag topic type format js about recipe recipes".split())
#: names of adverts in one word, and of headers and footers of the whole site
ADVERT = re.compile(r"(?:google)?ads?(?:box|slot|unit|banner|zone|space|block|frame|container|wrapper|wrap|holder|label)s?")
SITE = frozenset("site global masthead".split())
#: marks of what can hold most of a page's text
SAID = frozenset("comment comments disqus reply replies respond responses".split())
DEPTH = 100  # deeper containers share a path


def marks(names: str) -> set[str]:
    """The marks that names of a class, id or role hold: names that are marks, or made of marks and FORMS, or hold
    one of ALWAYS and none of SUBJECT."""
    found: set[str] = set()
    for name in names.split():
        words = {"ad" if ADVERT.fullmatch(w) else w for w in re.split(r"[^a-z]+", name) if w}
        if words & MARKS and words <= MARKS | FORMS:
            found |= words & MARKS
        elif not words & SUBJECT:
            found |= words & ALWAYS
        if words & SITE and "header" in words and words <= MARKS | FORMS:
            found.add("masthead")
    return found


@dataclass
class Page:
    """Containers (parent, path, whether it is outside articles) and blocks (text, container, characters in links)."""

    paths: list[tuple[int, str]] = field(default_factory=lambda: [(-1, "")])
    containers: list[tuple[int, int, bool]] = field(default_factory=lambda: [(-1, 0, False)])
    blocks: list[tuple[str, int, int]] = field(default_factory=list)

    def path(self, i: int) -> str:
        parts = []
        while i > 0:
            i, label = self.paths[i][0], self.paths[i][1]
            parts.append(label)
        return "/".join(reversed(parts))


def parse(source: str) -> Page:
    """Reads a page in one pass; tags that don't fit are closed or passed over."""
    page, known = Page(), {}
    open_: list[tuple[str, int]] = []  # elements by tag, and the container each stands for
    now, text, linked, in_link = 0, [], 0, 0
    depth = [0]
    soft: dict[int, set[str]] = {}  # marked containers
    articles: list[int] = []

    def flush() -> None:
        nonlocal text, linked
        if text:
            words = " ".join(entities.unescape("".join(text)).split())
            if words:
                page.blocks.append((words, now, min(linked, len(words))))
            text, linked = [], 0

    def say(part: str) -> None:
        nonlocal linked
        text.append(part)
        if in_link:
            linked += len(part.strip())

    def close(k: int) -> None:
        nonlocal now
        del open_[k:], depth[k + 1:]
        now = open_[-1][1] if open_ else 0

    at, end = 0, len(source)
    while at < end:
        m = TAG.search(source, at)
        if m is None:
            say(source[at:])
            break
        if m.start() > at:
            say(source[at:m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag in BLOCK:
                flush()
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag:
                    flush()
                    close(k)
                    break
            continue
        if tag in RAW:
            found = RAW[tag].search(source, at)
            at = (source.find(">", found.start()) + 1 or end) if found else end
            continue
        if tag == "br" or tag == "hr":
            say(" ")
        if tag == "a":
            in_link += 1
        if tag in BLOCK:
            flush()
            in_link = in_link if tag == "a" else 0
            if open_ and open_[-1][0] == "p":
                close(len(open_) - 1)
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] in CLOSES.get(tag, ()):
                    close(k)
                    break
                if open_[k][0] in CONTAINER or open_[k][0] in ("ul", "ol", "dl", "table"):
                    break
        if tag in VOID or m[3].endswith("/"):
            continue
        names = [(a.lower(), (x or y or z).lower()) for a, x, y, z in CLASS.findall(m[3])] if m[3] else []
        mark = set().union(*(marks(value) for _, value in names)) if names and tag not in ("html", "body", "article", "main") else set()
        marked = bool(mark)
        if tag in BLOCK or marked:
            parent = page.containers[now]
            outside = tag in OUTSIDE or (tag == "header" and "article" not in (t for t, _ in open_))
            if outside or marked or tag in CONTAINER:
                label = ".".join([tag, *sorted({NUMBER.sub("#", c) for a, value in names if a == "class" for c in value.split()})])
                path = parent[1]
                if depth[-1] < DEPTH:
                    key = (parent[1], label)
                    if key not in known:
                        known[key] = len(page.paths)
                        page.paths.append(key)
                    path = known[key]
                flush()
                page.containers.append((now, path, outside))
                if marked and not outside:
                    soft[len(page.containers) - 1] = mark
                if tag in ("article", "main"):
                    articles.append(len(page.containers) - 1)
                open_.append((tag, len(page.containers) - 1))
                now = len(page.containers) - 1
            else:
                open_.append((tag, now))
            depth.append(depth[-1] + 1)
    flush()
    _settle(page, soft, articles)
    return page


def _settle(page: Page, soft: dict[int, set[str]], articles: list[int]) -> None:
    """Hands down what is outside, by tag or by marks that count."""
    tagged: list[bool] = []
    marked: list[bool] = []
    for i, (parent, _, outside) in enumerate(page.containers):
        tagged.append(outside or (parent >= 0 and tagged[parent]))
        marked.append(i in soft or (parent >= 0 and marked[parent]))
    if soft:
        text = [0] * len(page.containers)
        for words, where, linked in page.blocks:
            if not tagged[where]:
                text[where] += len(words) - linked
        for i in range(len(text) - 1, 0, -1):
            text[page.containers[i][0]] += text[i]
        told = [i for i in articles if text[i] and not tagged[i]]
        spared: set[int] = set()
        if told and all(marked[i] for i in told):
            at = max(told, key=text.__getitem__)
            while at > 0:
                spared.add(at)
                at = page.containers[at][0]
        elif not told:
            spared = {i for i, mark in soft.items() if 2 * text[i] > text[0] and not mark & SAID}
        soft = {i: mark for i, mark in soft.items() if i not in spared}
    settled: list[tuple[int, int, bool]] = []
    for i, (parent, path, outside) in enumerate(page.containers):
        settled.append((parent, path, outside or i in soft or (parent >= 0 and settled[parent][2])))
    page.containers = settled


def best_path(page: Page) -> tuple[str, float]:
    """The path of the article around the container with most article text outside links, counted fully where it
    stands, by half for the container around it and so on; and that container's score. Empty without such text."""
    scores = [0.0] * len(page.containers)
    direct: set[int] = set()  # paths of containers that hold text themselves
    for text, where, linked in page.blocks:
        value = len(text) - linked
        if value <= 0 or page.containers[where][2]:
            continue
        direct.add(page.containers[where][1])
        for _ in range(6):
            scores[where] += value
            where, value = page.containers[where][0], value / 2
            if where < 0:
                break
    total: dict[int, float] = {}
    for (_, path, _), score in zip(page.containers, scores):
        if score:
            total[path] = total.get(path, 0.0) + score
    best = max(total, key=total.__getitem__, default=None)
    return (page.path(around(page, best, direct, total)), total[best]) if best is not None else ("", 0.0)


def around(page: Page, path: int, direct: set[int], scored: Iterable[int]) -> int:
    """The path of the outermost article container around ``path``: an article, a main without articles on the way, or
    one with text of its own beside what it contains. The page's body is one only if nothing else with text
    stands beside them on the way."""
    top = at = path
    children = Counter(page.paths[p][0] for p in scored)
    alone = True
    semantic = page.paths[path][1].split(".")[0] in ("article", "main")
    while at > 0:
        at = page.paths[at][0]
        tag = page.paths[at][1].split(".")[0]
        if tag in ("", "html", "body"):
            return at if at in direct and alone and not semantic else top
        if at in direct or tag == "article" or (tag == "main" and not semantic):
            top, alone = at, True
        else:
            alone = alone and children[at] < 2
        semantic = semantic or tag in ("article", "main")
    return top


def text_on(page: Page, path: str) -> str:
    """Blocks inside containers on ``path``, joined by two line breaks."""
    inside: list[bool] = []
    matches = {i for i in range(len(page.paths)) if page.path(i) == path}
    for parent, p, _ in page.containers:
        inside.append(p in matches or (parent >= 0 and inside[parent]))
    return "\n\n".join(t for t, where, _ in page.blocks if inside[where] and not page.containers[where][2])


def extract(source: str | None, winner: str | None) -> str:
    if not source:
        return ""
    page = parse(source)
    found = text_on(page, winner) if winner is not None else ""
    return found or text_on(page, best_path(page)[0])


@aside
def main_text(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """Adds ``out string``: the main text, empty if there is none; null and empty pages have none.

    Pages without a host vote for themselves alone. Equal rows give equal texts. Of paths with as many votes that
    with the larger score wins. A column named like the output is replaced.
    """
    host = F.nullif(F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = [best_path(parse(t.as_py())) if t.is_valid else ("", 0.0) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({
                "host": batch.column(0), "path": pa.array([p for p, _ in votes], pa.string()), "score": pa.array([s for _, s in votes], pa.float64()),
            })

    votes = pages.select(host.alias("host"), F.col(f"`{html}`").alias("html")).filter("host IS NOT NULL").mapInArrow(vote, "host string, path string, score double")
    counted = votes.filter("score > 0").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
    winners = counted.groupBy("host").agg(F.max(F.struct("n", "score", "path"))["path"].alias("__path"))
    winners = written(winners.withColumnRenamed("host", "__host"), "hosts")  # its size is known, so a small one is broadcast

    @F.arrow_udf("string")
    def run(sources: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([extract(s.as_py(), p.as_py()) for s, p in zip(sources, paths)], pa.string())

    joined = pages.join(winners, host == F.col("__host"), "left")
    return joined.withColumn(out, run(F.col(f"`{html}`"), F.col("__path"))).drop("__host", "__path")
