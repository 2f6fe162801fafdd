"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. A logistic classifier of the block's text, trained here, and the evidence of the
elements around it add up to the block's cost: above zero it is the capacity of the block's edge from the content
terminal, below zero that of its edge to the boilerplate terminal. Neighbours in page order and blocks that stand near
each other in the element tree are joined by smoothness edges, the stronger the nearer. The minimum cut labels the
blocks, so a short paragraph follows the article it stands in, and a stray sentence the menu around it.

No evidence outweighs all others but hidden elements: the text can speak against an element's name, and an element
that wraps the page's heading and most of its words says nothing against them, whatever it is called. What stands in
an article is held by it, however short or often repeated: there the text's statistics alone cannot turn a block, only
its links, or elements inside the article that speak against it.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pages that the classifier is fitted on, at most, and blocks of each (those of the least hash).
FIT_PAGES, FIT_BLOCKS = 2000, 200
SEED = 6
#: Evidence of elements that hold content, boilerplate or nothing to be seen; bound of the classifier's part.
CONTENT, BOILERPLATE, HIDDEN, CLASSIFIER = 2.0, -6.0, -12.0, 3.5
#: The classifier's part against a block that an article holds, and the share of links from which it holds no more.
AGAINST_HELD, LINKS = 1.25, 0.5
#: Capacities between neighbours in page order and, falling with the distance, between blocks near in the tree.
ADJACENT, NEAR = 0.6, 0.9
#: Share of a capacity that is left between blocks whose elements say opposite things.
OPPOSITE = 0.25
#: An element with the heading and this share of the page's words is a wrapper.
WRAPPER = 0.5

# fixed values: element names and words of class, id and role
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template svg iframe object textarea title head math canvas video audio select option datalist".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split(),
)
BAD_TAGS = set("nav footer aside form button fieldset label dialog menu".split())
HEADINGS = {"h1", "main", "article"}
GOOD_TAGS = {"article", "main"}
BAD_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner menu nav navbar navigation navi sidebar sidebars side rail aside footer foot bottom "
    "header masthead topbar toolbar cookie cookies consent gdpr notice notices alert alerts newsletter subscribe subscription signup signin login register share sharing social related recommended recommendations "
    "comment comments commentlist reply replies respond discussion disqus breadcrumb breadcrumbs popup modal overlay paywall pagination pager widget widgets tags taglist search form copyright legal skip disclaimer".split()
)
GOOD_WORDS = set("article articlebody content entry main post story text body".split())
BAD_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = re.compile(r"[.!?。！？…]")


@dataclass(slots=True)
class Element:
    tag: str
    names: str
    parent: int
    evidence: float
    words: int = 0
    headed: bool = False


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    path: tuple[int, ...]
    kind: tuple[str, str]
    evidence: float = 0.0
    held: bool = False


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw.strip() else {}


def _evidence(tag: str, found: dict[str, str], in_article: bool) -> float:
    """What an element says by itself of the text in it."""
    role = found.get("role", "").lower()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return HIDDEN
    words = {w.lower() for w in _WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}")} if tag not in ("html", "body") else set()
    own = in_article or tag in GOOD_TAGS or bool(words & {"article", "entry", "post"})
    bad = words & BAD_WORDS - ({"header"} if own else set())
    if tag in GOOD_TAGS or role in ("main", "article"):
        return BOILERPLATE if bad & {"comment", "comments", "ad", "ads"} else CONTENT
    if tag in BAD_TAGS or role in BAD_ROLES or bad or tag == "header" and not own:
        return BOILERPLATE
    return CONTENT if words & GOOD_WORDS else 0.0


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order: white space folded, references decoded, empty ones left out."""
    out: list[Block] = []
    elements: list[Element] = []
    stack: list[int] = []
    pieces: list[str] = []
    linked = at = 0
    skip = ""
    open_ended: set[str] = set()
    in_link = 0

    def close() -> None:
        nonlocal linked
        if pieces:
            if text := " ".join(entities.unescape("".join(pieces)).split()):
                path = tuple(k for k in stack if elements[k].tag not in INLINE)
                holder = elements[path[-1]] if path else None
                out.append(Block(text, min(linked, len(text)), path, (holder.tag, holder.names) if holder else ("", "")))
                if path != tuple(stack):
                    out[-1].evidence = min(elements[k].evidence for k in stack if elements[k].tag in INLINE)
            pieces.clear()
        linked = 0

    def closes(name: str) -> bool:
        """Whether the page still closes ``name``; each name is looked for in vain once."""
        if name not in open_ended and not re.compile(rf"</{re.escape(name)}[\s>]", re.IGNORECASE).search(page, at):
            open_ended.add(name)
        return name not in open_ended

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        if not skip and m.start() > at:
            pieces.append(page[at : m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if skip:
            if m[1] and name == skip:
                skip = ""
            continue
        if not m[1]:
            if name in ("script", "style"):
                end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
                continue
            if name in RAW and not m[3].endswith("/"):
                if name not in INLINE:
                    close()
                if closes(name):
                    skip = name
                continue
            if name == "br":
                pieces.append(" ")
            if name not in INLINE:
                close()
                if name in ("p", "li", "dd", "dt", "tr", "td", "th") or name[0] == "h" and name[1:].isdigit():
                    while stack and (elements[stack[-1]].tag in INLINE or elements[stack[-1]].tag == "p"):
                        in_link -= elements[stack.pop()].tag == "a"
                    if stack and elements[stack[-1]].tag == name:
                        stack.pop()
            if name in VOID or m[3].endswith("/") and name not in ("p", "div", "a", "span"):
                continue
            found = _attributes(m[3])
            in_article = any(elements[k].evidence > 0 for k in stack)
            elements.append(
                Element(name, f"{found.get('class', '')} {found.get('id', '')}", stack[-1] if stack else -1, _evidence(name, found, in_article)),
            )
            stack.append(len(elements) - 1)
            in_link += name == "a"
        else:
            if name not in INLINE:
                close()
            if any(elements[k].tag == name for k in stack):
                while True:
                    gone = elements[stack.pop()].tag
                    in_link -= gone == "a"
                    if gone == name:
                        break
    if not skip and at < len(page):
        pieces.append(page[at:])
    close()
    _weigh(out, elements)
    return out


def _weigh(found: list[Block], elements: list[Element]) -> None:
    """Gives each block the evidence of the elements around it: what speaks against it first, then what speaks for it.

    The page's articles hold their blocks; where there is none, its main elements do.
    """
    total = 0
    for b in found:
        words = b.text.count(" ") + 1
        total += words
        for k in b.path:
            elements[k].words += words
    for e in reversed(elements):  # parents stand before their children
        if e.parent >= 0 and (e.headed or e.tag in HEADINGS and e.evidence >= 0):
            elements[e.parent].headed = True
    good = {t: {k for k, e in enumerate(elements) if e.tag == t and e.evidence > 0} for t in GOOD_TAGS}
    holders = good["article"] or good["main"]
    for b in found:
        said = [b.evidence]
        for k in b.path:
            e = elements[k]
            if e.evidence != BOILERPLATE or not (e.headed and e.words >= WRAPPER * total):
                said.append(e.evidence)
        b.evidence = low if (low := min(said)) < 0 else max(said)
        b.held = b.evidence > 0 and b.linked < LINKS * len(b.text) and any(k in holders for k in b.path)


FEATURES = 8
#: PLAIN counts as much as about so many marked blocks, so that a few pages of one kind do not settle all others.
PRIOR_BLOCKS = 100


#: The classifier where no page says which of its blocks are which; one weight for each feature, the bias last.
PLAIN = np.array([1.0, -5.0, 2.0, 1.0, 2.0, -5.0, -2.0, 0.05, -2.6])


def features(found: list[Block]) -> np.ndarray:
    """A row of numbers for each block, of its text alone: nothing that its markup's names say."""
    x = np.zeros((len(found), FEATURES))
    for i, b in enumerate(found):
        n = len(b.text)
        words = b.text.count(" ") + 1
        x[i] = (
            np.log1p(words),
            b.linked / n,
            min(len(_SENTENCE.findall(b.text)) / words, 1),
            b.text[-1] in ".!?。！？…:\"”",
            b.text.count(",") / words,
            b.text.count("©") > 0,
            sum(map(b.text.count, "0123456789")) / n,
            (np.log1p(len(found[i - 1].text)) if i else 0) + (np.log1p(len(found[i + 1].text)) if i + 1 < len(found) else 0),
        )
    return x


def fit_classifier(x: np.ndarray, content: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights (the bias last) of a logistic regression with balanced classes, drawn towards PLAIN; PLAIN without both."""
    if not content.any() or content.all():
        return PLAIN
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    weight = np.where(content, 0.5 / content.sum(), 0.5 / (~content).sum())
    prior = np.append(PLAIN[:-1] * scale, PLAIN[-1] + (PLAIN[:-1] * mean).sum())
    w, pull = prior.copy(), PRIOR_BLOCKS / len(x)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += 2.0 / (1 + 2 * pull) * (z.T @ (weight * (content - p)) - pull * (w - prior))
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def minimum_cut(score: np.ndarray, edges: dict[tuple[int, int], float]) -> np.ndarray:
    """True for the blocks on the content side of the minimum cut.

    A block whose score outweighs all its edges is settled beforehand and its edges are added to its neighbours'
    scores; what is left goes through augmenting paths along breadth-first levels.
    """
    n = len(score)
    score = score.astype(float).copy()
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), c in edges.items():
        near[i][j] = near[i].get(j, 0) + c
        near[j][i] = near[j].get(i, 0) + c
    label = np.zeros(n, bool)
    settled = np.zeros(n, bool)
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if not settled[i] and abs(score[i]) >= sum(near[i].values()):
            settled[i], label[i] = True, score[i] > 0
            for j, c in near[i].items():
                score[j] += c if label[i] else -c
                del near[j][i]
                queue.append(j)
            near[i] = {}
    left = np.flatnonzero(~settled)
    if not len(left):
        return label
    source, sink = n, n + 1
    cap: dict[int, dict[int, float]] = {int(i): dict(near[i]) for i in left} | {source: {}, sink: {}}
    for i in map(int, left):
        a, b = (source, i) if score[i] > 0 else (i, sink)
        cap[a][b] = abs(score[i])
        cap[b].setdefault(a, 0.0)
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for b, c in cap[a].items():
                if c > 1e-12 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            break
        todo = {a: iter(list(cap[a])) for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                push = min(cap[x][y] for x, y in zip(path, path[1:]))
                for x, y in zip(path, path[1:]):
                    cap[x][y] -= push
                    cap[y][x] = cap[y].get(x, 0.0) + push
                path = [source]
                todo = {a: iter(list(cap[a])) for a in level} if len(level) < 64 else todo | {source: iter(list(cap[source]))}
                continue
            for b in todo[a]:
                if cap[a].get(b, 0) > 1e-12 and level.get(b) == level[a] + 1:
                    path.append(b)
                    break
            else:
                level[a] = -1
                path.pop()
    reached, queue = {source}, deque([source])
    while queue:
        a = queue.popleft()
        for b, c in cap[a].items():
            if c > 1e-12 and b not in reached:
                reached.add(b)
                queue.append(b)
    for i in map(int, left):
        label[i] = i in reached
    return label


def _distance(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    """Steps in the element tree between the parents of two blocks' elements."""
    a, b = a[:-1], b[:-1]
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return len(a) + len(b) - 2 * same


def costs(found: list[Block], weights: np.ndarray) -> np.ndarray:
    low = np.array([-AGAINST_HELD if b.held else -CLASSIFIER for b in found])
    return np.array([b.evidence for b in found]) + np.clip(features(found) @ weights[:-1] + weights[-1], low, CLASSIFIER)


def smoothness(found: list[Block]) -> dict[tuple[int, int], float]:
    """Edges between neighbours, and to the last block before of the same parent or grandparent and like evidence."""

    def weigh(i: int, j: int, base: float) -> float:
        a, b = found[i], found[j]
        near = base + NEAR / (1 + _distance(a.path, b.path)) * (1 if a.kind == b.kind else 0.5)
        return near * (OPPOSITE if a.evidence * b.evidence < 0 else 1)

    edges: dict[tuple[int, int], float] = {}
    last: dict[tuple[int, float], int] = {}
    for j, b in enumerate(found):
        if j:
            edges[j - 1, j] = weigh(j - 1, j, ADJACENT)
        for k in b.path[-3:-1]:
            if (i := last.get((k, b.evidence), j)) < j - 1:
                edges[i, j] = weigh(i, j, 0.0)
            last[k, b.evidence] = j
    return edges


def label_blocks(found: list[Block], weights: np.ndarray) -> tuple[np.ndarray, int]:
    """Whether each block is content, and how many blocks the cut gave another label than their own cost would."""
    cost = costs(found, weights)
    label = minimum_cut(cost, smoothness(found))
    return label, int((label != (cost > 0)).sum())


def main_text(page: str | None, weights: np.ndarray) -> tuple[str, int, int]:
    """(main text, number of blocks, number of them that the cut turned)."""
    found = blocks(page or "")
    if not found:
        return "", 0, 0
    keep, turned = label_blocks(found, weights)
    return "\n".join(b.text for b, k in zip(found, keep) if k), len(found), turned


def fit(df: DataFrame, html: str = "html", pages: int = FIT_PAGES) -> np.ndarray:
    """The classifier from the pages of the lowest seeded hashes that say which of their blocks are which.

    Its labels are the elements around a block, its features the block's text alone, so it carries what marked pages
    show over to those that say nothing. About ``pages`` pages at most, with FIT_BLOCKS blocks each: the only thing
    that comes to the driver. A page counts once, however many copies it has, and so does a text on it.
    """
    n = df.count()
    h = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(html)), 11)
    some = df.select(F.col(html).alias("html"), h.alias("h"))
    if n > pages:
        some = some.where(F.col("h") <= int(pages / n * (1 << 53)))
    some = some.dropDuplicates(["html"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column(0):
                found = blocks(page.as_py() or "")
                x = features(found)
                once = {b.text: i for i, b in enumerate(found) if HIDDEN < b.evidence != 0}
                plain = sorted(sorted(once.values(), key=lambda i: (zlib.crc32(found[i].text.encode()), i))[:FIT_BLOCKS])
                if plain:
                    columns = [pa.array(np.ascontiguousarray(x[plain, k])) for k in range(FEATURES)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([found[i].evidence > 0 for i in plain])], names=[*(f"x{k}" for k in range(FEATURES)), "content"])

    names = [f"x{k}" for k in range(FEATURES)]
    table = some.select("html").mapInArrow(run, ", ".join([f"{c} double" for c in names] + ["content boolean"])).toPandas().sort_values(
        [*names, "content"],
        ignore_index=True,
    )
    return fit_classifier(table[names].to_numpy(float), table["content"].to_numpy(bool)) if len(table) else PLAIN


def extract(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` with ``out``, the main text, in place of ``html``, and with n_blocks and n_turned.

    n_turned counts the blocks that the cut gave another label than their own cost would. Null and empty pages give
    an empty text; repeated rows the same text; an empty table an empty result. Columns of those names are replaced.
    """
    weights = fit(df, html)
    keep = [c for c in df.columns if c not in (html, out, "n_blocks", "n_turned")]
    counts = [T.StructField(c, T.LongType(), False) for c in ("n_blocks", "n_turned")]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.StringType(), False), *counts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n, turned = zip(*(main_text(t.as_py(), weights) for t in batch.column("__html"))) if batch.num_rows else ((), (), ())
            made = [pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(turned, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], names=[*keep, out, "n_blocks", "n_turned"])

    return df.select(*keep, F.col(html).alias("__html")).mapInArrow(run, schema)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, its length in code points, its blocks and how many of them the cut turned."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_blocks", "n_turned")
