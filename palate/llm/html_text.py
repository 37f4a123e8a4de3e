"""Main text of web pages: boosted trees over DOM nodes, and a decoding that keeps ancestors.

A page becomes a tree of block elements and text blocks. Every node gets features: tags and attribute
tokens of itself and its ancestors, depth, place among its siblings, and how dense its subtree is
in text, links and tags. Boosted trees, learned on a bounded sample of pages, score nodes as main
text or not. The decoding picks the best set of nodes in which every node's parent is picked too, so no
part of a dropped element comes back and no kept block lies in a dropped one.

Pages carry no labels. The sample is labelled by what they say themselves: landmark elements
and attribute tokens. Half of the training rows have these hidden, so that the trees also learn what
main text looks like where a page has neither.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palate.llm.common import batches, strings

#: At most about so many pages are learned from, picked by a hash of their id.
SAMPLE_PAGES = 400
TREES, DEPTH = 12, 4

#: The names of HTML elements.
BLOCKS = frozenset("html head body title article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside form fieldset legend table thead tbody tfoot tr td th caption blockquote pre figure figcaption details summary address dialog menu hgroup search center select option optgroup textarea button label hr noscript template iframe object canvas audio video svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title noscript template iframe object canvas audio video svg math select textarea button".split())
RAW = "script|style|xmp|noembed|noframes"
#: An element that starts ends an open one of these.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "body": {"head"}}
SCOPES = frozenset("html body article section div td th table ul ol dl blockquote main aside form nav header footer".split())
INLINE_IN_P = BLOCKS - frozenset("option optgroup label button select textarea noscript template iframe object canvas audio video svg math legend summary caption title head html body".split())

MAIN_TAGS = frozenset("article main".split())
SIDE_TAGS = frozenset("nav header footer aside form fieldset menu dialog search head title select textarea button label noscript template iframe object canvas audio video svg math".split())
TITLE_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_WORDS = frozenset("article articlebody main maincontent content contents body entry post story text page-content prose".split())
SIDE_WORDS = frozenset("ad ads adv advert adverts advertisement banner promo promotion promoted sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs toc header masthead footer foot bottom sidebar side aside rail widget widgets related recommended recommendations more popular trending share sharing social follow comment comments disqus reply replies respond discussion feedback cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login signin register form search pagination pager tags tag meta byline copyright legal disclaimer contentinfo complementary toolbar topbar skip".split())

TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|</?[a-zA-Z](?:[^'\">]|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z", re.S | re.I)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"\s(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
SPLIT = re.compile(r"[^a-z]+")

FEATURES = ["main_tag", "side_tag", "main_word", "side_word", "under_main", "under_side", "under_main_word", "under_side_word", "nearest_is_main", "is_text", "is_p", "is_title", "is_item", "is_cell", "is_box", "depth", "place", "siblings", "same_tag_share", "chars", "words", "link_share", "tags", "density", "text_children", "page_share", "starts_at", "ends_at", "stops", "commas", "digits", "mean_word", "beside_chars", "parent_density"]
#: What a page says itself; hidden in half of the training rows.
SAID = 9


@dataclass
class Page:
    """A page's nodes in page order, parents first; text nodes hold a block of text."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    words: list[frozenset[str]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    link_chars: list[int] = field(default_factory=list)
    tags: list[int] = field(default_factory=list)


def parse(source: str) -> Page:
    """The tree of block elements. Unclosed and misplaced tags are mended like browsers do roughly;
    comments, scripts and styles are skipped; an unfinished tag at the end is dropped."""
    page, open_, run, in_link, at = Page(), [], [], 0, 0
    places: dict[str, list[int]] = {}  # where in open_ the elements of a name are

    def put(tag: str, words: frozenset[str], text: str | None, links: int = 0) -> int:
        for column, value in zip((page.tag, page.parent, page.words, page.text, page.link_chars, page.tags), (tag, open_[-1] if open_ else -1, words, text, links, 0), strict=True):
            column.append(value)
        return len(page.tag) - 1

    def flush() -> None:
        if run:
            text = " ".join("".join(t for t, _ in run).split())
            if text:
                put("#text", frozenset(), text, sum(len(t) for t, link in run if link))
            run.clear()

    def end(tags: frozenset[str] | set[str], scope: frozenset[str]) -> None:
        """Close the innermost open element of tags and all in it, unless one of scope lies in between."""
        at = max((places[t][-1] for t in tags if places.get(t)), default=-1)
        if at < 0 or any(places[t][-1] > at for t in scope if places.get(t)):
            return
        flush()
        for node in open_[at:]:
            places[page.tag[node]].pop()
        del open_[at:]

    put("#page", frozenset(), None)
    open_.append(0)
    for found in TOKEN.finditer(source):
        if found.start() > at:
            run.append((html.unescape(source[at : found.start()]), in_link))
        at, mark = found.end(), found.group()
        named = None if found.group(1) else NAME.match(mark)
        if not named:
            continue
        tag = named.group(1).lower()
        if not mark.endswith(">"):
            continue
        page.tags[open_[-1]] += 1
        if tag == "a":
            in_link = 0 if mark[1] == "/" else 1
        elif tag == "br":
            run.append((" ", in_link))
        elif tag not in BLOCKS:
            continue
        elif mark[1] == "/":
            if tag == "p" or tag in TITLE_TAGS:
                end(TITLE_TAGS if tag in TITLE_TAGS else {"p"}, SCOPES)
            else:
                end({tag}, frozenset())
        else:
            if tag in INLINE_IN_P:
                end({"p"}, SCOPES)
            for _ in range(3 if tag in CLOSES else 0):
                end(CLOSES[tag], SCOPES - {"td", "th"} if tag in ("tr", "thead", "tbody", "tfoot") else SCOPES - CLOSES[tag])
            flush()
            words = frozenset(w for value in ATTRIBUTE.findall(mark) for w in SPLIT.split(value.lower()) if w) if " " in mark else frozenset()
            node = put(tag, words, None)
            if tag not in VOID and not mark.endswith("/>"):
                places.setdefault(tag, []).append(len(open_))
                open_.append(node)
    if at < len(source):
        run.append((html.unescape(source[at:]), in_link))
    flush()
    return page


def features(page: Page) -> np.ndarray:
    """One row of FEATURES per node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own = np.zeros((n, 4), bool)
    for i, (tag, words) in enumerate(zip(page.tag, page.words, strict=True)):
        own[i] = tag in MAIN_TAGS, tag in SIDE_TAGS, bool(words & MAIN_WORDS), bool(words & SIDE_WORDS)
    under, nearest, depth = np.zeros((n, 4), bool), np.zeros(n), np.zeros(n)
    chars = np.array([len(t) if t else 0 for t in page.text], float)
    sizes = chars.copy()
    links, tags, words = np.array(page.link_chars, float), np.array(page.tags, float), np.array([t.count(" ") + 1 if t else 0 for t in page.text], float)
    marks = np.array([[sum(map(t.count, ".!?")), t.count(","), sum(map(str.isdigit, t))] if t else [0, 0, 0] for t in page.text], float)
    texts, count, place = np.zeros(n), np.zeros(n), np.zeros(n)
    same: dict[tuple[int, str], int] = {}
    for i in range(n):
        up = parent[i]
        if up >= 0:
            under[i] = under[up] | own[up]
            depth[i] = depth[up] + 1
            place[i] = count[up]
            count[up] += 1
            texts[up] += page.tag[i] == "#text"
            same[up, page.tag[i]] = same.get((up, page.tag[i]), 0) + 1
            nearest[i] = nearest[up]
        if own[i, 1] or own[i, 3]:
            nearest[i] = -1
        elif own[i, 0] or own[i, 2]:
            nearest[i] = 1
    starts = np.concatenate([[0], np.cumsum(chars)[:-1]])
    for i in range(n - 1, 0, -1):
        up = parent[i]
        chars[up] += chars[i]
        links[up] += links[i]
        tags[up] += tags[i]
        words[up] += words[i]
        marks[up] += marks[i]
    total, up = max(chars[0], 1), np.maximum(parent, 0)
    density = chars / (tags + 1)
    beside = np.zeros(n)
    beside[1:] = np.maximum(sizes[:-1], np.append(sizes[2:], 0))
    tag_in = lambda *tags: np.array([t in tags for t in page.tag], float)
    safe = np.maximum(chars, 1)
    return np.column_stack([
        own, under, nearest, tag_in("#text"), tag_in("p"), tag_in(*TITLE_TAGS), tag_in("li", "dt", "dd", "option"), tag_in("td", "th", "tr", "table"), tag_in("div", "section"),
        depth, place, count[up], [same.get((p, t), 1) / max(count[p], 1) for p, t in zip(up.tolist(), page.tag, strict=True)],
        np.log1p(chars), np.log1p(words), links / safe, np.log1p(tags), np.log1p(density), texts, chars / total, starts / total, (starts + chars) / total,
        marks[:, 0] / np.maximum(words, 1), marks[:, 1] / np.maximum(words, 1), marks[:, 2] / safe, chars / np.maximum(words, 1), np.log1p(beside), np.log1p(density[up]),
    ])


def said(page: Page, x: np.ndarray) -> np.ndarray:
    """What the page says of its nodes: 1 main text, 0 not, -1 nothing. A node with a kept block is main."""
    label = np.where(x[:, 8] > 0, 1, np.where(x[:, 8] < 0, 0, -1)).astype(int)
    is_text = np.array([t is not None for t in page.text])
    label[~is_text & (label == 1)] = -1
    for i in range(len(label) - 1, 0, -1):
        if label[i] == 1:
            label[page.parent[i]] = 1
    return label


class Forest:
    """Boosted regression trees as arrays; score() is positive for main text."""

    def __init__(self, trees: list[tuple[float, list[tuple[int, float, int, int, float]]]]) -> None:
        self.trees = [(w, *(np.array(c) for c in zip(*nodes, strict=True))) for w, nodes in trees]

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for weight, feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), int)
            while (inner := left[at] >= 0).any():
                step = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
                at = np.where(inner, step, at)
            total += weight * value[at]
        return total


def _flatten(node, out: list) -> int:  # noqa: ANN001
    at = len(out)
    out.append(None)
    if node.subtreeDepth() == 0:
        out[at] = (0, 0.0, -1, -1, float(node.prediction()))
    else:
        split = node.split()
        left, right = _flatten(node.leftChild(), out), _flatten(node.rightChild(), out)
        out[at] = (int(split.featureIndex()), float(split.threshold()), left, right, 0.0)
    return at


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, id_col: str = "page_id", html_col: str = "html", seed: int = 7) -> Forest | None:
    """The forest learned from about sample_pages pages; None where they do not name both classes."""
    spark = pages.sparkSession
    n = pages.count()
    share = min(1.0, sample_pages / max(n, 1)) * 2.0**32
    picked = pages.filter(F.col(html_col).isNotNull() & (F.pmod(F.xxhash64(id_col, F.octet_length(html_col)), F.lit(1 << 32)) < F.lit(share))).select(F.col(html_col).alias("html"))

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 64):
            xs, ys = [], []
            for source in part.column(0).to_pylist():
                page = parse(source)
                x = features(page)
                y = said(page, x)
                x, y = x[y >= 0], y[y >= 0]
                hidden = x.copy()
                hidden[:, :SAID] = 0
                xs += [x, hidden]
                ys += [y, y]
            x = np.concatenate(xs)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ys).astype(float)), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["label", "x"])

    found = picked.mapInArrow(rows, "label double, x array<double>").toArrow().to_pandas()  # bounded by the sample
    if found["label"].nunique() < 2:
        return None
    found = found.sort_values(["label", "x"], key=lambda c: c if c.name == "label" else c.map(tuple))
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    table = spark.createDataFrame([(y, DenseVector(x)) for y, x in zip(found["label"], found["x"], strict=True)], schema).coalesce(1)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=seed, featureSubsetStrategy="onethird", maxMemoryInMB=64).fit(table)
    trees = []
    for weight, tree in zip(model.treeWeights, model.trees, strict=True):
        nodes: list = []
        _flatten(tree._java_obj.rootNode(), nodes)
        trees.append((float(weight), nodes))
    return Forest(trees)


def decode(page: Page, score: np.ndarray) -> np.ndarray:
    """The set of nodes with the greatest sum of scores (dropped ones count negative) in which
    every picked node's parent is picked; hidden elements never are."""
    n = len(score)
    score = np.where([t in HIDDEN for t in page.tag], -1e9, score)
    keep, drop = score.copy(), -score
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    picked = np.zeros(n, bool)
    for i in range(n):
        picked[i] = keep[i] > drop[i] and (i == 0 or picked[page.parent[i]])
    return picked


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """pages without their html, plus text and n_chars: the main text, one line per block.

    Null and empty pages, and pages without main text, give an empty text and 0. If the sample does not name
    both classes, what each page says of itself decides. Columns of pages named text or n_chars are
    replaced. Pages of any size are read whole; repeated rows give repeated results."""
    spark = pages.sparkSession
    model = spark.sparkContext.broadcast(train(pages, sample_pages, id_col, html_col))
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    schema = pages.select(*rest).schema.add("text", "string").add("n_chars", "long")

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = model.value
        for part in batches(parts, 256):
            tree = [parse(s) for s in strings(part.column(len(rest))).to_pylist()]
            xs = [features(p) for p in tree]
            ends = np.cumsum([len(x) for x in xs])
            if forest:
                scores = np.split(forest.score(np.concatenate(xs)), ends[:-1])
            else:
                scores = [np.where(said(p, x) == 1, 1.0, -0.01) for p, x in zip(tree, xs, strict=True)]
            texts = ["\n".join(t for t, kept in zip(p.text, decode(p, s), strict=True) if kept and t) for p, s in zip(tree, scores, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*rest, "text", "n_chars"])

    return pages.select(*rest, F.col(html_col).cast("string").alias("__html")).mapInArrow(read, schema)
