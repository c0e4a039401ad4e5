"""Main text of HTML pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi."""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fitledger.llm.labelled_pages import labelled_pages
from fitledger.llm.words import slices

TRAINING_PAGES = 500
# Fixed values of HTML: elements that begin and end blocks, that have no content, and that hold no readable text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style template noscript iframe svg object title select textarea button option".split())
RAW = frozenset("script style iframe noscript textarea title template".split())
# A new element of the left kind ends an open one of the right kinds.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table article section main body div td th li blockquote aside nav header footer form".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.DOTALL)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PARTS = re.compile(r"[a-z]+")
SENTENCE_END = re.compile(r"[.!?…]['\"»)\]]*$")


@dataclass
class Block:
    """A leaf block: its text, the nearest three of its ancestor blocks, and its linked characters.

    All its ancestors' keys are either at hand (``above``, when pages are learnt from) or already weighed
    (``weight``): a page of many open elements would hold their keys once for each block.
    """

    text: str
    near: tuple[str, ...]
    above: frozenset | None
    weight: int
    linked: int
    links: int


def _name_parts(attributes: str) -> list[str]:
    if "=" not in attributes:
        return []
    found = []
    for match in NAMED.finditer(attributes):
        value = match[1] or match[2] or match[3] or ""
        found += PARTS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())
    return found


class _Open:
    """An open element in the chain of open elements."""

    __slots__ = ("tag", "keys", "outer", "inner")

    def __init__(self, tag: str, keys: list[str], outer: _Open | None):
        self.tag, self.keys, self.outer, self.inner = tag, keys, outer, None


class _Reader:
    """Walks a page's markup once and gathers its leaf blocks.

    With ``weights`` the weights of all keys that are open, each counted once, are kept as a running sum of whole numbers.
    """

    def __init__(self, weights: dict[str, int] | None = None):
        self.blocks: list[Block] = []
        self.innermost: _Open | None = None
        self.open: dict[str, list[_Open]] = defaultdict(list)     # of each tag, outermost first
        self.keys: Counter = Counter()
        self.weights, self.weight = weights, 0
        self.pieces: list[str] = []
        self.linked = self.links = 0

    def text(self, raw: str) -> None:
        if any(self.open.get(t) for t in SILENT):
            return
        plain = html.unescape(raw) if "&" in raw else raw
        self.pieces.append(plain)
        if self.open.get("a"):
            self.linked += len(plain.strip())

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                near, element = [], self.innermost
                for _ in range(6):
                    if element is None:
                        break
                    if element.tag in BLOCKS:
                        near.append(element.tag)
                    element = element.outer
                above = frozenset(self.keys) if self.weights is None else None
                self.blocks.append(Block(text, tuple(near[:3]), above, self.weight, self.linked, self.links))
        self.pieces, self.linked, self.links = [], 0, 0

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.flush()
            if self.open.get("p"):
                self.end("p")
        for other in (o for o in ENDS.get(tag, ()) if self.open.get(o)):
            element = self.innermost
            while element is not None:
                if element.tag == other:
                    self.end(other)
                    break
                if element.tag in SCOPES and element.tag != tag:
                    break
                element = element.outer
        if tag == "br":
            self.pieces.append(" ")
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in SILENT:
            return
        element = _Open(tag, ["<" + tag, *_name_parts(attributes)], self.innermost)
        if self.innermost is not None:
            self.innermost.inner = element
        self.innermost = element
        self.open[tag].append(element)
        self.links += tag == "a"
        for key in element.keys:
            self.keys[key] += 1
            if self.weights and self.keys[key] == 1:
                self.weight += self.weights.get(key, 0)

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if not self.open.get(tag):
            return
        last = self.open[tag][-1]
        # The end of a block ends what is open inside; the end of anything else only itself.
        while tag in BLOCKS or tag in SILENT:
            element = self.innermost
            self._drop(element)
            if element is last:
                return
        self._drop(last)

    def _drop(self, element: _Open) -> None:
        """Take an element, the innermost of its tag, out of the chain."""
        if element.inner is None:
            self.innermost = element.outer
        else:
            element.inner.outer = element.outer
        if element.outer is not None:
            element.outer.inner = element.inner
        self.open[element.tag].pop()
        for key in element.keys:
            self.keys[key] -= 1
            if not self.keys[key]:
                del self.keys[key]
                if self.weights:
                    self.weight -= self.weights.get(key, 0)


def leaf_blocks(page: str, weights: dict[str, int] | None = None) -> list[Block]:
    """The texts between block boundaries in page order; white space is one space, references are decoded."""
    reader, at, size = _Reader(weights), 0, len(page)
    while at < size:
        match = MARKUP.search(page, at)
        if match is None:
            reader.text(page[at:])
            break
        if match.start() > at:
            reader.text(page[at:match.start()])
        at = match.end()
        name = match[2] or match[5]
        if not name:
            continue
        tag, closing = name.lower(), match[1] or match[4]
        if closing:
            reader.end(tag)
            continue
        reader.start(tag, (match[3] or match[6] or "").strip())
        if tag in RAW:
            close = re.compile(rf"</{tag}\b", re.IGNORECASE).search(page, at)
            at = close.start() if close else size
    reader.flush()
    return reader.blocks


ABOVE = "above:"
WHOLE = 1 << 40


def _bucket(n: float, *edges: float) -> int:
    return sum(n >= e for e in edges)


def features(blocks: list[Block]) -> Iterator[list[str]]:
    """Names of the features that each block has: of its ancestors, its text and its neighbours."""
    n = len(blocks)
    tags = [b.near[0] if b.near else "" for b in blocks]
    for i, block in enumerate(blocks):
        text = block.text
        size = len(text)
        ended = bool(SENTENCE_END.search(text))
        density = _bucket(block.linked / size, 0.01, 0.3, 0.7)
        length = _bucket(size, 10, 25, 60, 120, 300)
        row = ["bias", f"tag={tags[i]}", f"in={'/'.join(block.near[:2])}", f"length={length}", f"links={density}",
               f"ended={ended}", f"length={length},ended={ended}", f"length={length},tag={tags[i]}",
               f"many={_bucket(block.links, 1, 2, 5)}", f"place={_bucket(i, 1, 3)},{_bucket(n - i, 2, 4)}",
               f"before={tags[i - 1] if i else ''}", f"after={tags[i + 1] if i + 1 < n else ''}"]
        row += [ABOVE + key for key in block.above or ()]
        if size < 200:
            row += ["word:" + w for w in set(PARTS.findall(text.lower()))]
        if "©" in text:
            row.append("copyright")
        yield row


@dataclass
class Field:
    """Weights for the label main: of features, of the transitions between labels, and of both ends."""

    weights: dict[str, float] = field(default_factory=dict)
    moves: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])
    ends: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def scores(self, rows: Iterable[list[str]]) -> list[float]:
        known = self.weights.get
        return [sum(known(name, 0.0) for name in row) for row in rows]

    def ancestor_weights(self) -> dict[str, int]:
        """Weights of ancestors' keys in whole numbers, so that their running sum comes back exactly."""
        return {name[len(ABOVE):]: round(w * WHOLE) for name, w in self.weights.items() if name.startswith(ABOVE)}


def viterbi(model: Field, scores: list[float]) -> list[int]:
    """The likeliest labels (1: main) of a chain of blocks."""
    if not scores:
        return []
    (first0, first1), (last0, last1) = model.ends
    (stay0, rise), (fall, stay1) = model.moves
    a, b, back = first0, first1 + scores[0], []
    for s in scores[1:]:
        from0, from1 = a >= b + fall - stay0, a + rise > b + stay1
        back.append((0 if from0 else 1, 0 if from1 else 1))
        a, b = (a + stay0 if from0 else b + fall), (a + rise if from1 else b + stay1) + s
    label = int(b + last1 > a + last0)
    labels = [label]
    for step in reversed(back):
        label = step[label]
        labels.append(label)
    return labels[::-1]


def _log_add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def marginals(model: Field, scores: list[float]) -> tuple[list[float], list[list[float]]]:
    """Probability of main at each block and expected numbers of the transitions, by forward and backward sums."""
    n, moves = len(scores), model.moves
    ahead = [(model.ends[0][0], model.ends[0][1] + scores[0])]
    for s in scores[1:]:
        a, b = ahead[-1]
        ahead.append((_log_add(a + moves[0][0], b + moves[1][0]), _log_add(a + moves[0][1], b + moves[1][1]) + s))
    behind = [(model.ends[1][0], model.ends[1][1])]
    for s in reversed(scores[1:]):
        a, b = behind[-1]
        behind.append((_log_add(moves[0][0] + a, moves[0][1] + s + b), _log_add(moves[1][0] + a, moves[1][1] + s + b)))
    behind.reverse()
    total = _log_add(ahead[-1][0] + behind[-1][0], ahead[-1][1] + behind[-1][1])
    main = [math.exp(f[1] + g[1] - total) for f, g in zip(ahead, behind)]
    expected = [[0.0, 0.0], [0.0, 0.0]]
    for i in range(1, n):
        for x in (0, 1):
            for y in (0, 1):
                expected[x][y] += math.exp(
                    ahead[i - 1][x] + moves[x][y] + (scores[i] if y else 0.0) + behind[i][y] - total)
    return main, expected


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = 8, rate: float = 0.3, l2: float = 1e-4,
          min_count: int = 5, seed: int = 0) -> Field:
    """A field fitted to labelled chains by gradient steps with per-weight rates; rare features are left out."""
    seen = Counter(name for rows, _ in pages for row in rows for name in row)
    model = Field({name: 0.0 for name, n in seen.items() if n >= min_count})
    squares: dict = Counter()
    rng = np.random.default_rng(seed)

    def step(holder, key, slope):
        squares[id(holder), key] += slope * slope
        holder[key] += rate * (slope - l2 * holder[key]) / math.sqrt(1e-8 + squares[id(holder), key])

    for _ in range(epochs):
        for p in rng.permutation(len(pages)):
            rows, labels = pages[p]
            if not rows:
                continue
            main, expected = marginals(model, model.scores(rows))
            slopes: dict = Counter()
            for row, truth, chance in zip(rows, labels, main):
                for name in row:
                    if name in model.weights:
                        slopes[name] += truth - chance
            for name, slope in slopes.items():
                step(model.weights, name, slope)
            for x, y in zip(labels, labels[1:]):
                expected[x][y] -= 1
            for x in (0, 1):
                for y in (0, 1):
                    step(model.moves[x], y, -expected[x][y])
            for end, at in ((0, 0), (1, -1)):
                step(model.ends[end], 1, labels[at] - main[at])
    return model


def fit_extraction(pages: int = TRAINING_PAGES, seed: int = 0) -> Field:
    """A field trained on labelled pages: layouts of many kinds whose main blocks are known."""
    chains = []
    for page, main in labelled_pages(pages, seed):
        blocks = leaf_blocks(page)
        chains.append((list(features(blocks)), [int(b.text in main) for b in blocks]))
    return train(chains)


def main_text(model: Field, page: str | None, weights: dict[str, int]) -> str:
    """The blocks labelled main; ``weights`` are the model's :meth:`Field.ancestor_weights`. Time and memory grow with the page."""
    blocks = leaf_blocks(page, weights) if page else []
    scores = [s + b.weight / WHOLE for s, b in zip(model.scores(features(blocks)), blocks)]
    labels = viterbi(model, scores)
    return "\n\n".join(b.text for b, keep in zip(blocks, labels) if keep)


def extract_main_text(pages: DataFrame, model: Field, id_column: str = "page_id", url_column: str = "url",
                      html_column: str = "html") -> DataFrame:
    """One row (id, url, text, n_chars) for each page; the text's blocks are joined by an empty line.

    Null or empty pages, and pages without a main block, have an empty text. Broken markup is read as far as
    it goes: an open tag or comment runs to the end, unknown references stay as they are. Repeated rows stay
    repeated, an empty table gives no rows, other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)       # weights of the training pages' features

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights = model.ancestor_weights()
        for batch in batches:
            for part in slices(batch, "_html"):
                texts = [main_text(model, page, weights) for page in part.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["_row", "text", "n_chars"])

    rows = pages.select(F.struct(F.col(id_column), F.col(url_column)).alias("_row"), F.col(html_column).alias("_html"))
    kind = rows.schema["_row"].dataType.simpleString()
    return rows.mapInArrow(extract, f"_row {kind}, text string, n_chars long").select(
        F.col(f"_row.{id_column}").alias(id_column), F.col(f"_row.{url_column}").alias(url_column), "text", "n_chars")
