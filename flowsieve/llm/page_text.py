"""Main text of web pages by a recurrent block labeller.

A page is read as a sequence of leaf blocks: runs of text between block-level tags, each with the
path of elements it stands in. A bidirectional LSTM in numpy reads, per block, a vector of the
hashed tag path, a vector of the hashed words and a few plain features, and labels every block with
the whole page as context. It is trained on a bounded sample of pages whose blocks a few markup
rules label (regions that say what they are); the labels it gives join to the text.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_WIDTH = 64
WORD_WIDTH = 32
PLAIN = 6
WIDTH = PATH_WIDTH + WORD_WIDTH + PLAIN
HIDDEN = 20
TRAIN_PAGES = 400
TRAIN_BLOCKS = 400
# Elements nest no deeper; those inside the deepest are read as if they stood beside each other in it.
DEPTH = 128
EPOCHS = 12
BATCH = 32
SEED = 7

# Fixed: element names of the markup language.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = set("script style template".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
LISTS = set("ul ol dl table select".split())
# Fixed: names by which pages mark regions that are not the article.
ASIDE_TAGS = set(
    "nav footer aside form button select textarea dialog menu head title noscript iframe object svg".split()
)
ASIDE_NAMES = set(
    "ad ads advert adverts advertisement sponsor sponsored promo banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs header footer cookie cookies consent notice notices popup "
    "modal newsletter subscribe signup share social related comment comments reply replies "
    "disqus widget".split()
)
BODY_NAMES = set("article main content post entry story".split())

_TAG_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_TAG_STOP = re.compile(r"[>\"']")
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-zA-Z]+")


class _Tags:
    """The tags of a page from left to right, in time that grows with its length: whatever is looked
    for in vain is not looked for again."""

    def __init__(self, source: str):
        self.source = source
        self.last = {mark: source.rfind(mark) for mark in ("-->", ">", '"', "'")}
        self.unclosed: set[str] = set()

    def _find(self, mark: str, at: int) -> int:
        return self.source.find(mark, at) if at <= self.last[mark] else -1

    def next(self, position: int):
        """Start and end of the next tag, whether it is an end tag, its name (None for a comment or
        declaration) and its attributes; None at the end."""
        source, start = self.source, position
        while (start := source.find("<", start)) >= 0:
            if source.startswith(("<!", "<?"), start):
                mark = "-->" if source.startswith("<!--", start) else ">"
                end = self._find(mark, start + 2)
                return start, len(source) if end < 0 else end + len(mark), False, None, ""
            name = _TAG_NAME.match(source, start)
            if name:
                end = self._tag_end(name.end())
                if end < 0:  # cut off within a tag, which is then no text
                    return start, len(source), False, None, ""
                return start, end + 1, bool(name[1]), name[2].lower(), source[name.end() : end]
            start += 1
        return None

    def _tag_end(self, at: int) -> int:
        """Where a tag's > is. A quote opens a value only behind an equals sign; one that is never closed
        ends at the next >."""
        while stop := _TAG_STOP.search(self.source, at) if at <= self.last[">"] else None:
            if stop[0] == ">":
                return stop.start()
            at = stop.end()
            if self.source[max(0, at - 40) : at - 1].rstrip().endswith("="):
                closing = self._find(stop[0], at)
                if closing < 0:
                    return self._find(">", at)
                at = closing + 1
        return -1

    def after_element(self, tag: str, parent: str, position: int) -> int:
        """Behind the end tag of a raw element; of one that is never closed, where its parent ends."""
        for name, behind in ((tag, True), (parent, False)):
            if name and name not in self.unclosed:
                found = re.compile(rf"</{re.escape(name)}(?![a-zA-Z0-9:-])[^>]*>?", re.I).search(self.source, position)
                if found:
                    return found.end() if behind else found.start()
                self.unclosed.add(name)
        return len(self.source)


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


def page_blocks(source: str | None) -> list[Block]:
    """Leaf blocks of a page in order, with decoded text and single spaces; empty runs are none.

    Path items are a tag and its class, id and role words. A tag left open is closed where the
    markup rules imply it; a stray end tag is ignored. Scripts, styles and templates have no text; what
    a formula holds is part of the block around it."""
    source = source or ""
    stack: list[tuple[str, str]] = [("", "")]
    blocks: list[Block] = []
    parts: list[str] = []
    # The newest path, which neighbouring blocks share: its depth, its last element and itself.
    path: list = []
    linked, in_link, in_formula = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                if not path or path[0] != len(stack) or path[1] is not stack[-1]:
                    path[:] = len(stack), stack[-1], tuple(item for _, item in stack[1:])
                blocks.append(Block(path[2], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        del stack[depth:]

    position, size, tags = 0, len(source), _Tags(source)
    while position < size:
        found = tags.next(position)
        end = found[0] if found else size
        if end > position:
            parts.append(source[position:end])
            linked += (end - position) if in_link else 0
        if not found:
            break
        _, position, ends, tag, attributes = found
        if tag is None:
            continue
        if tag in RAW_TEXT:
            if not ends and not attributes.endswith("/"):
                position = tags.after_element(tag, stack[-1][0], position)
            continue
        if tag == "math":
            in_formula = 0 if ends else 1
        if in_formula or tag == "math":
            continue
        if tag == "a":
            in_link = 0 if ends else 1
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            continue
        flush()
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
            continue
        # A new block ends an open paragraph; items end their open siblings within their list.
        if stack[-1][0] == "p":
            pop_to(len(stack) - 1)
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in LISTS:
                break
            if stack[depth][0] in CLOSES.get(tag, ()):
                pop_to(depth)
                break
        if tag not in VOID and not attributes.endswith("/") and len(stack) <= DEPTH:
            names = [w.lower() for m in _NAMES.finditer(attributes) for w in _WORDS.findall(m[1] or m[2] or m[3] or "")]
            stack.append((tag, " ".join([tag, *names])))
    flush()
    return blocks


def rule_label(block: Block, has_body: bool) -> int:
    """1 if the markup says the block is of the article: inside a region named so (where the page has
    one) and inside none that is named otherwise."""
    inside = not has_body
    for item in block.path:
        tag, *names = item.split()
        if tag in BODY_NAMES or (tag in ("div", "section") and BODY_NAMES.intersection(names)):
            inside = True
        elif tag in ASIDE_TAGS or ASIDE_NAMES.intersection(names) or (tag == "header" and not inside):
            return 0
    return int(inside)


def rule_labels(blocks: list[Block]) -> list[int]:
    has_body = any(
        item.split()[0] in BODY_NAMES or BODY_NAMES.intersection(item.split()[1:])
        for b in blocks
        for item in b.path
    )
    return [rule_label(b, has_body) for b in blocks]


class _PathVectors:
    """Hashed vectors of tag paths: each item, and each word of it, adds a seeded sign pattern."""

    def __init__(self):
        self.known: dict[tuple, np.ndarray] = {}

    def of(self, path: tuple[str, ...]) -> np.ndarray:
        found = self.known.get(path)
        if found is None:
            found = np.zeros(PATH_WIDTH, np.float32)
            words = {w for item in path for w in [item, *item.split()]}
            for word in [*sorted(words), f"leaf {path[-1] if path else ''}"]:
                bits = np.frombuffer(zlib.crc32(word.encode()).to_bytes(4, "little") + zlib.crc32(b"+" + word.encode()).to_bytes(4, "little"), np.uint8)
                found += np.unpackbits(bits)[:PATH_WIDTH].astype(np.float32) * 2 - 1
            found /= math.sqrt(len(words) + 1)
            if len(self.known) < 20_000:
                self.known[path] = found
        return found


def page_vectors(blocks: list[Block], paths: _PathVectors) -> np.ndarray:
    """Input rows of a page: hashed path, hashed words, length, links, marks and place."""
    rows = np.zeros((len(blocks), WIDTH), np.float32)
    for i, block in enumerate(blocks):
        rows[i, :PATH_WIDTH] = paths.of(block.path)
        words = block.text.lower().split(" ")
        slots = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_WIDTH for w in words), np.int64, len(words))
        rows[i, PATH_WIDTH : PATH_WIDTH + WORD_WIDTH] = np.bincount(slots, minlength=WORD_WIDTH) / math.sqrt(len(words))
        rows[i, PATH_WIDTH + WORD_WIDTH :] = (
            math.log1p(len(block.text)) / 5,
            math.log1p(len(words)) / 3,
            block.linked / len(block.text),
            block.text[-1] in ".!?",
            i / len(blocks),
            1.0,
        )
    return rows


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        scale = 1 / math.sqrt(WIDTH + HIDDEN)
        self.weights = {}
        for side in ("ahead", "back"):
            w = rng.normal(0, scale, (WIDTH + HIDDEN, 4 * HIDDEN)).astype(np.float32)
            b = np.zeros(4 * HIDDEN, np.float32)
            b[HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
            self.weights |= {f"{side} w": w, f"{side} b": b}
        self.weights["out w"] = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
        self.weights["out b"] = np.zeros(1, np.float32)

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states of one direction over (time, batch, width); masked steps keep the state."""
        w, b = self.weights[f"{side} w"], self.weights[f"{side} b"]
        steps, n, _ = x.shape
        inputs = (x.reshape(-1, WIDTH) @ w[:WIDTH] + b).reshape(steps, n, -1)
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        states = np.zeros((steps, n, HIDDEN), np.float32)
        trace = []
        for t in range(steps) if side == "ahead" else range(steps - 1, -1, -1):
            gates = inputs[t] + h @ w[WIDTH:]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = m * (f * c + i * g) + (1 - m) * c
            tanh_c = np.tanh(new_c)
            new_h = m * o * tanh_c + (1 - m) * h
            if keep:
                trace.append((t, i, f, o, g, m, h, c, tanh_c))
            h, c = new_h, new_c
            states[t] = h
        return states, trace

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of each block of each page; pages of like length are run together."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            most = len(pages[order[min(at + 127, len(order) - 1)]])
            # Few pages at a time where they are long, so that the padded batch stays small.
            size = 128 if most <= 512 else max(1, min(128, 65_536 // most))
            group = order[at : at + size]
            at += size
            x, mask = padded([pages[i] for i in group])
            ahead, _ = self._run("ahead", x, mask, False)
            back, _ = self._run("back", x, mask, False)
            score = np.concatenate((ahead, back), axis=2) @ self.weights["out w"] + self.weights["out b"]
            for column, i in enumerate(group):
                out[i] = _sigmoid(score[: len(pages[i]), column])
        return out

    def gradients(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradient of the mean logistic loss per block, through time in both directions."""
        x, mask = padded(pages)
        y = np.zeros(mask.shape, np.float32)
        for column, label in enumerate(labels):
            y[: len(label), column] = label
        runs = {side: self._run(side, x, mask, True) for side in ("ahead", "back")}
        both = np.concatenate((runs["ahead"][0], runs["back"][0]), axis=2)
        p = _sigmoid(both @ self.weights["out w"] + self.weights["out b"])
        error = (p - y) * mask / mask.sum()
        found = {
            "out w": np.tensordot(error, both, axes=((0, 1), (0, 1))),
            "out b": np.array([error.sum()], np.float32),
        }
        for k, side in enumerate(("ahead", "back")):
            w = self.weights[f"{side} w"]
            into = error[:, :, None] * self.weights["out w"][k * HIDDEN : (k + 1) * HIDDEN]
            dw, db = np.zeros_like(w), np.zeros_like(self.weights[f"{side} b"])
            dh = np.zeros(into.shape[1:], np.float32)
            dc = np.zeros_like(dh)
            for t, i, f, o, g, m, h, c, tanh_c in reversed(runs[side][1]):
                dh = dh + into[t]
                do = dh * tanh_c * m
                dc_new = dc + dh * o * m * (1 - tanh_c**2)
                inner = m * dc_new
                gates = np.concatenate(
                    (inner * g * i * (1 - i), inner * c * f * (1 - f), do * o * (1 - o), inner * i * (1 - g**2)), axis=1
                )
                dw[:WIDTH] += x[t].T @ gates
                dw[WIDTH:] += h.T @ gates
                db += gates.sum(axis=0)
                dh = gates @ w[WIDTH:].T + (1 - m) * dh
                dc = inner * f + (1 - m) * dc_new
            found |= {f"{side} w": dw, f"{side} b": db}
        return found

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam over seeded batches of pages."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            rate = 0.01 * (1 - epoch / epochs) + 0.001
            order = rng.permutation(len(pages))
            for at in range(0, len(order), BATCH):
                group = order[at : at + BATCH]
                step += 1
                for k, g in self.gradients([pages[i] for i in group], [labels[i] for i in group]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - rate * change).astype(np.float32)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), WIDTH), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for column, page in enumerate(pages):
        x[: len(page), column] = page
        mask[: len(page), column] = 1
    return x, mask


def fit(
    pages: DataFrame, source: str = "html", sample: int = TRAIN_PAGES, blocks: int = TRAIN_BLOCKS
) -> Labeller:
    """A labeller trained on at most ``sample`` pages, those first by a digest of their markup, and
    at most ``blocks`` blocks of each, in runs from its beginning to its end (``spread``); an untrained
    one if no page has a block."""
    body = F.col(f"`{source}`")
    chosen = pages.filter(body.isNotNull()).select(F.md5(body).alias("_order")).distinct()
    chosen = chosen.orderBy("_order").limit(sample)
    rows = pages.select(body.alias("_body")).join(
        F.broadcast(chosen), F.md5("_body") == F.col("_order"), "left_semi"
    )
    found = rows.select("_body").dropDuplicates().mapInArrow(_training_blocks(blocks), "x binary, y binary").toPandas()
    labeller = Labeller()
    pairs = sorted(zip(found.x.map(bytes), found.y.map(bytes)), key=lambda p: zlib.crc32(p[0]))
    if pairs:
        labeller.train(
            [np.frombuffer(x, np.float32).reshape(-1, WIDTH) for x, _ in pairs],
            [np.frombuffer(y, np.float32) for _, y in pairs],
        )
    return labeller


def spread(n: int, most: int, runs: int = 4) -> np.ndarray:
    """Places of at most ``most`` of ``n`` blocks: all, or ``runs`` runs of neighbours, the first at the
    beginning, the last at the end, the others evenly between."""
    if n <= most:
        return np.arange(n)
    length = most // runs
    starts = np.linspace(0, n - length, runs).astype(np.int64)
    return np.unique((starts[:, None] + np.arange(length)[None, :]).ravel())


def _training_blocks(most: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = _PathVectors()
        for batch in batches:
            xs, ys = [], []
            for body in batch.column(0).to_pylist():
                blocks = page_blocks(body)
                if blocks:
                    chosen = spread(len(blocks), most)
                    xs.append(page_vectors(blocks, paths)[chosen].tobytes())
                    ys.append(np.array(rule_labels(blocks), np.float32)[chosen].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], ["x", "y"])

    return read


def _extractor(shared):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller, paths = shared.value, _PathVectors()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pages = [page_blocks(body.as_py()) for body in part.column(0)]
                chances = labeller.probabilities([page_vectors(p, paths) for p in pages])
                texts = [
                    "\n".join(b.text for b, chance in zip(page, found) if chance >= 0.5)
                    for page, found in zip(pages, chances)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[1:], pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in pages], pa.int64()),
                    ],
                    [*part.schema.names[1:], "text", "n_chars", "n_blocks"],
                )

    return read


def extract(pages: DataFrame, labeller: Labeller, source: str = "html") -> DataFrame:
    """All columns of ``pages`` but the markup, with text, n_chars (code points) and n_blocks.

    Every block of every page is labelled from the whole page; those of the article are joined in
    page order by a line feed. Null and empty pages give the empty text. Input columns with an
    output's name are replaced.
    """
    outputs = ["text", "n_chars", "n_blocks", source.lower()]
    kept = [c for c in pages.columns if c.lower() not in outputs]
    kinds = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in kept)
    shared = pages.sparkSession.sparkContext.broadcast(labeller)
    rows = pages.select(F.col(f"`{source}`").alias("_body"), *[F.col(f"`{c}`") for c in kept])
    return rows.mapInArrow(_extractor(shared), f"{kinds}text string, n_chars bigint, n_blocks bigint")
