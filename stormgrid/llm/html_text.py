"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks, each with the path of tags above it and its words.
Both are hashed to vectors; a bidirectional LSTM in numpy reads the sequence, so every block is
classified with the whole page in view.  The labels to learn from are silver ones: names of tags
and classes that say what a container holds.  Names are left out at random while learning, and
containers are renamed, so that the labeller also goes by words, place and neighbours.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid.llm.texts import hashed_sample, slices, strings

# Elements by their role in a page.
INLINE = set("a abbr acronym annotation annotation-xml b bdi bdo big br canvas cite code data del dfn em font i img ins "
             "kbd label map mark math merror mfrac mi mn mo mover mpadded mphantom mroot mrow ms msqrt mstyle msub msubsup msup mtable "
             "mtd mtext mtr munder munderover object q rp rt ruby s samp semantics small span strike strong sub sup "
             "time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template head title svg iframe select option textarea button annotation "
             "annotation-xml".split())
#: What a head may hold; anything else ends one whose end tag is left out.
IN_HEAD = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
CLOSES_PARAGRAPH = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
                       "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
# Names of containers that hold the article, and of those that don't.
BODY_NAMES = set("article main content post entry story body text".split())
OTHER_NAMES = set("nav navbar navigation menu header footer aside sidebar form ad ads advert adverts advertisement "
                  "sponsor sponsored promo banner cookie cookies notice notices consent popup modal newsletter "
                  "subscribe social share sharing related recommended comment comments reply replies respond "
                  "discussion breadcrumb breadcrumbs pagination pager search login signup widget toolbar legal "
                  "copyright masthead disclaimer alert".split())

PATH_SLOTS = 512
WORD_SLOTS = 512
WIDTH = 16
HIDDEN = 16
NUMBERS = 6
FIT_PAGES = 240
FIT_CHARS = 100_000
STEPS = 240
PAGES_A_STEP = 16
#: Blocks times pages scored at a time.
PADDED = 1 << 15
_TAG_BEGINS = re.compile(r"</?[A-Za-z]")
_NAME = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    text: str
    path: list[str]  # outermost first: a tag and its class and id words
    linked: int  # characters inside links


class _Leaves(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, str]] = []
        self.words: list[str] = []
        self.linked = self.links = self.silent = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            self.blocks.append(Block(text, [p for t, p in self.open if t not in INLINE], self.linked))
        self.words, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in INLINE:
            self._flush()
        if tag not in IN_HEAD:
            self._end_head(tag == "body")
        if tag not in INLINE:
            if tag in CLOSES_PARAGRAPH and any(t == "p" for t, _ in self.open):
                self._close("p")
            elif tag in ("li", "dt", "dd", "tr", "td", "th", "option") and self.open and self.open[-1][0] == tag:
                self._close(tag)
        elif tag == "br":
            self.words.append(" ")
        if tag in VOID:
            return
        names = [n for k, v in attrs if k in ("class", "id", "role") and v for n in _NAME.findall(v.lower())]
        self.open.append((tag, " ".join([tag, *names])))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, tag: str) -> None:
        while self.open:
            last, _ = self.open.pop()
            self.silent -= last in SILENT
            self.links -= last == "a"
            if last == tag:
                break

    def _end_head(self, body: bool) -> None:
        """Close an open head; only a body does so from inside an element of the head, but for templates."""
        if self.open and (self.open[-1][0] == "head" or body and any(t == "head" for t, _ in self.open)
                          and not any(t == "template" for t, _ in self.open)):
            self._close("head")

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        if any(t == tag for t, _ in self.open):
            if tag in INLINE:  # an inline end does not reach over a block
                for i in range(len(self.open) - 1, -1, -1):
                    if self.open[i][0] == tag:
                        self.links -= tag == "a"
                        self.silent -= tag in SILENT
                        del self.open[i]
                        break
                    if self.open[i][0] not in INLINE:
                        break
            else:
                self._close(tag)

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self._end_head(False)
        if not self.silent:
            self.words.append(data)
            self.linked += len(data) if self.links else 0


def blocks(html: str) -> list[Block]:
    """Leaf blocks in page order; scripts, styles, form controls and markup give none."""
    parser = _Leaves()
    last = html.rfind("<")
    if last > html.rfind(">") and _TAG_BEGINS.match(html, last):  # a tag that never ends is no text
        html = html[:last]
    parser.feed(html)
    parser.close()
    parser._flush()
    return parser.blocks


def silver(block: Block) -> bool | None:
    """What the names above a block say: article text, something else, or nothing."""
    names = [set(p.split()) for p in block.path]
    if any(n & OTHER_NAMES for n in names):
        return False
    if any(n & BODY_NAMES for n in names if not n & {"html", "body"}) or any(
            n & (BODY_NAMES - {"body"}) for n in names):
        return True
    return None


def silver_labels(page: list[Block]) -> list[bool]:
    """Labels of a page; where no name speaks, running text counts and short or linked blocks do not."""
    said = [silver(b) for b in page]
    named = any(said)
    return [
        bool(s) if s is not None else not named and len(b.text) >= 60 and b.linked < len(b.text) / 3
        for s, b in zip(said, page)
    ]


def _slot(token: str, slots: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % slots


@dataclass
class Sequence:
    """Vectors' ingredients of a page: slots of each block's path and words, and a few numbers."""

    paths: list[np.ndarray]
    words: list[np.ndarray]
    numbers: np.ndarray


def sequence(page: list[Block]) -> Sequence:
    known: dict[str, int] = {}
    paths, words, numbers = [], [], []
    total = sum(len(b.text) for b in page)
    before = 0
    for b in page:
        tokens = {n for p in b.path for n in p.split()} - {"html", "body"}
        if b.path:
            tokens.add("in " + b.path[-1].split()[0])
        paths.append(np.array(sorted({_slot(t, PATH_SLOTS) for t in tokens}), np.int64))
        found = {w for w in b.text.lower().split()}
        for w in found:
            if w not in known:
                known[w] = _slot(w, WORD_SLOTS)
        words.append(np.array(sorted({known[w] for w in found}), np.int64))
        size = len(b.text)
        numbers.append([np.log1p(size) / 5, b.linked / size, before / max(1, total), size / max(1, total),
                        sum(map(b.text.count, ".,;:!?")) / size * 10, 1.0])
        before += size
    return Sequence(paths, words, np.array(numbers, np.float32).reshape(len(page), NUMBERS))


def _mean_rows(table: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
    sizes = np.array([len(s) for s in slots])
    out = np.zeros((len(slots), table.shape[1]), np.float32)
    some = sizes > 0
    if some.any():
        flat = np.concatenate(slots)
        out[some] = np.add.reduceat(table[flat], np.cumsum(sizes)[some] - sizes[some]) / np.sqrt(sizes[some])[:, None]
    return out


@dataclass
class Labeller:
    """Weights of the two-way LSTM."""

    w: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(rng: np.random.Generator) -> "Labeller":
        size = 2 * WIDTH + NUMBERS
        w = {"path": rng.normal(0, 0.3, (PATH_SLOTS, WIDTH)), "word": rng.normal(0, 0.1, (WORD_SLOTS, WIDTH))}
        for way in "lr":
            w[f"x{way}"] = rng.normal(0, 1 / np.sqrt(size), (size, 4 * HIDDEN))
            w[f"h{way}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w[f"b{way}"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])
        w["out"] = rng.normal(0, 1 / np.sqrt(2 * HIDDEN), (2 * HIDDEN, 1))
        w["bias"] = np.zeros(1)
        return Labeller({k: v.astype(np.float32) for k, v in w.items()})

    def inputs(self, pages: list[Sequence]) -> tuple[np.ndarray, np.ndarray]:
        """(blocks, pages, size) vectors, padded, and the mask of true blocks."""
        steps = max(len(p.paths) for p in pages)
        x = np.zeros((steps, len(pages), 2 * WIDTH + NUMBERS), np.float32)
        mask = np.zeros((steps, len(pages), 1), np.float32)
        for i, p in enumerate(pages):
            n = len(p.paths)
            x[:n, i, :WIDTH] = _mean_rows(self.w["path"], p.paths)
            x[:n, i, WIDTH:2 * WIDTH] = _mean_rows(self.w["word"], p.words)
            x[:n, i, 2 * WIDTH:] = p.numbers
            mask[:n, i] = 1
        return x, mask

    def read(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """States after each block, read from the left or from the right; padding leaves them alone."""
        steps, pages, _ = x.shape
        projected = x @ self.w[f"x{way}"] + self.w[f"b{way}"]
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        tape = []
        for t in range(steps) if way == "l" else range(steps - 1, -1, -1):
            gates = projected[t] + h @ self.w[f"h{way}"]
            f, i, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN:])
            new = f * c + i * g
            m = mask[t]
            tanh = np.tanh(new)
            if keep:
                tape.append((t, h, c, f, i, o, g, tanh))
            c = m * new + (1 - m) * c
            h = m * o * tanh + (1 - m) * h
            out[t] = h
        return out, tape

    def probabilities(self, pages: list[Sequence]) -> list[np.ndarray]:
        """Chance of each block to be article text, pages of like length together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i].paths), key=lambda i: len(pages[i].paths))
        while order:
            some = [order.pop()]
            longest = len(pages[some[0]].paths)
            while order and (len(some) + 1) * longest <= PADDED:
                some.append(order.pop())
            x, mask = self.inputs([pages[i] for i in some])
            states = np.concatenate([self.read(x, mask, way, False)[0] for way in "lr"], axis=2)
            p = _sigmoid(states @ self.w["out"] + self.w["bias"])[:, :, 0]
            for k, i in enumerate(some):
                out[i] = p[:len(pages[i].paths), k]
        return out

    def gradients(self, pages: list[Sequence], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        x, mask = self.inputs(pages)
        y = np.zeros_like(mask)
        for k, own in enumerate(labels):
            y[:len(own), k, 0] = own
        read = {way: self.read(x, mask, way, True) for way in "lr"}
        states = np.concatenate([read[way][0] for way in "lr"], axis=2)
        wrong = (_sigmoid(states @ self.w["out"] + self.w["bias"]) - y) * mask / mask.sum()
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        grad["out"] = np.einsum("tph,tpo->ho", states, wrong)
        grad["bias"] = wrong.sum((0, 1))
        back = wrong @ self.w["out"].T
        dx = np.zeros_like(x)
        for side, way in enumerate("lr"):
            dh = np.zeros((len(pages), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, f, i, o, g, tanh in reversed(read[way][1]):
                m = mask[t]
                total = dh + back[t, :, side * HIDDEN:(side + 1) * HIDDEN]
                own = total * m
                inner = dc * m + own * o * (1 - tanh**2)
                gates = np.concatenate([inner * c * f * (1 - f), inner * g * i * (1 - i), own * tanh * o * (1 - o),
                                        inner * i * (1 - g**2)], axis=1)
                grad[f"x{way}"] += x[t].T @ gates
                grad[f"h{way}"] += h.T @ gates
                grad[f"b{way}"] += gates.sum(0)
                dx[t] += gates @ self.w[f"x{way}"].T
                dh = gates @ self.w[f"h{way}"].T + total * (1 - m)
                dc = inner * f + dc * (1 - m)
        for k, p in enumerate(pages):
            for name, slots, low in (("path", p.paths, 0), ("word", p.words, WIDTH)):
                sizes = np.array([len(s) for s in slots])
                if sizes.sum():
                    rows = dx[:len(slots), k, low:low + WIDTH] / np.sqrt(np.maximum(sizes, 1))[:, None]
                    np.add.at(grad[name], np.concatenate(slots), np.repeat(rows, sizes, axis=0))
        return grad


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


_AROUND = ["aside", "aside sidebar", "div sidebar widget", "section comments", "div comment", "div cookie notice",
           "div banner", "form", "div newsletter signup", "div advert", "div sponsored", "header", "footer", "nav menu",
           "div related", "div social share", "ul breadcrumb", "div consent popup", "div promo", "section discussion"]
_BODIES = ["article", "main", "div content", "div post body", "div entry content", "section story", "main article"]


def varied(page: list[Block], labels: list[bool], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """The page with its containers renamed, some blocks of the rest repeated elsewhere, some names dropped."""
    body = _BODIES[rng.integers(len(_BODIES))]
    out: list[tuple[Block, bool]] = []
    for b, y in zip(page, labels):
        path = list(b.path)
        if y:
            if rng.random() < 0.5:
                path = [p if not set(p.split()) & BODY_NAMES - {"body"} else body for p in path]
        elif rng.random() < 0.5:
            path = [*[p for p in path if not set(p.split()) & OTHER_NAMES], _AROUND[rng.integers(len(_AROUND))], *path[-1:]]
        if rng.random() < 0.1:
            path = [p.split()[0] for p in path]
        out.append((Block(b.text, path, b.linked), y))
    others = [b for b, y in zip(page, labels) if not y]
    texts = [b for b, y in zip(page, labels) if y]
    for _ in range(int(rng.integers(0, 7))):
        source = others if others and (not texts or rng.random() < 0.5) else texts
        if not source:
            break
        b = source[rng.integers(len(source))]
        inside = [p for p in b.path if not set(p.split()) & OTHER_NAMES] if rng.random() < 0.5 else ["html", "body"]
        made = Block(b.text, [*inside, _AROUND[rng.integers(len(_AROUND))], ["p", "div", "li", "span"][rng.integers(4)]], b.linked)
        out.insert(int(rng.integers(len(out) + 1)), (made, False))
    return [b for b, _ in out], [y for _, y in out]


def train(pages: list[str], steps: int = STEPS, seed: int = 7) -> Labeller:
    """Fit on the silver labels of some pages by Adam, in a fixed order."""
    rng = np.random.default_rng(seed)
    model = Labeller.fresh(rng)
    read = [(b, silver_labels(b)) for b in map(blocks, pages) if b]
    if not read:
        return model
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    order: list[int] = []
    for step in range(1, steps + 1):
        while len(order) < PAGES_A_STEP:
            order += rng.permutation(len(read)).tolist()
        some = [varied(*read[i], rng) if step % 8 else read[i] for i in order[:PAGES_A_STEP]]
        order = order[PAGES_A_STEP:]
        grad = model.gradients([sequence(b) for b, _ in some], [np.array(y, np.float32) for _, y in some])
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model.w[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def label_blocks(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fit_pages: int = FIT_PAGES,
    fit_chars: int = FIT_CHARS, keep: str | None = None,
) -> DataFrame:
    """(id, blocks, and the column named by ``keep``): every leaf block of every page in page order, as (text, path, probability).

    The labeller is trained on ``fit_pages`` pages of at most ``fit_chars`` characters, those first
    in a hashed order.  Null and empty pages have no blocks; broken markup is read as far as it
    goes; repeated rows are labelled each; other columns are left out.
    """
    usable = pages.filter(F.col(html_col).isNotNull() & (F.char_length(html_col) <= fit_chars))
    sample = hashed_sample(
        usable.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")), F.xxhash64("id", "html"), fit_pages)
    model = pages.sparkSession.sparkContext.broadcast(train(sorted(r["html"] for r in sample.collect())))
    found = pa.list_(pa.struct([("text", pa.string()), ("path", pa.string()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 128):
                read = [blocks(html) for html in strings(part.column(1))]
                chance = model.value.probabilities([sequence(page) for page in read])
                rows = [[{"text": b.text, "path": " > ".join(b.path), "probability": float(p)} for b, p in zip(page, ps)]
                        for page, ps in zip(read, chance)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(rows, found), *part.columns[2:]], ["id", "blocks", *(["kept"] if keep else [])])

    rows = pages.select(pages[id_col].alias("id"), pages[html_col].cast("string").alias("html"),
                        *([pages[keep].alias("kept")] if keep else []))
    kind = pages.schema[id_col].dataType.simpleString()
    tail = f", kept {pages.schema[keep].dataType.simpleString()}" if keep else ""
    out = rows.mapInArrow(run, f"id {kind}, blocks array<struct<text:string,path:string,probability:double>>{tail}")
    return out.toDF(id_col, "blocks", *([keep] if keep else []))
