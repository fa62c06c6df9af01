"""Main text of web pages by a recurrent block labeller in numpy.

A page is read as a sequence of leaf blocks: runs of text that no block-level tag interrupts, each
with the path of tags, classes and ids above it. Two vectors stand for a block, the sum
of learned vectors of its hashed path and the mean of those of its hashed words, beside a
few measures (length, links, punctuation). A bidirectional LSTM reads the blocks of a whole page, so
that every label is given in the light of all others, and the blocks it calls main text
are joined.

There are no labelled pages, so the labeller learns from pages that say what they are: on a bounded
sample of SAMPLE pages, blocks in ``article`` or ``main`` are main text unless something
around them is not. Training pages are varied: article and menus change to plain
elements with other class names, and asides, comments, forms and notices made of text
from other pages are put in, so that paths, places and context all count.

Defined cases: a null or empty html gives an empty text, as does a page without blocks. Unclosed
and crossed tags are closed where HTML says or at the end. An unclosed head or title ends at the first
tag or text that has no place in a head, and an object, canvas, noscript or svg that nothing closes hides no
text; an svg ends at a block-level tag too, unless in a foreignObject, and may close itself. Null urls and page_ids are values like others, repeated rows are read alike, and other
columns are ignored. If there are no pages, there are no rows.
"""

from __future__ import annotations

import html
import io
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.frames import Batches, Columns, bounded_sample, by_batch
from bazaarlens.llm.words import mix, span_hashes, word_spans

SAMPLE = 500
#: Of a training page: most blocks, in a row, and most characters of each block.
TRAIN_BLOCKS = 48
TRAIN_CHARS = 400
PATHS = 1 << 12
WORDS = 1 << 11
PATH_SIZE = 24
WORD_SIZE = 8
MEASURES = 6
HIDDEN = 24
EPOCHS = 5
BATCH = 32
RATE = 0.01
#: Blocks that are labelled together; a longer page is labelled alone.
TOGETHER = 8192

#: HTML's elements without content, those whose content is no text, and those that
#: break a line of text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN_TEXT = frozenset("script style noscript template head title svg canvas object iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main "
    "menu nav ol option p pre search section select summary table tbody td textarea tfoot th thead tr ul".split()
)
#: Elements that do not end a head.
HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Hidden elements that hide nothing if no tag closes them; of the last two, all up to the tag is skipped.
FALLBACK = frozenset(("object", "canvas"))
SKIPPED = frozenset(("noscript", "svg"))
#: An element closes open ones of these kinds when it begins.
CLOSES = {
    "li": {"li"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
#: Where such a search for an open element ends.
SCOPES = frozenset("table ul ol dl select div section article main body nav aside header footer form".split())
#: Words of tags, classes and ids that say what an element is; teachers of the labeller only.
MAIN_WORDS = frozenset("article main content post entry story body-text articlebody post-content".split())
OTHER_WORDS = frozenset(
    "nav menu navbar header footer aside sidebar form ad ads advert advertisement banner promo sponsored "
    "comment comments reply replies cookie consent notice alert popup modal share social related recommended "
    "newsletter subscribe login search breadcrumb breadcrumbs pagination pager legal copyright widget toolbar".split()
)
_RAW = r"<(?P<raw>script|style|template|textarea|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
#: A title that is closed before its head is.
_TITLE = r"<title(?=[\s/>])[^>]*+>(?:(?!</?(?:title|head|body)[\s/>]).)*+</title\s*>"
#: A quote opens a value straight after "=" only; elsewhere it is a character like others.
_TAG = r"""<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:=\s*+(?:"[^"]*"|'[^']*'|[^\s>]*+)|[^>=])*+)>"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|{_TITLE}|{_RAW}|{_TAG}", re.S | re.I)
_END = re.compile(r"</(object|canvas|noscript|svg)(?=[\s/>])[^>]*>?", re.I)
#: What ends an svg from inside, or lets it hold other elements.
_BREAKOUT = re.compile(rf"<(foreignobject|{'|'.join(sorted(BLOCKS))})(?=[\s/>])", re.I)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SIGNS = re.compile(r"[.,;:!?]")


@dataclass(frozen=True, eq=False, slots=True)
class Spot:
    """A place in the tree of a page: the marks of an element, and the place of the one around it."""

    above: Spot | None
    marks: tuple[str, ...]

    def path(self) -> tuple[str, ...]:
        parts, spot = [], self
        while spot is not None:
            parts.append(spot.marks)
            spot = spot.above
        return tuple(mark for marks in reversed(parts) for mark in marks)


@dataclass
class Block:
    """A leaf block. Of a training block ``text`` is cut, ``size`` and ``linked`` are those of all of it."""

    spot: Spot | None
    text: str
    linked: int
    size: int

    @property
    def path(self) -> tuple[str, ...]:
        return self.spot.path() if self.spot else ()


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order, white space settled and references decoded.

    Blocks share the places above them, so deep pages cost no more than flat ones.
    """
    found: list[Block] = []
    open_tags: list[tuple[str, Spot]] = []
    is_open: Counter[str] = Counter()
    held: list[str] = []
    links = hidden = linked = at = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                found.append(Block(open_tags[-1][1] if open_tags else None, text, linked, len(text)))
            held.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal links, hidden
        if any(name in BLOCKS for name, _ in open_tags[depth:]):
            flush()
        for name, _ in open_tags[depth:]:
            is_open[name] -= 1
            links -= name == "a"
            hidden -= name in HIDDEN_TEXT
        del open_tags[depth:]

    def leave_head() -> None:
        if is_open["head"] or is_open["title"]:
            close(next(i for i, (name, _) in enumerate(open_tags) if name in ("head", "title")))

    def hear(text: str) -> None:
        nonlocal linked
        if hidden and open_tags[-1][0] == "head" and text.strip():
            leave_head()
        if text and not hidden:
            held.append(text)
            if links:
                linked += len(text)

    page = page or ""
    ends: dict[str, list[tuple[int, int]]] = {}
    for end in _END.finditer(page):
        ends.setdefault(end[1].lower(), []).append(end.span())

    def next_end(name: str) -> tuple[int, int] | None:
        """Where the next tag that closes such an element begins and ends."""
        known = ends.get(name, [])
        nth = bisect_left(known, (at, 0))
        return known[nth] if nth < len(known) else None

    while token := _TOKEN.search(page, at):
        hear(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if hidden and not token["close"] and (name or (token["raw"] or "head").lower()) not in HEAD:
            leave_head()
        if not name:
            continue
        if token["close"]:
            if hidden and name in ("body", "html"):
                leave_head()
            if is_open[name]:
                close(next(i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == name))
            elif name in BLOCKS:
                flush()
            continue
        if name in VOID:
            if name in BLOCKS:
                flush()
            elif name == "br":
                hear(" ")
            continue
        if name in SKIPPED:
            if closer := next_end(name):
                within = _BREAKOUT.search(page, at, closer[0]) if name == "svg" else None
                if not (name == "svg" and token["rest"].endswith("/")):
                    at = within.start() if within and within[1].lower() in BLOCKS else closer[1]
            continue
        if name in FALLBACK and not next_end(name):
            continue
        if name in BLOCKS:
            ended = {"p", *CLOSES.get(name, ())}
            for i in range(len(open_tags) - 1, -1, -1) if any(is_open[kind] for kind in ended) else ():
                if open_tags[i][0] in ended:
                    close(i)
                elif open_tags[i][0] in SCOPES:
                    break
            flush()
        if token["rest"].endswith("/") and name not in BLOCKS:
            continue
        words = [w.lower() for m in _MARKS.finditer(token["rest"]) for w in (m[1] or m[2] or m[3] or "").split()]
        # Of a name of several words, the words count too.
        parts = [p for w in words for p in dict.fromkeys((w, *re.split("[-_]+", w))) if p]
        spot = Spot(open_tags[-1][1] if open_tags else None, (name, *("." + p for p in parts)))
        open_tags.append((name, spot))
        is_open[name] += 1
        links += name == "a"
        hidden += name in HIDDEN_TEXT
    hear(page[at:])
    flush()
    return found


def teacher(path: tuple[str, ...]) -> bool:
    """Whether a page that names its parts calls a block main text."""
    words = {part for mark in path for part in (mark.lstrip("."), *mark.lstrip(".").split("-"))}
    return bool(words & MAIN_WORDS) and not words & OTHER_WORDS


def measures(block: Block) -> list[float]:
    return [
        np.log1p(block.size) / 6.0,
        min(block.linked / block.size, 1.0),
        len(_SIGNS.findall(block.text)) / (block.text.count(" ") + 1.0),
        float("©" in block.text),
        float(block.spot is not None and block.spot.marks[-1] == "p"),
        1.0,
    ]


def hashed(name: str, size: int) -> int:
    raw = np.frombuffer(name.encode("utf-8", "surrogatepass"), np.uint8)
    one = span_hashes(raw, np.array([0]), np.array([len(raw)]))
    return int(mix(one)[0] % np.uint64(size))


class Labeller:
    """Two embeddings, an LSTM in each direction, and one output."""

    NAMES = ("paths", "words", "in0", "rec0", "bias0", "in1", "rec1", "bias1", "out", "out_bias")

    def __init__(self, seed: int = 3) -> None:
        draw = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + MEASURES
        scaled = lambda *shape, by: (draw.standard_normal(shape) * by).astype(np.float32)
        self.weights = {
            "paths": scaled(PATHS, PATH_SIZE, by=0.3),
            "words": scaled(WORDS, WORD_SIZE, by=0.1),
            "out": scaled(2 * HIDDEN, by=0.2),
            "out_bias": np.zeros(1, np.float32),
        }
        for way in "01":
            self.weights["in" + way] = scaled(size, 4 * HIDDEN, by=size**-0.5)
            self.weights["rec" + way] = scaled(HIDDEN, 4 * HIDDEN, by=HIDDEN**-0.5)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.weights["bias" + way] = bias
        self._known: dict[str, int] = {}

    def dump(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, **self.weights)
        return held.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Labeller:
        made, held = cls(), np.load(io.BytesIO(raw))
        made.weights = {name: held[name] for name in cls.NAMES}
        return made

    def _number(self, mark: str) -> int:
        number = self._known.get(mark)
        if number is None:
            if len(self._known) > 100_000:
                self._known.clear()
            number = self._known[mark] = hashed(mark, PATHS)
        return number

    def inputs(self, blocks: list[Block]) -> tuple:
        """The places of the blocks (see ``places``), word numbers, where each block's begin, and measures."""
        raws = [b.text.encode("utf-8", "surrogatepass") for b in blocks]
        data = np.frombuffer(b"\n".join(raws), np.uint8)
        starts, ends = word_spans(data)
        words = (span_hashes(data, starts, ends) % np.uint64(WORDS)).astype(np.int64)
        edges = np.cumsum([0] + [len(r) + 1 for r in raws[:-1]])
        extra = np.array([measures(b) for b in blocks], np.float32)
        return self.places(blocks), words, np.searchsorted(starts, edges), extra

    def places(self, blocks: list[Block]) -> tuple:
        """Every place above the blocks once.

        Numbers of the places' marks and where each place's begin, the place around each (0: none; places count from
        1), the places by depth, each block's place, and the number of each block's last mark.
        """
        number: dict[int, int] = {}
        marks, cuts, above, levels = [], [], [0], []
        depths, own, leaves = [0], [], []
        for block in blocks:
            line, spot = [], block.spot
            while spot is not None and id(spot) not in number:
                line.append(spot)
                spot = spot.above
            at = number[id(spot)] if spot is not None else 0
            for spot in reversed(line):
                above.append(at)
                depth = depths[at]
                at = number[id(spot)] = len(above) - 1
                depths.append(depth + 1)
                if len(levels) == depth:
                    levels.append([])
                levels[depth].append(at)
                cuts.append(len(marks))
                marks.extend(map(self._number, spot.marks))
            own.append(number[id(block.spot)] if block.spot is not None else 0)
            leaves.append(self._number("leaf " + (block.spot.marks[-1] if block.spot else "")))
        return (
            np.array(marks, np.int64), np.array(cuts, np.int64), np.array(above),
            [np.array(level) for level in levels], np.array(own), np.array(leaves),
        )

    def path_vectors(self, places: tuple) -> np.ndarray:
        """The sum of the marks above each block: of a place, its own and the sum of the place around it."""
        marks, cuts, above, levels, own, leaves = places
        table = self.weights["paths"]
        sums = np.zeros((len(above), PATH_SIZE), table.dtype)
        if len(cuts):
            sums[1:] = np.add.reduceat(table[marks], cuts, axis=0)
        for level in levels[1:]:
            sums[level] += sums[above[level]]
        return sums[own] + table[leaves]

    def vectors(self, inputs: tuple) -> np.ndarray:
        places, words, word_cuts, extra = inputs
        sizes = np.diff(np.append(word_cuts, len(words)))[:, None]
        means = np.add.reduceat(self.weights["words"][words], word_cuts, axis=0) / sizes
        return np.hstack((self.path_vectors(places), means, extra))

    def read(self, x: np.ndarray, real: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """One LSTM over (steps, pages, inputs): its states, and if kept what training needs of each step."""
        w_in, w_rec, bias = (self.weights[n + way] for n in ("in", "rec", "bias"))
        steps, pages, _ = x.shape
        driven = x @ w_in + bias
        h = c = np.zeros((pages, HIDDEN), np.float32)
        states, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps) if way == "0" else range(steps - 1, -1, -1):
            z = driven[t] + h @ w_rec
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            on = real[t][:, None]
            new = f * c + i * g
            bent = np.tanh(new)
            if keep:
                kept.append((t, h, c, i, f, o, g, bent, on))
            c, h = np.where(on, new, c), np.where(on, o * bent, h)
            states[t] = h
        return states, kept

    def probabilities(self, x: np.ndarray, real: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        ahead, kept0 = self.read(x, real, "0", keep)
        back, kept1 = self.read(x, real, "1", keep)
        states = np.concatenate((ahead, back), axis=2)
        p = 1 / (1 + np.exp(-(states @ self.weights["out"] + self.weights["out_bias"])))
        return p, [states, kept0, kept1]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which of its blocks are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((n for n, p in enumerate(pages) if p), key=lambda n: len(pages[n]))
        while order:
            steps, chosen = len(pages[order[-1]]), [order.pop()]
            while order and steps * (len(chosen) + 1) <= TOGETHER:
                chosen.append(order.pop())
            x, real, _ = self.grid([pages[n] for n in chosen])
            p, _ = self.probabilities(x, real)
            for k, n in enumerate(chosen):
                out[n] = p[: len(pages[n]), k] > 0.5
        return out

    def grid(self, pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, tuple]:
        sizes = np.array([len(p) for p in pages])
        inputs = self.inputs([b for p in pages for b in p])
        page = np.repeat(np.arange(len(pages)), sizes)
        step = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        x = np.zeros((sizes.max(), len(pages), PATH_SIZE + WORD_SIZE + MEASURES), np.float32)
        real = np.zeros(x.shape[:2], bool)
        x[step, page] = self.vectors(inputs)
        real[step, page] = True
        return x, real, (inputs, step, page)

    def slopes(self, pages: list[list[Block]], truth: list[list[bool]]) -> dict[str, np.ndarray]:
        """The gradient of the mean logistic loss over the blocks of some pages."""
        x, real, (inputs, step, page) = self.grid(pages)
        p, (states, kept0, kept1) = self.probabilities(x, real, keep=True)
        wrong = np.zeros_like(p)
        wrong[step, page] = (p[step, page] - np.array([y for ys in truth for y in ys])) / len(step)
        made = {n: np.zeros_like(w) for n, w in self.weights.items()}
        made["out"] = np.einsum("tp,tph->h", wrong, states)
        made["out_bias"] = wrong.sum(keepdims=True).reshape(1)
        back_x = np.zeros_like(x)
        for way, kept in (("0", kept0), ("1", kept1)):
            part = slice(0, HIDDEN) if way == "0" else slice(HIDDEN, None)
            w_in, w_rec = self.weights["in" + way], self.weights["rec" + way]
            dh = dc = np.zeros(kept[0][1].shape, np.float32)
            for t, h, c, i, f, o, g, bent, on in reversed(kept):
                whole = dh + wrong[t][:, None] * self.weights["out"][part]
                live = np.where(on, whole, 0)
                inner = np.where(on, dc, 0) + live * o * (1 - bent * bent)
                dz = np.hstack(
                    (inner * g * i * (1 - i), inner * c * f * (1 - f), live * bent * o * (1 - o), inner * i * (1 - g * g))
                )
                made["in" + way] += x[t].T @ dz
                made["rec" + way] += h.T @ dz
                made["bias" + way] += dz.sum(axis=0)
                back_x[t] += dz @ w_in.T
                dh = dz @ w_rec.T + np.where(on, 0, whole)
                dc = inner * f + np.where(on, 0, dc)
        (marks, cuts, above, levels, own, leaves), words, word_cuts, _ = inputs
        flat = back_x[step, page]
        n_words = np.diff(np.append(word_cuts, len(words)))
        by_place = np.zeros((len(above), PATH_SIZE), flat.dtype)
        np.add.at(by_place, own, flat[:, :PATH_SIZE])
        for level in reversed(levels[1:]):
            np.add.at(by_place, above[level], by_place[level])
        np.add.at(made["paths"], marks, np.repeat(by_place[1:], np.diff(np.append(cuts, len(marks))), axis=0))
        np.add.at(made["paths"], leaves, flat[:, :PATH_SIZE])
        mean = flat[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] / n_words[:, None]
        np.add.at(made["words"], words, np.repeat(mean, n_words, axis=0))
        return made


def spot_of(path: Sequence[str]) -> Spot | None:
    return Spot(None, tuple(path)) if path else None


def varied(blocks: list[Block], others: list[str], draw: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A training page with other names for its parts and parts put in, and its labels."""
    truth = [teacher(b.path) for b in blocks]
    pick = lambda words: sorted(words)[int(draw.integers(len(words)))]
    main, renamed = pick(MAIN_WORDS), {}
    change_main, change_other, keep_hints = draw.random(3)
    out: list[tuple[Block, bool]] = []
    for block, is_main in zip(blocks, truth, strict=True):
        path: list[str] = []
        for mark in block.path:
            if mark in ("article", "main") and change_main < 0.5:
                path += ["div", "." + main] if keep_hints < 0.8 else ["div"]
            elif mark.lstrip(".") in OTHER_WORDS and change_other < 0.5:
                path += ["div", "." + renamed.setdefault(mark, pick(OTHER_WORDS))]
            else:
                path.append(mark)
        out.append((Block(spot_of(path), block.text, block.linked, block.size), is_main))
    inside = [n for n, (_, y) in enumerate(out) if y]
    for _ in range(int(draw.integers(0, 4))):
        kind, text = pick(OTHER_WORDS), others[int(draw.integers(len(others)))]
        stem = ("html", "body")
        if inside and draw.random() < 0.4:
            at = inside[int(draw.integers(len(inside)))]
            above = out[at][0].path
            stem = above[:-1] if above[-1:] in (("p",), ("h1",)) else above
        else:
            at = int(draw.choice([0, len(out)]))
        leaf = ("p",) if draw.random() < 0.5 else ()
        tag = (kind,) if kind in ("nav", "header", "footer", "aside", "form") else ("div", "." + kind)
        linked = 0 if draw.random() < 0.7 else len(text)
        out.insert(at, (Block(spot_of((*stem, *tag, *leaf)), text, linked, len(text)), False))
        inside = [n for n, (_, y) in enumerate(out) if y]
    return [b for b, _ in out], [y for _, y in out]


def learn(pages: list[list[Block]], seed: int = 3) -> Labeller:
    labeller, draw = Labeller(seed), np.random.default_rng(seed)
    pages = [p for p in pages if p]
    others = sorted({b.text for p in pages for b in p}) or ["-"]
    moments = {n: (np.zeros_like(w), np.zeros_like(w)) for n, w in labeller.weights.items()}
    turn = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(pages))
        for at in range(0, len(order), BATCH):
            made = [varied(pages[i], others, draw) for i in order[at : at + BATCH]]
            turn += 1
            for name, by in labeller.slopes([b for b, _ in made], [y for _, y in made]).items():
                mean, square = moments[name]
                mean += 0.1 * (by - mean)
                square += 0.001 * (by * by - square)
                step = (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
                labeller.weights[name] -= (RATE * step).astype(np.float32)
    return labeller


def fit(pages: DataFrame) -> Labeller:
    """Learn from a bounded sample of ``pages`` (page_id, url, html), cut to a bounded size each."""
    chosen = bounded_sample(pages.where("html is not null").select("page_id", "url", "html"), SAMPLE, "page_id", "url")

    names = ("page", "n", "path", "text", "linked", "size")

    def shorten(batches: Batches) -> Iterator[Columns]:
        for batch in batches:
            rows = []
            for key, page in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True):
                blocks = blocks_of(page)
                # A page's two ends, where main text begins and ends.
                half = TRAIN_BLOCKS // 2
                if len(blocks) > TRAIN_BLOCKS:
                    blocks = blocks[:half] + blocks[-half:]
                for n, b in enumerate(blocks):
                    rows.append((str(key), n, list(b.path), b.text[:TRAIN_CHARS], b.linked, b.size))
            yield {name: [row[i] for row in rows] for i, name in enumerate(names)}

    schema = "page string, n int, path array<string>, text string, linked long, size long"
    rows = by_batch(chosen, shorten, schema).collect()
    pages_of: dict[str, list[Block]] = {}
    for r in sorted(rows, key=lambda r: (r["page"], r["n"])):
        pages_of.setdefault(r["page"], []).append(Block(spot_of(r["path"]), r["text"], r["linked"], r["size"]))
    return learn(list(pages_of.values()))


def main_texts(labeller: Labeller, pages: list[str | None]) -> Iterator[str]:
    blocks = [blocks_of(p) for p in pages]
    for found, chosen in zip(blocks, labeller.label(blocks), strict=True):
        yield "\n".join(b.text for b, ok in zip(found, chosen, strict=True) if ok)


def extracted(pages: DataFrame, labeller: Labeller) -> DataFrame:
    model = pages.sparkSession.sparkContext.broadcast(labeller.dump())

    def run(batches: Batches) -> Iterator[Columns]:
        own = Labeller.load(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = list(main_texts(own, part.column("html").to_pylist()))
                yield {"page_id": part.column("page_id"), "url": part.column("url"), "text": texts}

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    found = by_batch(rows, run, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    return extracted(pages, fit(pages))
