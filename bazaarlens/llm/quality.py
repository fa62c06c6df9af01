"""Quality scores by a byte-level convolutional network in numpy.

A text is cut to chunks of CHUNK bytes that overlap by OVERLAP and cover all of it. Each of
FILTERS learned filters reads WIDTH neighbouring bytes at every place, rectified, and
keeps its largest answer in the chunk. The mean and the largest of these over all chunks go
through a small dense layer to one probability, that of label 1.

Training takes a bounded sample: SAMPLE labelled rows, chosen by hash from all of
them, and of each text at most CHUNKS chunks spread evenly over the whole of it. Scoring reads
every byte.

Defined cases: null and empty texts are one chunk of padding and get its score. If
there are no labelled rows, or only one label, every score is 0.5 or the label. Labels without
a document, and null labels, are not learned from. Repeated rows are scored alike;
other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.frames import Batches, Columns, bounded_sample, by_batch

CHUNK = 512
OVERLAP = 64
FILTERS = 16
WIDTH = 6
HIDDEN = 12
SAMPLE = 1500
CHUNKS = 6
EPOCHS = 6
UPDATES = 240
BATCH = 32
RATE = 0.01
#: From this score on a text is predicted to be good.
THRESHOLD = 0.3
#: Bytes convolved at once.
SLICE = 1 << 17
#: Padding behind the end of a text: a value that no byte has.
PAD = 256
_NAMES = ("taps", "bias", "dense", "dense_bias", "out", "out_bias")


def chunk_starts(n: int) -> np.ndarray:
    """Where the chunks of n bytes begin: the last one reaches the end."""
    return np.arange(0, max(n - OVERLAP, 1), CHUNK - OVERLAP)


class Network:
    def __init__(self, seed: int = 5) -> None:
        draw = np.random.default_rng(seed)
        scaled = lambda *shape, by: (draw.standard_normal(shape) * by).astype(np.float32)
        self.taps = scaled(WIDTH, PAD + 1, FILTERS, by=0.2)
        self.taps[:, PAD] = 0
        self.bias = np.zeros(FILTERS, np.float32)
        self.dense = scaled(2 * FILTERS, HIDDEN, by=(1 / FILTERS) ** 0.5)
        self.dense_bias = np.zeros(HIDDEN, np.float32)
        self.out = scaled(HIDDEN, by=(1 / HIDDEN) ** 0.5)
        self.out_bias = np.zeros(1, np.float32)
        self._pairs: list[np.ndarray] = []

    def dump(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, **{name: getattr(self, name) for name in _NAMES})
        return held.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Network:
        made, held = cls(), np.load(io.BytesIO(raw))
        for name in _NAMES:
            setattr(made, name, held[name])
        return made

    def combine(self, peaks: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the mean and largest peaks, the dense layer, and the probability.

        Plain sums, so that a text's score does not depend on those beside it.
        """
        sizes = np.diff(np.append(cuts, len(peaks)))[:, None]
        both = np.hstack((np.add.reduceat(peaks, cuts) / sizes, np.maximum.reduceat(peaks, cuts)))
        hidden = np.maximum((both[:, :, None] * self.dense).sum(axis=1) + self.dense_bias, 0)
        total = (hidden * self.out).sum(axis=1) + self.out_bias
        return both, hidden, 1 / (1 + np.exp(-np.clip(total, -40, 40)))

    def _pair_tables(self) -> list[np.ndarray]:
        """The answers to two neighbouring bytes at once, for each pair of taps."""
        if not self._pairs:
            for k in range(0, WIDTH, 2):
                both = self.taps[k][:, None] + self.taps[k + 1][None]
                self._pairs.append(both.reshape(-1, FILTERS))
        return self._pairs

    def scores(self, raws: list[bytes]) -> Iterator[float]:
        """The probability of each text."""
        held: list[bytes] = []
        size = 0
        for raw in raws:
            if held and size + len(raw) > SLICE:
                yield from self._together(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + OVERLAP
        if held:
            yield from self._together(held)

    def _together(self, raws: list[bytes]) -> np.ndarray:
        # A text fills whole steps of OVERLAP bytes, of which chunks are made. A step of padding
        # behind it, in no chunk, keeps the filters off the next text.
        steps = [max(1, -(-len(r) // OVERLAP)) for r in raws]
        first = np.cumsum([0] + [n + 1 for n in steps])
        data = np.full(int(first[-1]) * OVERLAP + WIDTH, PAD, np.int32)
        for at, raw in zip(first, raws, strict=False):
            data[at * OVERLAP : at * OVERLAP + len(raw)] = np.frombuffer(raw, np.uint8)
        tall = np.empty((int(first[-1]), FILTERS), np.float32)
        tables = self._pair_tables()
        for a in range(0, len(tall), SLICE // OVERLAP):
            b = min(a + SLICE // OVERLAP, len(tall))
            own = data[a * OVERLAP : b * OVERLAP + WIDTH]
            pair = own[:-1] * (PAD + 1) + own[1:]
            n = (b - a) * OVERLAP
            total = tables[0][pair[:n]]
            for k in range(1, WIDTH // 2):
                total += tables[k][pair[2 * k : 2 * k + n]]
            tall[a:b] = total.reshape(b - a, OVERLAP, FILTERS).max(axis=1)
        np.maximum(tall + self.bias, 0, out=tall)
        per_chunk = CHUNK // OVERLAP
        begins = [at + np.arange(0, max(n - 1, 1), per_chunk - 1) for at, n in zip(first, steps, strict=False)]
        ends = [np.minimum(s + per_chunk, at + n) for s, at, n in zip(begins, first, steps, strict=False)]
        edges = np.stack((np.concatenate(begins), np.concatenate(ends)), axis=1).ravel()
        peaks = np.maximum.reduceat(tall, edges)[::2]
        cuts = np.cumsum([0] + [len(b) for b in begins[:-1]])
        return self.combine(peaks, cuts)[2]


def training_chunks(raw: bytes) -> np.ndarray:
    """At most CHUNKS chunks of a text, spread evenly, as rows of byte numbers with padding."""
    starts = chunk_starts(len(raw))
    if len(starts) > CHUNKS:
        starts = starts[np.linspace(0, len(starts) - 1, CHUNKS).astype(int)]
    out = np.full((len(starts), CHUNK + WIDTH - 1), PAD, np.int32)
    for row, at in zip(out, starts, strict=True):
        piece = np.frombuffer(raw[at : at + CHUNK], np.uint8)
        row[: len(piece)] = piece
    return out


def learn(samples: list[tuple[int, bytes]], seed: int = 5) -> Network:
    """Fit the network to (label, text) pairs by Adam on the logistic loss."""
    net, draw = Network(seed), np.random.default_rng(seed)
    labels = np.array([y for y, _ in samples], np.float32)
    if len(set(labels.tolist())) < 2:
        net.out[:] = 0
        net.out_bias[:] = 0 if not len(labels) else (40 if labels[0] else -40)
        return net
    chunks = [training_chunks(raw) for _, raw in samples]
    # Both labels count alike, so that the threshold does not follow their mix.
    weight = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    moments = {n: (np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))) for n in _NAMES}
    turn, updates = 0, -(-len(samples) // BATCH)
    for _ in range(max(EPOCHS, -(-UPDATES // updates))):
        order = draw.permutation(len(samples))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            grid = np.concatenate([chunks[i] for i in chosen])
            cuts = np.cumsum([0] + [len(chunks[i]) for i in chosen[:-1]])
            sizes = np.diff(np.append(cuts, len(grid)))
            total = np.zeros((len(grid), CHUNK, FILTERS), np.float32)
            for k in range(WIDTH):
                total += net.taps[k][grid[:, k : k + CHUNK]]
            where = total.argmax(axis=1)
            top = np.take_along_axis(total, where[:, None], axis=1)[:, 0] + net.bias
            peaks = np.maximum(top, 0)
            both, hidden, p = net.combine(peaks, cuts)
            slope = ((p - labels[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
            back_hidden = slope[:, None] * net.out * (hidden > 0)
            back_both = back_hidden @ net.dense.T
            owner = np.repeat(np.arange(len(chosen)), sizes)
            back = back_both[owner, :FILTERS] / sizes[owner, None]
            largest = peaks == both[owner, FILTERS:]
            ties = np.add.reduceat(largest, cuts)[owner]
            back = (back + back_both[owner, FILTERS:] * largest / ties) * (top > 0)
            taps = np.zeros_like(net.taps)
            rows, filters = np.arange(len(grid))[:, None], np.arange(FILTERS)[None]
            for k in range(WIDTH):
                np.add.at(taps[k], (grid[rows, where + k], np.broadcast_to(filters, where.shape)), back)
            taps[:, PAD] = 0
            slopes = {
                "taps": taps + 1e-5 * net.taps,
                "bias": back.sum(axis=0),
                "dense": both.T @ back_hidden,
                "dense_bias": back_hidden.sum(axis=0),
                "out": hidden.T @ slope,
                "out_bias": slope.sum(keepdims=True),
            }
            turn += 1
            for name, by in slopes.items():
                mean, square = moments[name]
                mean += 0.1 * (by - mean)
                square += 0.001 * (by * by - square)
                step = (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
                getattr(net, name)[...] -= RATE * step
    return net


def raw_text(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def fit(docs: DataFrame, labels: DataFrame, learnable: Column) -> Network:
    """Learn from a bounded sample of the rows of ``labels`` (doc_id, quality) that are ``learnable``."""
    known = labels.where(learnable & F.col("quality").isNotNull()).select(
        F.col("doc_id").alias("_id"), "quality"
    )
    chosen = bounded_sample(known, SAMPLE, "_id")
    # SAMPLE rows of two numbers.
    texts = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))

    def shorten(batches: Batches) -> Iterator[Columns]:
        for batch in batches:
            pieces = []
            for text in batch.column("text").to_pylist():
                raw = raw_text(text)
                starts = chunk_starts(len(raw))
                if len(starts) > CHUNKS:
                    kept = starts[np.linspace(0, len(starts) - 1, CHUNKS).astype(int)]
                    raw = b"".join(raw[at : at + CHUNK - OVERLAP] for at in kept)
                pieces.append(raw)
            yield {"quality": batch.column("quality"), "raw": pieces}

    short = by_batch(texts.select("text", F.col("quality").cast("int").alias("quality")), shorten, "quality int, raw binary")
    # A doc_id on many rows must not swell what is gathered.
    found = short.orderBy(F.xxhash64("raw")).limit(2 * SAMPLE).collect()
    return learn(sorted((int(r["quality"] > 0), bytes(r["raw"])) for r in found))


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, score."""
    model = docs.sparkSession.sparkContext.broadcast(net.dump())

    def run(batches: Batches) -> Iterator[Columns]:
        own = Network.load(model.value)
        for batch in batches:
            raws = [raw_text(t) for t in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id"), "score": np.array(list(own.scores(raws)), float)}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return by_batch(rows, run, "doc_id long, score double")


def held_out() -> Column:
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return F.coalesce(rest == 0, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted."""
    net = fit(docs, labels, ~held_out())
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored(docs, net).select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
