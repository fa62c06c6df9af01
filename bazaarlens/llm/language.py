"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a label. Its emission scores are sums of learned weights of
hashed features: character n-grams of one to four bytes, the same at the start and at the
end of the word (affixes), and the word itself if it is one of the LEXICON most frequent
training words. Learned transitions tie neighbours together, and forward-backward
gives each word's probabilities in its window of WINDOW words, so that a text which
switches between languages gets both. The language of a text is the one with the
largest mean probability over all its words, and that mean is the score.

Training takes a bounded sample: SAMPLE documents of each language, WORDS words of each, in
runs from all over the text. Half of the training windows are spliced from two languages,
from which the transitions are learned.

Defined cases: null texts and texts without a letter are ``und`` with score 0. Rows whose
lang is null are never learned from. If nothing can be learned, every text is ``und``.
Repeated rows are judged alike; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.frames import Batches, Columns, by_batch, ship
from bazaarlens.llm.words import mix, span_hashes, word_spans

#: The sample: documents of each language, and words of each document in runs.
SAMPLE = 400
WORDS = 192
RUN = 32
#: The model: hashed features, lexicon words, words of a window.
FEATURES = 1 << 16
LEXICON = 4000
WINDOW = 64
EPOCHS = 4
BATCH = 48
RATE = 0.15
DECAY = 1e-6
#: Bytes of text labelled at once.
SLICE = 1 << 20
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = _LETTERS[65:91] = _LETTERS[128:] = True
_GRAMS = 4


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, one after the other, and where each word's begin."""
    sizes = ends - starts
    word = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at, left = starts[word] + place, sizes[word] - place
    low = _LOWER[np.concatenate((data, np.zeros(_GRAMS, np.uint8)))]
    code, found, owner = np.zeros(len(at), np.uint64), [], []
    for n in range(1, _GRAMS + 1):
        code = code | low[at + n - 1] << np.uint64(8 * (n - 1))
        for kind, mask in enumerate((left >= n, (left >= n) & (place == 0), left == n)):
            salted = code[mask] ^ np.uint64((n * 4 + kind) << 40)
            found.append((mix(salted) % np.uint64(FEATURES)).astype(np.int64))
            owner.append(word[mask])
    owner_all, found_all = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner_all, kind="stable")
    return found_all[order], np.searchsorted(owner_all[order], np.arange(len(starts)))


class Tagger:
    """The learned weights. All rows of ``emit`` past FEATURES are lexicon words."""

    def __init__(self, languages: list[str], lexicon: np.ndarray) -> None:
        n = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.emit = np.zeros((FEATURES + len(lexicon) + 1, n), np.float32)
        self.step, self.start = np.zeros((n, n)), np.zeros(n)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, languages=self.languages, lexicon=self.lexicon, emit=self.emit, step=self.step, start=self.start)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Tagger:
        held = np.load(io.BytesIO(raw))
        made = cls(held["languages"].tolist(), held["lexicon"])
        made.emit, made.step, made.start = held["emit"], held["step"], held["start"]
        return made

    def lexicon_row(self, hashes: np.ndarray) -> np.ndarray:
        """The row of a word's own weights; the last row, always zero, for all others."""
        at = np.minimum(np.searchsorted(self.lexicon, hashes), max(len(self.lexicon) - 1, 0))
        known = self.lexicon[at] == hashes if len(self.lexicon) else np.zeros(len(hashes), bool)
        return FEATURES + np.where(known, at, len(self.lexicon))

    def word_scores(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Emission scores of each word; equal words are worked out once."""
        hashes, first, same = np.unique(
            span_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        found, cuts = features(data, starts[first], ends[first])
        sums = np.add.reduceat(self.emit[found], cuts, axis=0)
        return (sums + self.emit[self.lexicon_row(hashes)])[same]

    def chain(self, scores: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each word's labels in windows (windows, words, labels), and the
        expected transitions. ``real`` is false behind the end of a short window."""
        windows, words, _ = scores.shape
        emit = np.exp(scores - scores.max(axis=2, keepdims=True))
        step, start = np.exp(self.step), np.exp(self.start)
        ahead, back = np.empty_like(emit), np.ones_like(emit)
        ahead[:, 0] = emit[:, 0] * start
        ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, words):
            now = ahead[:, t - 1] @ step * emit[:, t]
            ahead[:, t] = now / now.sum(axis=1, keepdims=True)
        for t in range(words - 2, -1, -1):
            now = (back[:, t + 1] * emit[:, t + 1]) @ step.T
            now /= now.sum(axis=1, keepdims=True)
            back[:, t] = np.where(real[:, t + 1, None], now, 1.0)
        both = ahead * back
        both /= both.sum(axis=2, keepdims=True)
        moved = ahead[:, :-1, :, None] * step * (emit * back)[:, 1:, None, :]
        moved /= moved.sum(axis=(2, 3), keepdims=True)
        return both, (moved * real[:, 1:, None, None]).sum(axis=(0, 1))

    def marginals(self, scores: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Probabilities of each word's labels; no window reaches over a text's end."""
        sizes = np.diff(cuts)
        place = np.arange(len(scores)) - np.repeat(cuts[:-1], sizes)
        per_text = -(-sizes // WINDOW)
        window = np.repeat(np.cumsum(per_text) - per_text, sizes) + place // WINDOW
        grid = np.zeros((int(per_text.sum()), WINDOW, scores.shape[1]), np.float32)
        real = np.zeros(grid.shape[:2], bool)
        grid[window, place % WINDOW] = scores
        real[window, place % WINDOW] = True
        out = np.empty_like(scores)
        for a in range(0, len(grid), 2048):
            both, _ = self._both(grid[a : a + 2048], real[a : a + 2048])
            inside = (window >= a) & (window < a + 2048)
            out[inside] = both[window[inside] - a, place[inside] % WINDOW]
        return out

    def _both(self, grid: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, None]:
        """As ``chain``, without the transitions that only training needs."""
        words = grid.shape[1]
        emit = np.exp(grid - grid.max(axis=2, keepdims=True)).transpose(1, 0, 2).copy()
        step, start = np.exp(self.step).astype(np.float32), np.exp(self.start).astype(np.float32)
        ahead, later = np.empty_like(emit), np.ones_like(emit[0])
        ahead[0] = emit[0] * start
        for t in range(1, words):
            now = ahead[t - 1] @ step * emit[t]
            ahead[t] = now / now.sum(axis=1, keepdims=True)
        for t in range(words - 1, -1, -1):
            ahead[t] *= later
            ahead[t] /= ahead[t].sum(axis=1, keepdims=True)
            now = (later * emit[t]) @ step.T
            later = np.where(real[:, t, None], now / now.sum(axis=1, keepdims=True), np.float32(1))
        return ahead.transpose(1, 0, 2), None

    def languages_of(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        held: list[str | None] = []
        size = 0
        for text in texts:
            n = 4 * len(text or "")
            if held and size + n > SLICE:
                yield from self._judge(held)
                held, size = [], 0
            held.append(text)
            size += n
        yield from self._judge(held)

    def _judge(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        lettered = [bool(t) and bool(_LETTER.search(t)) for t in texts]
        sums = np.zeros((len(texts), len(self.languages)))
        votes = np.zeros(len(texts))
        if len(texts) == 1 and lettered[0]:
            self._count(texts, sums, votes, 0)
        else:
            self._count([t if ok else "" for t, ok in zip(texts, lettered, strict=True)], sums, votes, 0)
        for ok, total, n in zip(lettered, sums, votes, strict=True):
            if ok and n and len(self.languages):
                best = int(total.argmax())
                yield self.languages[best], min(float(total[best] / n), 1.0)
            else:
                yield UNKNOWN, 0.0

    def _count(self, texts: list[str | None], sums: np.ndarray, votes: np.ndarray, first: int) -> None:
        """Add up the probabilities of the words with a letter, slice by slice."""
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join(raws), np.uint8)
        edges = np.cumsum([0] + [len(r) + 1 for r in raws])
        starts, ends = word_spans(data)
        if not len(starts) or not self.languages:
            return
        spoken = np.add.reduceat(_LETTERS[data].astype(np.int32), starts) > 0
        starts, ends = starts[spoken], ends[spoken]
        for a in range(0, len(starts), SLICE // 4):
            part = slice(a, a + SLICE // 4)
            low, high = int(starts[part][0]), int(ends[part][-1])
            own = data[low:high]
            scores = self.word_scores(own, starts[part] - low, ends[part] - low)
            text = np.searchsorted(edges, starts[part], side="right") - 1
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(text)) + 1, [len(text)]))
            likely = self.marginals(scores, cuts)
            np.add.at(sums, text[cuts[:-1]] + first, np.add.reduceat(likely, cuts[:-1], axis=0))
            np.add.at(votes, text[cuts[:-1]] + first, np.diff(cuts))


def word_runs(text: str) -> list[str]:
    """At most WORDS words of a text, in runs spread evenly over the whole of it."""
    words = text.split()
    if len(words) <= WORDS:
        return words
    starts = np.linspace(0, len(words) - RUN, WORDS // RUN).astype(int)
    return [w for s in starts for w in words[s : s + RUN]]


def _features_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, and how many each has, worked out in small parts."""
    found, sizes = [], []
    for at in range(0, len(words), 8192):
        part = words[at : at + 8192]
        ends = np.cumsum([len(w) + 1 for w in part]) - 1
        numbers, cuts = features(
            np.frombuffer(b"\n".join(part), np.uint8), ends - [len(w) for w in part], ends
        )
        found.append(numbers.astype(np.uint16 if FEATURES <= 1 << 16 else np.uint32))
        sizes.append(np.diff(np.append(cuts, len(numbers))))
    return np.concatenate(found), np.concatenate(sizes)


def learn(samples: list[tuple[str, list[str]]], seed: int = 7) -> Tagger:
    """Fit a tagger to (language, words) pairs by maximum likelihood with Adagrad."""
    languages = sorted({lang for lang, words in samples if words})
    if not languages:
        return Tagger([], np.empty(0, np.uint64))
    draw = np.random.default_rng(seed)
    label = {lang: n for n, lang in enumerate(languages)}
    stream = {lang: [w for k, ws in samples if k == lang for w in ws] for lang in languages}
    words = [w for lang in languages for w in stream[lang]]
    labels = np.repeat(np.arange(len(languages)), [len(stream[k]) for k in languages])
    raws = [w.encode("utf-8", "surrogatepass") for w in words]
    data = np.frombuffer(b"\n".join(raws), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raws]) - 1
    starts = ends - [len(r) for r in raws]
    hashes = span_hashes(data, starts, ends)
    distinct, first, same, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    lexicon = np.sort(distinct[(-count).argsort(kind="stable")[:LEXICON]])
    tagger = Tagger(languages, lexicon)
    found, sizes = _features_of([raws[i] for i in first])
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    own_row = tagger.lexicon_row(distinct)
    del words, raws, data, starts, ends, hashes
    spans = {n: (int(np.searchsorted(labels, n)), int(np.searchsorted(labels, n, side="right"))) for n in label.values()}
    sums = {"emit": np.full(tagger.emit.shape, 1e-6, np.float32), "step": np.full(tagger.step.shape, 1e-2), "start": np.full(tagger.start.shape, 1e-2)}
    steps = EPOCHS * max(1, len(labels) // (BATCH * WINDOW))
    for _ in range(steps):
        chosen = np.empty((BATCH, WINDOW), np.int64)
        for row in chosen:
            turns = [0, WINDOW] if draw.random() < 0.5 else sorted([0, int(draw.integers(4, WINDOW - 4)), WINDOW])
            for a, b in zip(turns, turns[1:]):
                low, high = spans[int(draw.integers(len(languages)))]
                at = low + int(draw.integers(max(1, high - low - (b - a) + 1)))
                row[a:b] = np.minimum(np.arange(at, at + b - a), high - 1)
        kinds, truth = same[chosen], labels[chosen]
        seen, place = np.unique(kinds, return_inverse=True)
        seen_sizes = sizes[seen]
        flat = np.concatenate([found[cuts[k] : cuts[k + 1]] for k in seen]).astype(np.int64)
        edges = np.cumsum(seen_sizes) - seen_sizes
        scores = np.add.reduceat(tagger.emit[flat], edges, axis=0) + tagger.emit[own_row[seen]]
        likely, moved = tagger.chain(scores[place.reshape(kinds.shape)], np.ones(kinds.shape, bool))
        wrong = likely
        np.subtract.at(wrong, (np.arange(BATCH)[:, None], np.arange(WINDOW), truth), 1.0)
        per_kind = np.zeros((len(seen), len(languages)), np.float32)
        np.add.at(per_kind, place.ravel(), wrong.reshape(-1, len(languages)))
        slope = np.zeros_like(tagger.emit)
        spread = np.repeat(per_kind, seen_sizes, axis=0)
        for n in range(len(languages)):
            slope[:, n] += np.bincount(flat, spread[:, n], len(slope))
        slope[own_row[seen]] += per_kind
        slope[-1] = 0
        true_moves = np.zeros_like(tagger.step)
        np.add.at(true_moves, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1.0)
        slopes = {"emit": slope, "step": moved - true_moves, "start": wrong[:, 0].sum(axis=0)}
        for name, by in slopes.items():
            weights = getattr(tagger, name)
            by = by / BATCH + DECAY * weights
            sums[name] += by * by
            weights -= (RATE * by / np.sqrt(sums[name])).astype(weights.dtype)
    return tagger


def fit(docs: DataFrame, learnable: Column, sample: int = SAMPLE) -> Tagger:
    """Learn from a bounded sample of the rows of ``docs`` (text, lang) that are ``learnable``.

    Each language gives about ``sample`` documents, chosen by the hash of their text from all
    of its rows, and WORDS words of each: that is all that reaches the driver.
    """
    rows = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return learn([])
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample / n))])
    spread = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1_000_003)) / 1_000_003.0
    chosen = rows.where(spread < share[F.col("lang")]).select("text", "lang")

    def shorten(batches: Batches) -> Iterator[Columns]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield {"lang": batch.column("lang"), "words": [word_runs(t) for t in texts]}

    found = by_batch(chosen, shorten, "lang string, words array<string>").distinct()
    # Twice the expected number, so that a hot text cannot swell what is gathered.
    found = found.orderBy(F.xxhash64("words")).limit(2 * sample * len(counts))
    return learn(sorted((r["lang"], list(r["words"])) for r in found.collect()))


def labelled(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred, score."""
    model = docs.sparkSession.sparkContext.broadcast(tagger.dump())

    def run(batches: Batches) -> Iterator[Columns]:
        own = Tagger.load(model.value)
        for batch in batches:
            judged = list(own.languages_of(batch.column("text").to_pylist()))
            yield {
                "doc_id": batch.column("doc_id"),
                "lang_pred": [lang for lang, _ in judged],
                "score": [score for _, score in judged],
            }

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return by_batch(rows, run, "doc_id long, lang_pred string, score double")


def remainder(parts: int) -> Column:
    """crc32 of the doc_id as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def held_out() -> Column:
    return F.coalesce(remainder(4) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score."""
    tagger = fit(docs, ~held_out())
    return labelled(docs, tagger).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language is identified, with all their columns.

    Rejected are texts that are ``und``, and those for which no language reaches ``least``.
    """
    tagger = fit(docs, ~held_out())
    model = docs.sparkSession.sparkContext.broadcast(tagger.dump())

    def run(batches: Batches) -> Batches:
        own = Tagger.load(model.value)
        for batch in batches:
            judged = list(own.languages_of(batch.column("text").to_pylist()))
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in judged]))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
