"""Token counts by a count-only Viterbi over a unigram vocabulary.

The tokenizer is the ``tokenizers`` library's Unigram model with byte fallback behind a metaspace
pre-tokenizer: spaces become U+2581, one is put before the text, and the text is cut before each.
An Aho-Corasick automaton of the vocabulary finds all pieces that end at a place of such a
word. Dynamic programming carries two numbers for each place: the best score of a path to
it, and the pieces of that path; no path is kept. The tie rules are the tokenizer's: of equal
scores the piece that begins first wins. A character that is no piece itself may stand as
unknown, ten below the worst score of the vocabulary, and is counted by its UTF-8 bytes.

Words are counted once per task while a bounded table remembers them. Scores are kept as far back as
the longest piece reaches, so a word without an end takes no more memory than its text.

Defined cases: a null text has no count (null); an empty text has none (0). Repeated rows
are counted alike; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.frames import Batches, Columns, by_batch

SPACE = "▁"
#: What an unknown character costs below the worst piece.
PENALTY = 10.0
#: Words that a task remembers, and their characters.
REMEMBERED = 500_000
REMEMBERED_CHARS = 1 << 24
#: Characters of a word whose pieces are looked up at once.
STEP = 1 << 12
#: Characters that are counted at once. Cuts are before spaces, or nowhere.
SLICE = 1 << 22

Vocabulary = list[tuple[str, float]]


def vocabulary(path: str) -> Vocabulary:
    """The pieces of a sentencepiece model with their scores, by id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def counter(pieces: Vocabulary) -> Callable[[str], int]:
    """A function that counts the pieces of a pre-tokenized word."""
    automaton = ahocorasick.Automaton()
    for piece, score in pieces:
        if piece and not automaton.exists(piece):
            automaton.add_word(piece, (len(piece), score))
    automaton.make_automaton()
    unknown = min(score for _, score in pieces) - PENALTY
    longest = max(len(piece) for piece, _ in pieces)

    def count(word: str) -> int:
        # The last places, and the pieces of the best path to each.
        best, used = [0.0], [0]
        for start in range(0, len(word), STEP):
            # Pieces that end from here on may begin before.
            back = min(start, longest - 1)
            part = word[start - back : start + STEP]
            ends: list[list[tuple[int, float]]] = [[] for _ in part]
            for last, found in automaton.iter(part):
                ends[last].append(found)
            best, used = best[-longest:], used[-longest:]
            for place in range(back, len(part)):
                # Longest first: among equal scores the tokenizer keeps the piece that begins first.
                found = ends[place]
                found.sort(reverse=True)
                score, pieces_used, single = None, 0, False
                for length, own in found:
                    total = own + best[-length]
                    if score is None or total > score:
                        score, pieces_used = total, used[-length] + 1
                    single = single or length == 1
                if not single:
                    total = unknown + best[-1]
                    if score is None or total > score:
                        raw = part[place].encode("utf-8", "surrogatepass")
                        score, pieces_used = total, used[-1] + len(raw)
                best.append(score)
                used.append(pieces_used)
        return used[-1]

    return count


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text, many at a time, without their leading mark."""
    if text.startswith((" ", SPACE)):
        text = text[1:]
    at = 0
    while at <= len(text):
        end = at + SLICE
        if end < len(text):
            end = text.find(" ", end)
            end = len(text) if end < 0 else end
        yield re.split(f"[ {SPACE}]", text[at:end])
        at = end + 1


def text_counter(pieces: Vocabulary) -> Callable[[str], int]:
    count = counter(pieces)
    seen: dict[str, int] = {}
    held = 0

    def total(text: str) -> int:
        nonlocal held
        if not text:
            return 0
        found = 0
        for words in words_of(text):
            for word, times in Counter(words).items():
                n = seen.get(word)
                if n is None:
                    n = count(SPACE + word)
                    if len(seen) >= REMEMBERED or held + len(word) > REMEMBERED_CHARS:
                        seen.clear()
                        held = 0
                    if len(word) <= REMEMBERED_CHARS:
                        seen[word] = n
                        held += len(word)
                found += n * times
        return found

    return total


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, n_tokens."""

    def run(batches: Batches) -> Iterator[Columns]:
        total = text_counter(vocabulary(path))
        for batch in batches:
            yield {
                "doc_id": batch.column("doc_id"),
                "n_chars": batch.column("n_chars"),
                "n_tokens": [None if t is None else total(t) for t in batch.column("text").to_pylist()],
            }

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.char_length("text").cast("long").alias("n_chars"), "text"
    )
    return by_batch(rows, run, "doc_id long, n_chars long, n_tokens long")
