"""Best-fit packing of tokenised documents, certified by dual feasible functions.

* A document is its token ids and one end id. Longer documents than a sequence are cut
  into pieces of full length; the first piece may be shorter. Full pieces are sequences of
  their own.
* The other pieces are dealt to partitions of bounded size. Each partition packs its pieces by
  best-fit decreasing, and dual feasible functions give a lower bound for its number of
  sequences. A partition that reaches the bound is certified.
* Partitions with gaps exchange documents: an uncertified partition gives up the
  pieces of all its open sequences, a certified one those of its emptiest open sequence. The
  pooled pieces are dealt anew and packed again, in fewer partitions each time, and the
  new packing holds if it needs fewer sequences. This ends when the pool was one
  partition, or when two fresh deals in a row gained nothing.
* Pieces may have places in a mix. Then partitions are ranges of places instead of hashes, pieces
  of one length are packed in order of their places, and sequences are numbered from 0 by the
  place of their first piece. So a sequence holds pieces of one stretch of the mix, as long as a
  partition, or of neighbouring stretches if they exchange.

Defined cases: a null text counts as empty, and an empty document is its end id alone.
Rows that repeat a doc_id, or agree altogether, are pieces of their own. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.frames import CELLS, Batches, Columns, by_batch, by_group, numbered
from bazaarlens.sources.storage import materialize

LENGTH = 1024
END_ID = 2
#: Pieces that a partition packs at once.
PARTITION = 50_000
PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, fill long, n_bins long, bound long, emptiest boolean"
#: Fixed value: the published pattern of this vocabulary's pre-tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Runs of white space from this length on do not go through the pattern.
SAFE_WHITE = 50_000
#: Fixed value: the characters that the pattern's ``\\s`` stands for.
LONG_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % SAFE_WHITE)


def _letters_of_bytes() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


@cache
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Token ids by the byte-level vocabulary file of the ``tokenizers`` library.

    The ids are those of that library, added tokens in a text included; tiktoken's
    merges give the same and take a quarter of the time.
    """
    model = json.loads(Path(path).read_text(encoding="utf-8"))
    added = {t["content"]: t["id"] for t in model["added_tokens"]}
    byte = _letters_of_bytes()
    ranks = {
        bytes(byte[c] for c in token): n for token, n in model["model"]["vocab"].items() if token not in added
    }
    coder = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def part(text: str) -> list[int]:
        if any(mark in text for mark in added):
            return coder.encode(text, allowed_special="all")
        return coder.encode_ordinary(text)

    def encode(text: str) -> np.ndarray:
        # The pattern steps back through a run of white space, and its stack ends in a very long one.
        # By the pattern, such a run is one piece but for its last character, which begins the next.
        ids, done = [], 0
        for run in LONG_WHITE.finditer(text) if len(text) >= SAFE_WHITE else ():
            stop = run.end() if run.end() == len(text) else run.end() - 1
            ids.append(part(text[done : run.start()]))
            ids.append(coder._encode_single_piece(text[run.start() : stop]))
            done = stop
        ids.append(part(text[done:]))
        return np.concatenate([np.array(i, np.uint32) for i in ids])

    return encode


def cut(n: int, length: int = LENGTH) -> list[int]:
    """Where the pieces of n tokens begin, and n."""
    first = n % length or min(n, length)
    return [0, *range(first, n + 1, length)]


def tokenized(docs: DataFrame, path: str, length: int = LENGTH, position: str | None = None) -> DataFrame:
    """The columns of PIECES, and ``position`` if a column of ``docs`` is named for it."""
    names = [*PIECE_NAMES, "position"] if position else PIECE_NAMES

    def run(batches: Batches) -> Iterator[Columns]:
        encode = encoder(path)
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            rows = []
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            places = [(p,) for p in batch.column("position").to_pylist()] if position else [()] * len(texts)
            for doc_id, text, place in zip(doc_ids, texts, places, strict=True):
                ids = np.concatenate((encode(text), end)) if text else end
                at = cut(len(ids), length)
                raw = memoryview(ids.astype("<u4").tobytes())
                for k, (a, b) in enumerate(zip(at, at[1:])):
                    rows.append((doc_id, k, a, b - a, zlib.crc32(raw[4 * a : 4 * b]), *place))
            yield dict(zip(names, zip(*rows, strict=True), strict=True))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_place(position))
    return by_batch(rows, run, PIECES + ", position long" if position else PIECES)


def _place(position: str | None) -> list[Column]:
    return [F.col(f"`{position}`").cast("long").alias("position")] if position else []


def lower_bound(lengths: np.ndarray, length: int = LENGTH) -> int:
    """A number of sequences that no packing goes below.

    The largest total under three families of dual feasible functions: the share of
    the sequence; pieces over 1 - e counted whole and pieces under e not at all; and
    shares rounded to k parts.
    """
    counts = np.bincount(lengths, minlength=length + 1).astype(np.int64)
    size = np.arange(length + 1)
    best = -(-int((counts * size).sum()) // length)
    below, above = np.cumsum(counts * size), np.cumsum(counts[::-1])[::-1]
    for e in range(1, length // 2 + 1):
        whole = int(above[length - e + 1])
        middle = int(below[length - e] - below[e - 1])
        best = max(best, whole + -(-middle // length))
    for k in range(1, 33):
        exact = (k + 1) * size % length == 0
        # In units of 1 / (k * length), so that the total is exact.
        units = np.where(exact, k * size, (k + 1) * size // length * length)
        best = max(best, -(-int((counts * units).sum()) // (k * length)))
    return best


def best_fit(lengths: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, by best-fit decreasing."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(length + 1)]
    has_room, opened = 0, 0  # bit r: some bin has exactly r tokens left
    for item, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = has_room >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            chosen = room[left].pop()
            if not room[left]:
                has_room &= ~(1 << left)
        else:
            left, chosen, opened = length, opened, opened + 1
        bins[item], offsets[item] = chosen, length - left
        left -= size
        if left:
            room[left].append(chosen)
            has_room |= 1 << left
    return bins, offsets


def in_order(frame: DataFrame, name: str) -> DataFrame:
    """Number all rows from 0 by ``position`` and then the other columns, none of them in one task."""
    top = frame.agg(F.max("position")).first()[0] or 0
    cell = F.floor(F.col("position") * CELLS / (top + 1)).cast("long")
    first = frame.select("position", *[c for c in frame.columns if c != "position"])
    return numbered(first.withColumn("_all", F.lit(0)), "_all", cell, name).drop("_all")


def by_row(pieces: DataFrame, partitions: int, turn: int) -> DataFrame:
    """The pieces with the ``task`` that packs them, equal ones dealt to all: each row counts by its place in the stored table."""
    row = F.monotonically_increasing_id()
    return pieces.withColumn("task", F.pmod(F.xxhash64(*pieces.columns, row, F.lit(turn)), F.lit(partitions)))


def pack_once(pieces: DataFrame, partitions: int, turn: int, length: int = LENGTH) -> DataFrame:
    """Deal the pieces to partitions and pack each: the columns of PACKED, and ``position`` if there is one."""
    names = pieces.columns
    places = [n for n in names if n == "position"]

    def each(rows: pa.RecordBatch) -> Columns:
        task = rows.column("task")[0].as_py()
        order = ("length", *places, "doc_id", "piece", "ids_crc32")
        rows = rows.select(names).sort_by([(n, "ascending") for n in order])
        lengths = rows.column("length").to_numpy()
        bound = lower_bound(lengths, length)
        bins, offsets = best_fit(lengths, length)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        # Odd, so that full pieces can have the even numbers. Every round gains, so 2**12 are far more than there are.
        numbers = ((bins << 24 | task) << 12 | turn) * 2 + 1
        return {name: rows.column(name).to_pylist() for name in names} | {
            "sequence_id": numbers.tolist(),
            "offset": offsets.tolist(),
            "fill": fill[bins].tolist(),
            "n_bins": [len(fill)] * len(bins),
            "bound": [bound] * len(bins),
            "emptiest": (bins == fill.argmin()).tolist(),
        }

    if places:
        rows = max(1, pieces.count())
        dealt = in_order(pieces, "_rank")
        dealt = dealt.withColumn("task", F.floor(F.col("_rank") * partitions / rows).cast("long")).drop("_rank")
    else:
        dealt = by_row(pieces, partitions, turn)
    return by_group(dealt, "task", each, PACKED + ", position long" if places else PACKED)


def pack(pieces: DataFrame, length: int = LENGTH, partition: int = PARTITION) -> DataFrame:
    """Pieces (the columns of PIECES) with ``sequence_id`` and ``offset``.

    If they have a ``position`` too, partitions and the numbers of sequences follow it.
    """
    full = pieces.where(F.col("length") == length).withColumn(
        "sequence_id", F.monotonically_increasing_id() * 2
    ).withColumn("offset", F.lit(0).cast("long"))
    pool = pieces.where(F.col("length") < length)
    columns, done, before = pieces.columns, [], None
    turn = idle = 0
    while True:
        partitions = max(1, -(-pool.count() // partition))
        packed = materialize(pack_once(pool.select(*columns), partitions, turn, length), "packing-round")
        turn += 1
        if before is not None:
            old, new = (p.agg(F.count_distinct("sequence_id")).first()[0] for p in (before, packed))
            idle = idle + 1 if new >= old else 0
            if idle == 2:
                done.append(before)
                break
            if idle:
                continue
        open_now = (F.col("fill") < length) & ((F.col("n_bins") > F.col("bound")) | F.col("emptiest"))
        done.append(packed.where(~open_now))
        before = pool = packed.where(open_now)
        if partitions == 1:
            done.append(before)
            break
    out = full
    for part in done:
        out = out.union(part.select(*columns, "sequence_id", "offset"))
    return renumbered(out) if "position" in columns else out


def renumbered(packed: DataFrame) -> DataFrame:
    """The packing with its sequences numbered by the places of their first pieces."""
    packed = materialize(packed, "packing-sequences")
    first = packed.groupBy("sequence_id").agg(F.min(F.struct("position", "piece")).alias("_first"))
    firsts = materialize(first.select("_first.*", "sequence_id"), "packing-firsts")
    numbers = in_order(firsts, "_number").select("sequence_id", "_number")
    names = [F.col("_number").alias(c) if c == "sequence_id" else F.col(c) for c in packed.columns]
    return packed.join(numbers, "sequence_id").select(*names)


def packed_documents(docs: DataFrame, path: str, length: int = LENGTH, position: str | None = None) -> DataFrame:
    """Per piece of ``docs`` (doc_id, text): the columns of PIECES, sequence_id, offset.

    ``position`` names a column without nulls, the places of documents from 0 that the packing follows.
    """
    packed = pack(materialize(tokenized(docs, path, length, position), "packing-pieces"), length)
    return packed.drop("position")
