"""Tokens against the tokenizers library, and packings against bounds and brute force."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward, documents
from tokenizers import Tokenizer

from bazaarlens.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", None, "a", "Hello, world! It's 12:30  \n\n x", "<|endoftext|>", "a<|endoftext|> b", "é漢😀 \t ü",
    "word " * 1500, "x" * 5000, " " * 40, "don't we'll I'd THEY'RE", "\x00\x01 zero",
]


def library_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_library(text):
    assert packing.encoder(PATH)(text).tolist() == library_ids(text)[:-1]


LONG = {
    "blanks": " " * 2_000_000 + "a", "blanks at the end": "a" + " " * 2_000_000, "newlines": "b\n" + "\n" * 2_000_000 + " é",
    "letters": "a" * 2_000_000, "signs": "." * 2_000_000, "tabs and marks": "<|endoftext|>" + "\t" * 300_000 + "<|endoftext|>x",
    "two runs": "x" + "\u3000" * 60_000 + "y" + " " * 60_000 + "\x1c" + " " * 60_000, "only blanks": " " * 70_000,
}


@pytest.mark.parametrize("name", LONG)
def test_ids_of_very_long_runs(name):
    assert packing.encoder(PATH)(LONG[name]).tolist() == library_ids(LONG[name])[:-1]


def test_long_runs_are_packed(spark):
    texts = [t for name, t in LONG.items() if "a" in name]
    found = packing.packed_documents(documents(spark, list(enumerate(texts))), PATH).collect()
    check_packing(found, packing.LENGTH)
    for n, text in enumerate(texts):
        pieces = sorted((r.start, r.length) for r in found if r.doc_id == n)
        assert sum(length for _, length in pieces) == len(library_ids(text))


def check_packing(rows, length):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(sequences)


def test_pieces_and_places(spark):
    texts = TEXTS + TEXTS[:4]
    rows = [(n if n < 12 else None if n == 12 else 3, t) for n, t in enumerate(texts)]
    found = packing.packed_documents(awkward(documents(spark, rows)), PATH, 64).collect()
    want = []
    for doc_id, text in rows:
        ids = np.array(library_ids(text), "<u4")
        cuts = packing.cut(len(ids), 64)
        assert all(b - a == 64 for a, b in zip(cuts[1:], cuts[2:]))
        want += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    n = check_packing(found, 64)
    assert packing.lower_bound(np.array([r.length for r in found]), 64) <= n


def test_partitions_exchange_until_little_is_open(spark):
    draw = np.random.default_rng(1)
    sizes = np.minimum(99, draw.lognormal(3, 0.8, 4000).astype(int) + 1)
    pieces = spark.createDataFrame([(n, 0, 0, int(s), n) for n, s in enumerate(sizes)], packing.PIECES)
    rows = packing.pack(pieces, 100, partition=300).collect()
    assert len(rows) == 4000 and len({r.doc_id for r in rows}) == 4000
    n, bound = check_packing(rows, 100), packing.lower_bound(sizes, 100)
    apart = sum(packing.best_fit(part, 100)[0].max() + 1 for part in np.array_split(sizes, 14))
    assert bound <= n < apart and n <= bound * 1.01


def test_sequences_follow_the_places_of_their_pieces(spark):
    draw = np.random.default_rng(2)
    sizes = np.minimum(100, draw.lognormal(3, 0.8, 3000).astype(int) + 1)
    places = draw.permutation(3000)
    rows = [(n, 0, 0, int(s), n, int(p) if p > 500 else 0) for n, (s, p) in enumerate(zip(sizes, places, strict=True))]
    pieces = spark.createDataFrame(rows, packing.PIECES + ", position long")
    found = packing.pack(pieces, 100, partition=300).collect()
    assert len({r.doc_id for r in found}) == len(found) == 3000
    n = check_packing(found, 100)
    firsts = {}
    for r in found:
        firsts[r.sequence_id] = min(firsts.get(r.sequence_id, 3000), r.position)
    assert sorted(firsts) == list(range(n)) and [firsts[k] for k in range(n)] == sorted(firsts.values())
    spread = {}
    for r in found:
        spread.setdefault(r.sequence_id, []).append(r.position)
    assert np.median([max(p) - min(p) for p in spread.values()]) <= 600
    assert packing.lower_bound(sizes, 100) <= n <= packing.lower_bound(sizes, 100) * 1.01


def fewest(sizes, length):
    for n in itertools.count(1):
        for way in itertools.product(range(n), repeat=len(sizes)):
            if max(np.bincount(way, weights=sizes, minlength=n)) <= length:
                return n


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=6))
def test_bounds_never_exceed_the_fewest_sequences(sizes):
    best = fewest(sizes, 20)
    bins, _ = packing.best_fit(np.array(sizes), 20)
    assert packing.lower_bound(np.array(sizes), 20) <= best <= bins.max() + 1


def test_bounds_see_more_than_the_sum():
    assert packing.lower_bound(np.array([11] * 9), 20) == 9
    assert packing.lower_bound(np.array([7] * 9), 20) == 5


def test_empty_table(spark):
    assert packing.packed_documents(documents(spark, []), PATH).count() == 0


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2048, 5000])
def test_cuts(n):
    at = packing.cut(n)
    assert at[0] == 0 and at[-1] == n and all(0 < b - a <= 1024 for a, b in zip(at, at[1:]))


def test_equal_rows_are_dealt_to_all_partitions(spark):
    """A third of the pieces agree in everything, doc_id too."""
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, NULL, id) AS doc_id", "0 AS piece", "0L AS start", "if(id % 3 = 0, 7L, id % 900 + 1) AS length", "5L AS ids_crc32"
    )
    sizes = [r["count"] for r in packing.by_row(rows, 12, 3).groupBy("task").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 1.1 * 60_000 / 12


def test_exchanges_go_on_until_nothing_is_gained(spark):
    """Partitions of a few hundred pieces, in more rounds than one: near the packing of all at once."""
    draw = np.random.default_rng(8)
    lengths = draw.integers(300, 724, 3000)
    rows = [(i, 0, 0, int(n), i) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, packing.PIECES).repartition(4)
    found = packing.pack(pieces, partition=400).collect()
    assert sorted(r.doc_id for r in found) == list(range(3000))
    n = check_packing(found, packing.LENGTH)
    alone = len(set(packing.best_fit(lengths)[0].tolist()))
    assert packing.lower_bound(lengths) <= n <= alone * 1.03
