"""Near-dedup against all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest
from llm_cases import awkward, documents, rows_of

from bazaarlens.llm import chosen_path, words
from bazaarlens.llm.components import components


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text):
    found = words_of(text)
    if 0 < len(found) < 5:
        return {tuple(found)}
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def expected(rows, percent=80):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    return sorted(
        ((d, len(sets[i]), ids.get(find(i)), d == ids.get(find(i))) for i, (d, _) in enumerate(rows)), key=str
    )


def text_of(draw, n):
    return " ".join("".join(draw.choices("abcdefgh", k=4)) for _ in range(n))


def edited(draw, text, changes):
    found = text.split()
    for at in draw.sample(range(len(found)), changes):
        found[at] = "new" + str(draw.randrange(10**6))
    return " ".join(found)


@pytest.fixture(scope="module")
def rows():
    """Copies, chains of small edits, pairs on both sides of the threshold, and a shared passage."""
    draw, out = random.Random(5), []
    passage = text_of(draw, 30)
    for _ in range(40):
        base = text_of(draw, draw.randrange(120, 200))
        out += [base, base.upper().replace(" ", " \n")]
        chain = base
        for _ in range(3):
            chain = edited(draw, chain, draw.randrange(1, 4))
            out.append(chain)
    out += [passage + " " + text_of(draw, draw.randrange(1, 40)) for _ in range(150)]
    out += ["same words here"] * 30 + ["Same words\there", "two words", None, "", " \t", "é é é é é é"]
    draw.shuffle(out)
    return list(enumerate(out)) + [(None, "lone text without an id"), (7, out[7])]


@pytest.mark.parametrize("percent", [80, 85])
def test_all_pairs(spark, rows, percent):
    docs = awkward(documents(spark, rows))
    assert rows_of(chosen_path.near_dedup(docs, percent)) == expected(rows, percent)


def test_small_leaves_and_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(chosen_path, "LEAF", 4)
    monkeypatch.setattr(chosen_path, "BLOCK", 8)
    monkeypatch.setattr(chosen_path, "BLOCK_SHINGLES", 600)
    assert rows_of(chosen_path.near_dedup(documents(spark, rows))) == expected(rows)


def test_one_row_of_each_group_stays(spark, rows):
    docs = awkward(documents(spark, rows))
    kept = chosen_path.keep_one(docs)
    assert kept.columns == docs.columns
    chosen = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    want = {c for _, n, c, _ in expected(rows) if n and c is not None}
    blank = {d for d, n, _, _ in expected(rows) if not n}
    assert chosen == sorted(want | blank)


def test_a_long_text_is_hashed_as_a_whole(monkeypatch):
    text = " ".join(f"w{n}" for n in range(3000)) + " " + "x" * 500
    whole = words.word_hashes(text.encode())
    monkeypatch.setattr(words, "SLICE", 97)
    assert (words.word_hashes(text.encode()) == whole).all() and len(whole) == 3001


def test_shingle_sets_have_the_sizes_of_plain_sets(rows):
    texts = [text for _, text in rows]
    assert [len(s) for s in words.shingle_sets(texts)] == [len(shingles(t)) for t in texts]


def test_least_hashes_agree_as_often_as_sets_overlap():
    draw = np.random.default_rng(1)
    agreed = []
    for _ in range(200):
        shared, own = draw.integers(0, 2**63, 170, dtype=np.uint64), draw.integers(0, 2**63, (2, 15), dtype=np.uint64)
        a, b = (chosen_path.least_hashes(np.unique(np.append(shared, part))) for part in own)
        agreed.append((a == b).mean())
    assert abs(np.mean(agreed) - 0.85) < 0.02


def test_links_inside_a_task_are_a_forest():
    side = np.full(50, chosen_path.WHOLE)
    links = list(chosen_path.similar(lambda i, others: np.ones(len(others), bool), side))
    assert len(links) == 49
    near = list(chosen_path.similar(lambda i, others: abs(others - i) <= 1, side))
    assert len(near) == 49
    sides = np.repeat([0, 1], [3, 4])
    across = list(chosen_path.similar(lambda i, others: np.ones(len(others), bool), sides))
    assert len(across) == 6 and all(i < 3 <= j for i, j in across)
    assert not list(chosen_path.similar(lambda i, others: np.ones(len(others), bool), np.ones(9, int)))


def test_edits_of_one_text_are_joined_through_their_hub(spark, monkeypatch):
    """What is left to compare block by block does not grow with the square of the family."""
    draw = random.Random(8)
    base = text_of(draw, 300)
    rows = [(0, base), *((n, edited(draw, base, draw.randrange(1, 5))) for n in range(1, 400))]
    rows += [(1000 + n, text_of(draw, 50)) for n in range(50)]
    monkeypatch.setattr(chosen_path, "BLOCK", 20)
    seen, crossed = [], chosen_path.crossed
    monkeypatch.setattr(chosen_path, "crossed", lambda m, linked: seen.append(crossed(m, linked).count()) or crossed(m, linked))
    assert rows_of(chosen_path.near_dedup(documents(spark, rows))) == expected(rows)
    assert len(seen) == 2 and seen[1] < 400 * 5


def test_components_of_chains_stars_and_rings(spark):
    draw, edges = random.Random(3), [(f"c{n}", f"c{n + 1}") for n in range(40)]
    edges += [("s0", f"s{n}") for n in range(1, 30)] + [("r1", "r2"), ("r2", "r3"), ("r3", "r1"), ("l", "l"), (None, "x")]
    draw.shuffle(edges)
    found = dict(rows_of(components(spark.createDataFrame(edges * 2, "a string, b string"))))
    assert {v for k, v in found.items() if k[0] == "c"} == {"c0"} and len([k for k in found if k[0] == "c"]) == 41
    assert {v for k, v in found.items() if k[0] == "s"} == {"s0"} and found["r3"] == "r1" and "l" not in found
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("operator", [chosen_path.near_dedup, chosen_path.keep_one])
def test_empty_table(spark, operator):
    assert operator(documents(spark, [])).count() == 0
