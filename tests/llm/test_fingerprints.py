"""Fingerprints against the generalised Jaccard similarity of word counts."""

import hashlib
import random
from collections import Counter

import pytest
from llm_cases import awkward, documents

from bazaarlens.llm import fingerprints


def words_of(text):
    return Counter((text or "").replace("\t", " ").replace("\n", " ").split(" ")) - Counter({"": 10**9})


def similarity(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / max(1, sum(max(a[k], b[k]) for k in keys))


def rows():
    draw = random.Random(9)
    vocabulary = ["the", "a", "of"] * 30 + [f"w{n}" for n in range(150)]
    out = [(7 * n, " ".join(draw.choices(vocabulary, k=draw.randrange(40, 300)))) for n in range(250)]
    return out + [(3, ""), (4, None), (5, "x"), (6, " \n\t "), (8, "ü"), (9, "long " * 30_000), (None, "no id at all")]


@pytest.fixture(scope="module")
def found(spark):
    return fingerprints.compared(awkward(documents(spark, rows()))).collect()


def in_order():
    return sorted(rows(), key=lambda r: (r[0] is None, -(r[0] or 0)))


def test_edits_are_made_with_the_next_document(found):
    by, order = {r.doc_id: r for r in found}, in_order()
    assert len(found) == len(order)
    for n, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert by[doc_id].n_chars == len(text)
        assert by[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), doc_id


def test_agreement_estimates_the_similarity(found):
    by, order = {r.doc_id: r for r in found}, in_order()
    near, far = [], []
    for n, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        near.append(by[doc_id].near_edited - similarity(words_of(text), words_of(edited)))
        far.append(by[doc_id].near_next - similarity(words_of(text), words_of(following)))
    near, far = near[:250], far[:250]
    assert abs(sum(near) / 250) < 0.02 and abs(sum(far) / 250) < 0.02
    assert max(map(abs, near)) < 0.3


def test_equal_texts_have_equal_fingerprints(spark, found):
    by = {r.doc_id: r for r in found}
    assert by[3].fingerprint == by[4].fingerprint == by[6].fingerprint != by[5].fingerprint
    again = fingerprints.compared(documents(spark, [(n, t) for n, (_, t) in enumerate(rows())])).collect()
    texts = {n: t for n, (_, t) in enumerate(rows())}
    first = {t: by[d].fingerprint for d, t in rows()}
    assert all(r.fingerprint == first[texts[r.doc_id]] for r in again)
    assert len({r.fingerprint for r in found}) == len({tuple(sorted(words_of(t).items())) for _, t in rows()})


def test_repeated_ids_and_lone_rows(spark):
    lone = fingerprints.compared(documents(spark, [(1, "a b c d")])).collect()
    assert (lone[0].near_next, lone[0].n_chars) == (1.0, 7)
    twice = fingerprints.compared(documents(spark, [(1, "a"), (1, "a"), (1, "bb cc"), (None, "z"), (None, "z")])).collect()
    assert len(twice) == 5
    assert fingerprints.compared(documents(spark, [])).count() == 0


def test_samples_of_a_term_follow_its_weight(spark):
    """A term of three times the weight is sampled three times as often."""
    texts = [(f"{n}", f"heavy{n} heavy{n} heavy{n} light{n}") for n in range(60)]
    alone = [(f"{n}h", f"heavy{n} heavy{n} heavy{n}") for n in range(60)]
    frame = spark.createDataFrame(texts + alone, "key string, text string")
    by = {r.key: r.fingerprint for r in fingerprints.fingerprints(frame, ["key"]).collect()}
    agreed = [
        sum(by[f"{n}"][i : i + 4] == by[f"{n}h"][i : i + 4] for i in range(0, 256, 4)) / 64 for n in range(60)
    ]
    assert abs(sum(agreed) / 60 - 0.75) < 0.03


def test_cells_stay_small_whatever_the_ids(spark):
    """Crowded ids, one far out, and a third without any; neighbours are found over all borders."""
    ids = [*range(4000), 10**15, -(10**15), *[7] * 1500, *[None] * 2500]
    docs = documents(spark, [(doc_id, f"text {n} " + "same words " * 5) for n, doc_id in enumerate(ids)])
    rows, _ = fingerprints.in_cells(docs)
    sizes = [r["count"] for r in rows.where("NOT ghost").groupBy("cell").count().collect()]
    assert sum(sizes) == len(ids) and len(sizes) > len(ids) / fingerprints.CELL / 2
    assert max(sizes) < 4 * fingerprints.CELL
    assert rows.where("ghost").count() == len(sizes)
    own = rows.where("NOT ghost").selectExpr("doc_id", "text", "hash").collect()
    own.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), -r.hash, r.text))
    want = []
    for n, row in enumerate(own):
        half, following = len(row.text) // 2, own[(n + 1) % len(own)].text
        edited = row.text[: len(row.text) - half] + following[:half]
        want.append((row.doc_id or -1, hashlib.sha256(edited.encode()).hexdigest()))
    found = [(-1 if r.doc_id is None else r.doc_id, r.edited_sha256) for r in fingerprints.compared(docs).collect()]
    assert sorted(found) == sorted((-1 if r.doc_id is None else r.doc_id, w[1]) for r, w in zip(own, want, strict=True))
