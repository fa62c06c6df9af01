"""Pfair mixing against a slot-by-slot simulation."""

import random
from collections import Counter
from fractions import Fraction
from math import ceil, floor

import pytest
from llm_cases import awkward, documents

from bazaarlens.llm import mixing


@pytest.mark.parametrize("seed", range(40))
def test_no_source_is_a_whole_block_off(seed):
    draw = random.Random(seed)
    weights = {f"s{n}": draw.random() ** 3 + 1e-4 for n in range(draw.randrange(1, 13))}
    slots = mixing.shares(weights, draw.choice([7, 30, 100]))
    order = mixing.schedule(slots)
    assert Counter(order) == slots and mixing.deviation(order, slots) < 1


def simulated(counts, weights, block, period):
    """The mix worked out slot by slot over all of its length."""
    left = {k: -(-n // block) for k, n in counts.items()}
    done, out = dict.fromkeys(left, 0), []
    while left:
        slots = mixing.shares({k: weights[k] for k in left}, period)
        total, start, n = sum(slots.values()), dict(done), 0
        while all(left.values()):
            ready = [
                mixing.urgency(k, s, total, done[k] - start[k])
                for k, s in slots.items()
                if (done[k] - start[k]) * total // s <= n
            ]
            name = min(ready)[-1]
            out.append((name, done[name]))
            done[name] += 1
            left[name] -= 1
            n += 1
        left = {k: n for k, n in left.items() if n}
    return out


def test_every_row_has_the_place_that_the_simulation_gives(spark):
    draw = random.Random(2)
    rows = [(n, f"t{n}", "en", draw.choice(["a"] * 8 + ["b", "b", "c", None])) for n in range(700)]
    docs = awkward(documents(spark, rows + [(None, None, None, "b"), (3, "t3", "en", "a")]))
    targets = {"a": 0.5, "b": 0.3}
    found = mixing.mixed(docs, targets, block=4, period=20).collect()
    assert len(found) == 702
    counts = Counter(r.source for r in found)
    want = simulated(counts, mixing.target_weights(counts, targets), 4, 20)
    slots = {(r.source, r.block): r.slot for r in found}
    assert [k for k, _ in sorted(slots.items(), key=lambda x: x[1])] == want
    assert sorted(slots.values()) == list(range(len(want)))
    assert len({r.position for r in found}) == 702
    assert all(c <= 4 for c in Counter((r.source, r.block) for r in found).values())


def test_rows_keep_their_columns_and_stand_in_the_order_of_the_mix(spark):
    rows = [(n, f"t{n}", "en", "ab"[n % 3 == 0]) for n in range(200)]
    docs = awkward(documents(spark, rows))
    out = mixing.in_mixed_order(docs)
    places = {r.doc_id: r.position for r in mixing.mixed(docs).collect()}
    found = [places[r.doc_id] for r in out.collect()]
    assert out.columns == docs.columns and found == sorted(found) and len(found) == 200


def test_empty_table_and_one_source(spark):
    assert mixing.mixed(documents(spark, [])).count() == 0
    assert mixing.in_mixed_order(documents(spark, [])).count() == 0
    one = mixing.mixed(documents(spark, [(n, "t") for n in range(50)])).collect()
    assert sorted(r.position for r in one) == list(range(50))


@pytest.mark.parametrize(
    "targets, length",
    [
        ({"a": 0.9, "b": 0.1}, 2000),
        ({"a": 0.999, "b": 0.001}, 3000),
        ({"hot": 10_000**0.5} | {f"s{n}": 1_000**0.5 for n in range(19)}, 3000),
        ({f"s{n}": (n + 1) ** 0.5 for n in range(1000)}, 5000),
    ],
)
def test_no_source_is_a_whole_block_off_its_target(targets, length):
    order = mixing.phases(targets, dict.fromkeys(targets, length))[0][:length]
    whole = mixing.exact(targets)
    total, done = sum(whole.values()), dict.fromkeys(targets, 0)
    assert all(abs(w / total - targets[k] / sum(targets.values())) < 1e-12 for k, w in whole.items())
    for n, name in enumerate(order, 1):
        done[name] += 1
        assert all(abs(n * w - done[k] * total) < total for k, w in whole.items())


def test_rows_follow_the_targets_to_the_block(spark):
    rows = [(n, f"t{n}", "en", "ab"[n % 2]) for n in range(12_000)]
    targets = {"a": 0.9, "b": 0.1}
    found = mixing.mixed(documents(spark, rows), targets, block=4).where("phase = 0").collect()
    slots = {r.slot: r.source for r in found}
    order = [slots[n] for n in range(len(slots))]
    assert len(order) > 1600 and mixing.deviation(order, mixing.exact(targets)) < 1


def test_more_sources_than_slots_of_a_period(spark):
    rows = [(n, "t", "en", f"s{n % 1000 if n % 3 else 0}") for n in range(9000)]
    found = mixing.mixed(documents(spark, rows), block=2).collect()
    assert len(found) == len({r.position for r in found}) == 9000
    blocks = {(r.source, r.block): r.slot for r in found}
    assert sorted(blocks.values()) == list(range(len(blocks)))


def by_exact_windows(counts, weights, block):
    """The mix worked out slot by slot, from the windows of Pfair blocks in fractions."""
    left = {k: -(-n // block) for k, n in counts.items()}
    done, out = dict.fromkeys(left, 0), []
    for of_zero in (False, True):
        now = {k for k in left if (weights[k] == 0) == of_zero}
        while now:
            own = {k: Fraction(1) if of_zero else Fraction(str(weights[k])) for k in now}
            share = {k: w / sum(own.values()) for k, w in own.items()}
            first, n = dict(done), 0
            while all(left[k] for k in now):
                ready = []
                for k, w in share.items():
                    j = done[k] - first[k]
                    overlaps = (j + 1) / w != ceil((j + 1) / w)
                    if floor(j / w) <= n:
                        ready.append((ceil((j + 1) / w) - 1, not overlaps, not (overlaps and 2 * w >= 1), k))
                name = min(ready)[-1]
                out.append((name, done[name]))
                done[name] += 1
                left[name] -= 1
                n += 1
            now = {k for k in now if left[k]}
    return out


@pytest.mark.parametrize(
    "targets",
    [None, {"a": 0.5, "b": 0.3}, {"a": 0.9, "b": 0.0}, {"a": 0.0, "b": 0.0, "c": 0, "": 0}, {"a": 0.7, "b": 0.3, "gone": 5}],
)
def test_default_path_equals_the_simulation_by_exact_windows(spark, targets):
    draw = random.Random(5)
    rows = [(n, f"t{n}", "en", draw.choice(["a"] * 8 + ["b", "b", "c", None])) for n in range(900)]
    docs = awkward(documents(spark, rows))
    found = mixing.mixed(docs, targets, block=4).collect()
    counts = Counter(r.source for r in found)
    slots = {(r.source, r.block): r.slot for r in found}
    order = [k for k, _ in sorted(slots.items(), key=lambda x: x[1])]
    assert order == by_exact_windows(counts, mixing.target_weights(counts, targets), 4)


def test_targets_of_zero_come_last_and_bad_ones_are_refused(spark):
    counts = {"a": 10, "b": 10, "c": 10}
    weights = mixing.target_weights(counts, {"a": 0.9, "b": 0.0})
    assert weights == {"a": Fraction(9, 10), "b": 0, "c": Fraction(1, 10)}
    order = [name for part in mixing.phases(weights, counts) for name in part]
    assert order[-10:] == ["b"] * 10 and Counter(order) == counts
    for bad in (-0.1, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            mixing.target_weights(counts, {"a": bad})
