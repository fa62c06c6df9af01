"""The audit against removing documents one by one, and potentials against their definition."""

from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import COLUMNS, awkward, documents, rows_of

from bazaarlens.llm import filter_audit
from bazaarlens.llm.filter_audit import SQL, failed, potentials, steps, words_of

LABELS = "doc_id long, quality int, toxic int"


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 4).flatmap(lambda k: st.dictionaries(st.integers(0, 2**k - 1), st.integers(0, 50)).map(lambda c: (k, c))))
def test_potentials_give_the_shapley_value_of_all_orders(case):
    k, counts = case
    values = filter_audit.coalition_values(counts, k)
    found = potentials(values)
    everyone = 2**k - 1
    for f in range(k):
        by_orders = 0
        for order in permutations(range(k)):
            before = sum(1 << g for g in order[: order.index(f)])
            by_orders += values[before | 1 << f] - values[before]
        assert found[everyone] - found[everyone ^ 1 << f] == by_orders
    # The potential of a coalition is the mean over sizes that its dividends have.
    for size in range(k + 1):
        for members in combinations(range(k), size):
            s = sum(1 << i for i in members)
            dividends = {}
            for t in range(s + 1):
                if t & s == t:
                    dividends[t] = values[t] - sum(d for u, d in dividends.items() if u & t == u and u != t)
            want = sum((Fraction(d, t.bit_count()) for t, d in dividends.items() if t), Fraction(0))
            assert found[s] == factorial(k) * want


def test_words_of_long_texts_are_split_only_at_white_space(monkeypatch):
    monkeypatch.setattr(filter_audit, "SLICE", 7)
    text = "one two three\x1cfour  \t\r\n five five " * 9
    words = [w for w in text.replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    assert words_of(text.encode()) == (len(words), len(set(words)))
    assert words_of(b"") == words_of(b" \n\x0b\x0c") == (0, 0)
    assert words_of(b"x" * 100) == (1, 1)


def test_bits_of_a_text_at_its_limits():
    words = [f"w{i}" for i in range(200)]
    assert failed(" ".join(words).encode(), 0) & 1 == 0 and failed(" ".join(words[1:]).encode(), 0) & 1 == 1
    assert failed(b"a a", 3) & 2 == 0 and failed(b"a a a", 5) & 2 == 2
    assert failed("é".encode() * 97 + b"AAA", 100) & 4 == 0 and failed(b"e" * 96 + b"AAAA", 100) & 4 == 4
    assert failed("É".encode() * 3, 3) & 4 == 0
    assert all(failed(sign.encode(), 1) & 8 for sign in "#$%&*|") and not failed(b"!@^()", 5) & 8
    assert failed(b"", 0) == 1


def brute_force(rows, labels):
    """Every order tried on every document."""
    smallest = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc_id), doc_id)
    docs = []
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        bits = failed(text.encode("utf-8", "surrogatepass"), len(text))
        if doc_id is not None and smallest[text] < doc_id:
            bits |= 16
        said = [r for r in labels if r[0] is not None and r[0] == doc_id]
        docs.append((lang or "", bits, any(r[1] == 1 for r in said), any(r[2] == 1 for r in said)))
    out, total = [], {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                here = [d for d in left if d[1] >> f & 1]
                left = [d for d in left if not d[1] >> f & 1]
                total[part, f] = total.get((part, f), 0) + len(here)
                out.append((
                    part, "".join("ABCDE"[g] for g in order), step, len(left), len(here),
                    sum(d[1] >> f & 1 for d in own) - len(here), sum(d[1] == 1 << f for d in own),
                    sum(d[2] for d in here), sum(d[3] for d in here), f,
                ))
    return sorted([(*r[:-1], total[r[0], r[-1]]) for r in out], key=str)


LONG = " ".join(f"w{i}" for i in range(300))
CASES = [
    (1, LONG, "en"), (2, LONG, "de"), (3, LONG, None), (4, LONG + " #", "en"), (5, LONG + " #", "en"), (5, LONG + " #", "de"),
    (6, None, "en"), (7, "", ""), (8, "A B C", "en"), (None, LONG, "en"), (None, "nowhere else", None), (9, "nowhere else", "fr"),
    (10, "a " * 500, "en"), (10, "a " * 500, "en"), (11, "X" * 100_000 + " a" * 300, "de"), (12, "|" * 50, "en"), (2, LONG, "de"),
]
SAID = [(1, 1, 0), (2, 1, 1), (2, 0, 1), (4, None, 1), (5, 1, None), (10, 1, 0), (None, 1, 1), (99, 1, 1), (11, 0, 1)]


def test_awkward_rows_against_brute_force(spark):
    docs = awkward(documents(spark, [(*c, "src0") for c in CASES]))
    labels = spark.createDataFrame(SAID, LABELS)
    assert rows_of(filter_audit.filter_audit(docs, labels)) == brute_force(CASES, SAID)


def test_one_text_in_a_third_of_the_rows(spark):
    cases = [(i, "same" if i % 3 else f"own {i} " + LONG * (i % 2), ("en", "de", None)[i % 5 % 3]) for i in range(3000, 0, -1)]
    docs = documents(spark, [(*c, "src0") for c in cases], 16)
    labels = spark.createDataFrame([(i, i % 2, int(i % 7 == 0)) for i in range(0, 3000, 2)], LABELS)
    want = brute_force(cases, [(i, i % 2, int(i % 7 == 0)) for i in range(0, 3000, 2)])
    assert rows_of(filter_audit.filter_audit(docs, labels)) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], COLUMNS)
    no_labels = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(none, no_labels).count() == 0
    rows = filter_audit.filter_audit(documents(spark, [(1, None, None, None)]), no_labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and {r.shapley for r in rows if r.filter_order[r.step - 1] == "A"} == {120}


def test_steps_of_one_part_sum_up():
    for order, step, kept, removed, *_ in steps({"n": {0: 3, 5: 2, 31: 1}, "good": {}, "toxic": {}}, "ABCDE"):
        assert kept <= 6 - removed and (step < 5 or kept == 3), order


def test_sql_on_awkward_rows():
    """The SQL that checks the query, against the same brute force."""
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    connection.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", [list(c) for c in CASES])
    connection.executemany("INSERT INTO labels VALUES (?, ?, ?)", [list(c) for c in SAID])
    assert sorted(map(tuple, connection.execute(SQL).fetchall()), key=str) == brute_force(CASES, SAID)
