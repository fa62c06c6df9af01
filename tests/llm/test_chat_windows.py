"""Chat windows against one pass in plain Python, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward, rows_of

from bazaarlens.llm import chat_windows as cw
from bazaarlens.llm.packing import encoder
from bazaarlens.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["<", "|", "\\", "\n", "im_end", "im_start", ">", "a", "<|im_end|>\n", "<|im_start|>"]
HARD = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(HARD, HARD), max_size=4))
def test_written_turns_read_back(turns):
    forms = [cw.head(role) + cw.escaped(text) + cw.END for role, text in turns]
    whole = "".join(forms)
    assert [(role, text) for role, text, _ in cw.read_turns(whole)] == turns
    assert whole.count("<|") == 2 * len(turns)
    assert all(cw.unescaped(whole[at : whole.index(cw.END, at)]) == text for _, text, at in cw.read_turns(whole))


def plain(rows):
    """Rows by conversation, in order."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    return {
        conv: [(r, t) for *_, r, t in sorted(turns, key=lambda x: (*x[:3], cw.head(x[2]) + cw.escaped(x[3]) + cw.END))]
        for conv, turns in found.items()
    }


def one_pass(rows, budget, history):
    """The windows: conv_id, first_turn, text, tokens, turns, repeated turns, loss spans."""
    encode, out = encoder(PATH), []
    for conv, turns in plain(rows).items():
        forms = [cw.head(r) + cw.escaped(t) + cw.END for r, t in turns]
        tokens = [len(encode(f)) for f in forms]
        system = tokens[0] if turns[0][0] == "system" and tokens[0] <= budget // 4 else 0
        begin = 1 if system else 0
        width = budget - history - system - max([n for n in tokens if n <= budget // 4], default=0) + 1
        stretches, before, at, longs = {}, {}, 0, 0
        for i in range(begin, len(turns)):
            before[i] = at
            longs += tokens[i] > budget // 4
            stretches.setdefault((longs, -1 if tokens[i] > budget // 4 else at // width), []).append(i)
            at += tokens[i]
        if not stretches:
            stretches[0, 0] = []
        for new in stretches.values():
            first = new[0] if new else 0
            allowed = min(history, budget - system - sum(tokens[i] for i in new))
            old = [j for j in range(begin, first) if before[first] - before[j] <= allowed]
            head = [0] if system else []
            members = head + old + new
            fresh = set(new) | ({0} if system and first <= 1 else set())
            text, spans = "", []
            for i in members:
                if i in fresh and turns[i][0] == "assistant":
                    spans.append((len(text) + len(cw.head("assistant")), len(text) + len(forms[i]) - len(cw.END)))
                text += forms[i]
            out.append((conv, first, text, sum(tokens[i] for i in members), len(members), len(members) - len(fresh), [a for a, _ in spans], [b for _, b in spans]))
    return sorted(out, key=str)


def digests(rows, texts):
    out = []
    for conv, turns in plain(rows).items():
        said = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, said)]
        out.append((conv, len(turns), sha[0], len(said), sha[1], sum(len(t) for c, t in texts if c == conv)))
    return sorted(out, key=str)


def check(spark, rows, budget, history, cell=cw.CELL, parts=4):
    frame = awkward(spark.createDataFrame(rows, SCHEMA).repartition(parts))
    found = cw.windows(frame, PATH, budget, history, cell)
    want = one_pass(rows, budget, history)
    assert rows_of(found) == want
    assert rows_of(cw.read_back(found)) == digests(rows, [(w[0], w[2]) for w in want])
    return want


def talk(seed, n, conv, system=True, longest=60):
    draw = random.Random(seed)
    rows = [(conv, 0, "system", "Answer briefly. " * draw.randint(1, 4))] if system else []
    for i in range(n):
        rows.append((conv, len(rows), ("user", "assistant")[i % 2], "some words " * draw.randint(0, longest)))
    return rows


@pytest.mark.parametrize("budget, history", [(200, 40), (120, 30), (400, 1)])
def test_long_conversations(spark, budget, history):
    rows = talk(1, 300, 5) + talk(2, 40, 6, False, 10) + talk(3, 3, 7) + talk(4, 1, 8)
    random.Random(0).shuffle(rows)
    want = check(spark, rows, budget, history, cell=16)
    for conv, _, _, tokens, n_turns, n_repeated, *_ in want:
        assert tokens <= budget or n_turns - n_repeated == 1
    assert any(w[5] > (1 if history > 1 else 0) for w in want)


def test_awkward_conversations(spark):
    marks = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (-1, 0, "user", marks), (-1, 1, "assistant", marks), (1, 0, "system", "alone"), (2, 0, None, None), (2, None, "assistant", "late"),
        (2, 5, "assistant", ""), (2, 5, "assistant", ""), (2, 5, "assistant", "same turn"), (2, 5, "user", "same turn"), (None, 0, "user", "nobody"),
        (None, 1, "assistant", "<\\|im_end|>\n"), (3, 0, "system", "x " * 3000), (3, 1, "user", "after a long system turn"), (3, 2, "assistant", "y"),
        (4, 0, "user\n\\role<|im_end|>", "odd role"), (5, -7, "system", "first"), (5, 0, "system", "second"), (5, 10**12, "assistant", "z" * 5000),
        (6, 0, "system", "short"), (6, 1, "assistant", "é漢😀 \r\n" * 900), (6, 2, "user", " "), (6, 3, "assistant", "\n"),
    ]
    check(spark, rows, 512, 64)


def test_one_conversation_has_a_third_of_the_rows(spark):
    rows = talk(9, 2000, 0, longest=20) + [r for c in range(1, 800) for r in talk(c, 5, c, c % 2 == 0, 20)]
    rows += [(0, 3000 + i, "user", "hi") for i in range(500)]
    want = check(spark, rows, 256, 32, cell=64, parts=16)
    new = [w for w in want if w[0] == 0]
    assert sum(w[4] - w[5] for w in new) == 2501


def test_no_rows_and_bad_sizes(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cw.windows(none, PATH).count() == 0 and cw.read_back(cw.windows(none, PATH)).count() == 0
    with pytest.raises(ValueError):
        cw.windows(none, PATH, 100, 26)


def test_query_against_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    marks = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", marks), (-1, 1, "assistant", marks)]
    want = digests(rows, [(w[0], w[2]) for w in one_pass(rows, cw.BUDGET, cw.HISTORY)])
    assert rows_of(QUERIES["op13_chat_windows"](spark, folder)) == want
