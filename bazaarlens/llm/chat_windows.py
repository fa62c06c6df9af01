"""Conversations as training windows of bounded length, each assistant text a target exactly once.

A turn is written as ``<|im_start|>role`` newline text ``<|im_end|>`` newline. A window is a stretch of
whole turns of one conversation: the system turn, a few repeated turns before the stretch, and the
stretch itself. Its loss mask covers the texts of assistant turns of the stretch; repeated turns are
masked out.

* Every turn is written and its tokens are counted where its row is. Prefix sums of tokens over a conversation are
  taken within cells of turn numbers and then over the cells, so a conversation of any length is never
  in one task.
* Stretches follow from prefix sums alone. With room for C tokens of new turns, and short turns of at most
  M tokens, short turns that begin in one span of C - M + 1 tokens belong together: they
  are at most C tokens. A turn of more than a quarter of the budget is a stretch of its own.
* A window repeats the turns whose beginnings lie within HISTORY tokens before its stretch; they
  are found by a join over spans of HISTORY tokens.
* A window is gathered in one task: at most the budget, or one turn that alone exceeds it.

Escaping: between ``<`` and ``|`` of a text one backslash is added to those that stand there, none included, so a text
never holds a mark, and taking one away again gives the text back. A role's backslashes and newlines
are written ``\\\\`` and ``\\n`` before that.

Defined cases: a null text or role counts as empty. Rows are ordered by turn, nulls last, then by role
and written form; repeated rows are turns of their own. Rows without conv_id are one conversation. The system turn
is the first turn if its role is ``system``; if it is longer than a quarter of the budget, it
is a plain turn and not repeated. A turn that does not fit beside the system turn is whole, in a window
that is longer than the budget. Other columns are ignored. An empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.frames import Batches, Columns, by_batch, by_group
from bazaarlens.llm.packing import encoder
from bazaarlens.sources.storage import materialize

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens of a window, and of the turns that it repeats.
BUDGET = 2048
HISTORY = 256
#: Turn numbers that a cell of prefix sums spans.
CELL = 256
#: What a window needs of a turn.
BODY = ("role", "form", "n_head", "n_chars", "n_tokens")
_TO_ESCAPE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")
_ROLE_SIGN = re.compile(r"\\([\\n])")


def escaped(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\1\\|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def head(role: str) -> str:
    """What stands before a turn's text."""
    return START + escaped(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"


def role_of(line: str) -> str:
    return _ROLE_SIGN.sub(lambda sign: "\n" if sign[1] == "n" else "\\", unescaped(line))


def read_turns(text: str) -> list[tuple[str, str, int]]:
    """The turns of a written window: role, text, and where the written text begins."""
    turns, at = [], 0
    for part in text.split(END)[:-1]:
        line, _, body = part.partition("\n")
        turns.append((role_of(line.removeprefix(START)), unescaped(body), at + len(line) + 1))
        at += len(part) + len(END)
    return turns


def written(rows: DataFrame, path: str) -> DataFrame:
    """Each turn as it is written: conv, turn, role, its form, and the tokens and characters of that."""

    def run(batches: Batches) -> Iterator[Columns]:
        encode = encoder(path)
        for batch in batches:
            conv, turn, role, text = (batch.column(n).to_pylist() for n in ("conv", "turn", "role", "text"))
            heads = [head(r) for r in role]
            forms = [h + escaped(t) + END for h, t in zip(heads, text, strict=True)]
            yield {
                "conv": conv, "turn": turn, "role": role, "form": forms, "n_head": [len(h) for h in heads],
                "n_chars": [len(f) for f in forms], "n_tokens": [len(encode(f)) for f in forms],
            }

    plain = rows.select(
        F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in ("role", "text")),
    )
    schema = "conv string, turn long, role string, form string, n_head long, n_chars long, n_tokens long"
    return by_batch(plain, run, schema)


def placed(turns: DataFrame, budget: int, history: int, cell: int) -> DataFrame:
    """The turns (the columns of :func:`written`) in order, each with its stretch.

    Adds ``turn_no``; ``before``, the tokens before it in the conversation, the system turn left out;
    ``is_system``; ``system``, the tokens of the conversation's system turn; and the stretch: ``longs``, the long
    turns up to here, and ``span``.
    """
    most_short = budget // 4
    order = [F.col("turn").asc_nulls_last(), "role", "form"]
    # Turns without a number come after all others.
    cells = F.when(F.col("turn").isNull(), F.lit(2**62)).otherwise(F.floor(F.col("turn") / cell))
    in_cell = Window.partitionBy("conv", "cell").orderBy(*order)
    own_no = F.row_number().over(in_cell).cast("long") - 1
    rows = materialize(turns.withColumn("cell", cells.cast("long")).withColumn("own_no", own_no), "chat-turns")
    short = F.col("n_tokens") <= most_short
    # Per cell, and then per conversation over its cells, which are far fewer than its turns.
    of_cell = rows.groupBy("conv", "cell").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("n_tokens").alias("tokens"),
        F.sum(F.when(~short, 1).otherwise(0)).alias("longs"),
        F.max(F.when((F.col("own_no") == 0) & (F.col("role") == "system") & short, F.col("n_tokens"))).alias("system"),
        F.max(F.when(short, F.col("n_tokens"))).alias("widest"),
    )
    over = Window.partitionBy("conv").orderBy("cell")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    conversation = Window.partitionBy("conv")
    known = (
        of_cell.withColumn("least", F.min("cell").over(conversation))
        .withColumn("system", F.when(F.col("cell") == F.col("least"), F.col("system")))
        .select(
            "conv", "cell",
            *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in ("n", "tokens", "longs")),
            *(F.coalesce(F.max(n).over(conversation), F.lit(0)).alias(n) for n in ("system", "widest")),
        )
    )
    so_far = Window.partitionBy("conv", "cell").orderBy("own_no")
    numbered = (
        rows.join(known, ["conv", "cell"])
        .withColumn("turn_no", F.col("n_before") + F.col("own_no"))
        .withColumn("before", F.col("tokens_before") + F.sum("n_tokens").over(so_far) - F.col("n_tokens") - F.col("system"))
        .withColumn("longs", F.col("longs_before") + F.sum(F.when(~short, 1).otherwise(0)).over(so_far))
        .withColumn("is_system", (F.col("turn_no") == 0) & (F.col("system") > 0))
    )
    room = budget - history - F.col("system")
    span = F.when(~short, F.lit(-1)).otherwise(F.floor(F.col("before") / (room - F.col("widest") + 1)))
    return numbered.select(
        "conv", "turn_no", "before", "is_system", "longs", span.cast("long").alias("span"), "system", *BODY
    )


def windows(
    rows: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY, cell: int = CELL
) -> DataFrame:
    """The windows of all conversations (conv_id, turn, role, text), tokens by the vocabulary at ``path``.

    Columns: conv_id, first_turn (the number of the stretch's first turn; windows of a
    conversation are in its order), text, n_tokens, n_turns, n_repeated (leading turns that are repeated from
    earlier windows), loss_from and loss_to (code points of text under the loss mask).
    """
    if not 0 < history <= budget // 4:
        raise ValueError("the repeated turns may take a quarter of the budget")
    turns = materialize(placed(written(rows, path), budget, history, cell), "chat-places")
    stretch = ["conv", "longs", "span"]
    light = turns.select(*stretch, "turn_no", "before", "system", "is_system", "n_tokens").where(~F.col("is_system"))
    begun = (
        light.groupBy(*stretch)
        .agg(F.min(F.struct("turn_no", "before", "system")).alias("at"), F.sum("n_tokens").alias("n_new"))
        .select(*stretch, F.col("at.turn_no").alias("first"), F.col("at.before").alias("first_before"),
                F.least(F.lit(history), budget - F.col("at.system") - F.col("n_new")).alias("allowed"))
    )
    begun = materialize(begun, "chat-windows")
    # Turns that begin within `history` tokens before a stretch: in the same span of that many tokens or the one before.
    span = F.floor(F.col("before") / history)
    repeated = (
        light.select("conv", "turn_no", "before", F.explode(F.array(span, span + 1)).alias("near"))
        .join(begun.select("conv", "first", "first_before", "allowed", F.floor(F.col("first_before") / history).alias("near")), ["conv", "near"])
        .where("first > turn_no AND first_before - before <= allowed")
        .groupBy("conv", "turn_no")
        .agg(F.collect_list("first").alias("later"))
    )
    own = turns.where(~F.col("is_system")).join(begun.select(*stretch, "first"), stretch)
    again = own.join(repeated, ["conv", "turn_no"], "left").select(
        "conv", "turn_no", *BODY,
        F.explode(
            F.concat(
                F.array(F.struct("first", F.lit(False).alias("again"))),
                F.coalesce(F.transform("later", lambda f: F.struct(f.alias("first"), F.lit(True).alias("again"))), F.array()),
            )
        ).alias("window"),
    ).select("conv", "window.first", "turn_no", "window.again", *BODY)
    # The system turn is one row per conversation. The stretches stand on the left, where a long conversation's are split.
    system = turns.where("is_system").select("conv", "turn_no", *BODY)
    first_of_all = F.col("first") > F.col("turn_no") + 1
    of_system = begun.select("conv", "first").join(system, "conv").select("conv", "first", "turn_no", first_of_all.alias("again"), *BODY)
    only = system.join(begun.select("conv").distinct(), "conv", "left_anti").select(
        "conv", F.col("turn_no").alias("first"), "turn_no", F.lit(False).alias("again"), *BODY
    )
    parts = again.unionByName(of_system).unionByName(only)
    return gathered(parts.withColumn("key", F.concat_ws(" ", "conv", "first")))


WINDOWS = (
    "conv_id long, first_turn long, text string, n_tokens long, n_turns int, n_repeated int, "
    "loss_from array<long>, loss_to array<long>"
)


def gathered(parts: DataFrame) -> DataFrame:
    """Windows of their turns, by ``key``: the repeated turns, and then the new ones, in order."""

    def each(rows: pa.RecordBatch) -> Columns:
        rows = rows.sort_by([("turn_no", "ascending")])
        role, form, n_head, n_chars, again = (rows.column(n).to_pylist() for n in ("role", "form", "n_head", "n_chars", "again"))
        loss, at = [], 0
        for r, h, n, old in zip(role, n_head, n_chars, again, strict=True):
            if r == "assistant" and not old:
                loss.append((at + h, at + n - len(END)))
            at += n
        conv = rows.column("conv")[0].as_py()
        return {
            "conv_id": [int(conv) if conv else None],
            "first_turn": [rows.column("first")[0].as_py()],
            "text": ["".join(form)],
            "n_tokens": [sum(rows.column("n_tokens").to_pylist())],
            "n_turns": [len(form)],
            "n_repeated": [sum(again)],
            "loss_from": [[a for a, _ in loss]],
            "loss_to": [[b for _, b in loss]],
        }

    return by_group(parts, "key", each, WINDOWS)


def read_back(chats: DataFrame) -> DataFrame:
    """What the windows hold, per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest is a chain over all turns, so a conversation's windows pass through one task, one at a time and
    in order; only the running digests are kept.
    """

    def run(batches: Batches) -> Iterator[Columns]:
        key, turns, loss, sums = None, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

        def line() -> dict[str, list]:
            return {
                "conv_id": [int(key) if key else None], "n_turns": [sums[0]], "turns_sha256": [turns.hexdigest()],
                "loss_chars": [sums[1]], "loss_sha256": [loss.hexdigest()], "formatted_chars": [sums[2]],
            }

        for batch in batches:
            done: list[dict[str, list]] = []
            names = ("key", "text", "n_repeated", "loss_from", "loss_to")
            for conv, text, n_repeated, begins, ends in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if conv != key:
                    if key is not None:
                        done.append(line())
                    key, turns, loss, sums = conv, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                for role, body, _ in read_turns(text)[n_repeated:]:
                    turns.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                    sums[0] += 1
                for a, b in zip(begins, ends, strict=True):
                    target = unescaped(text[a:b])
                    loss.update(target.encode("utf-8", "surrogatepass"))
                    sums[1] += len(target)
                sums[2] += len(text)
            if done:
                yield {name: [x for d in done for x in d[name]] for name in done[0]}
        if key is not None:
            yield line()

    keyed = chats.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    ordered = keyed.repartition("key").sortWithinPartitions("key", "first_turn")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return by_batch(ordered.select("key", "text", "n_repeated", "loss_from", "loss_to"), run, schema)
