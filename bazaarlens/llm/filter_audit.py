"""Which filter removes what, in every order of the filters, by the potential of the removal game.

Filters are the players of a game: a coalition's value is the number of documents that at
least one of its filters removes. All orders and steps follow from these values alone.

* Every document becomes the bits of the filters it fails. Whether a text is a copy of one with a
  smaller doc_id is settled over the whole table: digests of texts are grouped, counts added up per task first,
  so the copies of one text are never held together.
* Documents are counted by part and bits: at most 2**k rows a part, whatever the table.
* ``potentials`` gives each coalition S its Hart-Mas-Colell potential, from the smallest up:
  P(S) = (v(S) + the sum of P(S without i) over i in S) / |S|. The Shapley value of a filter is the
  potential of all filters minus that of all others. Scaled by k! all numbers are whole.
* The step of filter f after the filters S removes v(S with f) - v(S).

Defined cases: a null text counts as empty, and a null ``lang`` is the part ''. A null doc_id is neither
smaller nor larger than another, so such a row fails no copy filter and makes no other fail it. Rows that repeat a
doc_id and text are copies of smaller ids only, not of each other. Of several labels of a doc_id,
one that says 1 counts; null and missing labels say nothing. Other columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping
from itertools import permutations
from math import factorial

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.frames import Batches, Columns, by_batch
from bazaarlens.sources.storage import materialize

#: Bytes of a text that are split into words at once.
SLICE = 1 << 20
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_SIGNS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
#: Measures of a step: all documents, those labelled good, those labelled toxic.
MEASURES = ("n", "good", "toxic")


def words_of(raw: bytes) -> tuple[int, int]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` and distinct ones. Only the distinct ones are held."""
    count, seen, at = 0, set(), 0
    while at < len(raw):
        end = at + SLICE
        gap = _WHITE.search(raw, end) if end < len(raw) else None
        end = gap.end() if gap else len(raw)
        # Without an argument, bytes split at exactly these six characters.
        words = raw[at:end].split()
        count += len(words)
        seen.update(words)
        at = end
    return count, len(seen)


def failed(raw: bytes, n_chars: int) -> int:
    """Bits 0 to 3: too few words, too repetitive, too many capitals, holds a sign."""
    words, distinct = words_of(raw)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (
        (words < LEAST_WORDS)
        | (100 * distinct < LEAST_DISTINCT * words) << 1
        | (100 * capitals > MOST_CAPITALS * n_chars) << 2
        | (_SIGNS.search(raw) is not None) << 3
    )


def judged(docs: DataFrame, part: Column, check: Callable[[bytes, int], int] = failed) -> DataFrame:
    """Per row of ``docs``: doc_id, part, the bits of ``check`` on its whole text, and the text's digest."""

    def run(batches: Batches) -> Iterator[Columns]:
        for batch in batches:
            bits, digests = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                raw = text.encode("utf-8", "surrogatepass")
                bits.append(check(raw, len(text)))
                digests.append(hashlib.sha256(raw).digest())
            kept = {name: batch.column(name).to_pylist() for name in ("doc_id", "part")}
            yield kept | {"bits": bits, "digest": digests}

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"), "text"
    )
    return by_batch(rows, run, "doc_id long, part string, bits int, digest binary")


def failures(docs: DataFrame, labels: DataFrame, part: Column, copies: int = 4) -> DataFrame:
    """Documents counted by part and bits, bit ``copies`` set for copies of a smaller doc_id's text.

    Columns: part, bits, and the counts of MEASURES.
    """
    rows = materialize(judged(docs, part), "audit-rows")
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # Rows without an id find no label. The second key spreads them over all tasks.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0))
    flags = [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in MEASURES[1:]]
    kind = ("digest", "bits", "part", *MEASURES[1:])
    own = (
        rows.groupBy("doc_id", spread.alias("spread"), "digest", "bits", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(said.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
        .select("doc_id", "digest", "bits", "part", "n", *flags)
    )
    # The rows of one text: a few kinds, however many copies. Aggregates combine within each task first.
    kinds = own.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
    )
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    originals = F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0) + F.col("nameless")
    split = kinds.withColumn("first", first).select(
        "part", *MEASURES[1:],
        F.inline(
            F.array(
                F.struct(F.col("bits"), originals.alias("n")),
                F.struct(F.col("bits").bitwiseOR(1 << copies).alias("bits"), (F.col("n") - originals).alias("n")),
            )
        ),
    )
    return (
        split.where("n > 0")
        .groupBy("part", "bits")
        .agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * F.col(name)).alias(name) for name in MEASURES[1:]))
    )


def coalition_values(counts: Mapping[int, int], k: int) -> list[int]:
    """v(S) for every coalition S, as bits: the documents that fail a filter of S."""
    return [sum(n for bits, n in counts.items() if bits & s) for s in range(1 << k)]


def potentials(values: list[int]) -> list[int]:
    """k! times the potential of every coalition, from the smaller coalitions up. Whole numbers."""
    k = (len(values) - 1).bit_length()
    scale, found = factorial(k), [0] * len(values)
    for s in range(1, len(values)):
        members = [1 << i for i in range(k) if s >> i & 1]
        # A potential is a sum of dividends over coalition sizes, which divide k!: nothing is rounded.
        found[s] = (scale * values[s] + sum(found[s ^ m] for m in members)) // len(members)
    return found


def steps(counts: Mapping[str, Mapping[int, int]], letters: str) -> Iterator[tuple]:
    """For every order of the filters and step: the order, the step, and the counts of ``audit``.

    ``counts`` has the documents of one part by bits, for each measure.
    """
    k, everyone = len(letters), (1 << len(letters)) - 1
    total = sum(counts["n"].values())
    value = {measure: coalition_values(counts[measure], k) for measure in MEASURES}
    v, potential = value["n"], potentials(value["n"])
    for order in permutations(range(k)):
        before = 0
        name = "".join(letters[f] for f in order)
        for step, f in enumerate(order, 1):
            after, alone = before | 1 << f, 1 << f
            removed, good, toxic = (value[m][after] - value[m][before] for m in MEASURES)
            yield (
                name, step, total - v[after], removed, v[alone] - removed, v[everyone] - v[everyone ^ alone],
                good, toxic, potential[everyone] - potential[everyone ^ alone],
            )
            before = after


STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def audit(counted: DataFrame, letters: str) -> DataFrame:
    """The columns of STEPS from documents counted by part and bits; bit i is ``letters[i]``'s filter.

    ``shapley`` is summed over all orders. A part is one row of at most 2**k counts per measure, and
    parts are independent of each other.
    """
    names = [name.split()[0] for name in STEPS.split(", ")]

    def run(batches: Batches) -> Iterator[Columns]:
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                counts = {m: {c["bits"]: c[m] for c in cells} for m in MEASURES}
                rows = [(part, *row) for row in steps(counts, letters)]
                yield dict(zip(names, zip(*rows, strict=True), strict=True))

    parts = counted.groupBy("part").agg(F.collect_list(F.struct("bits", *MEASURES)).alias("cells"))
    return by_batch(parts, run, STEPS)


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The five filters A to E over ``docs`` in all 120 orders, per value of the column ``part``."""
    return audit(failures(docs, labels, F.col(f"`{part}`")), "ABCDE")


#: The same by trying every order on every document, for DuckDB.
SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), parts AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts
), flags AS (
    SELECT p.doc_id, part,
           [len(words) < 200,
            100 * len(list_distinct(words)) < 50 * len(words),
            100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text),
            regexp_matches(text, '[#$%&*|]'),
            coalesce(doc_id > (MIN(doc_id) OVER (PARTITION BY text)), false)] AS fails
    FROM parts p
), labelled AS (
    SELECT f.*, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
    FROM flags f LEFT JOIN (
        SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
               MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
    ) l ON f.doc_id = l.doc_id
), kinds AS (
    SELECT part, fails, COUNT(*) AS n, SUM(good) AS good, SUM(toxic) AS toxic FROM labelled GROUP BY part, fails
), digits AS (SELECT unnest([1, 2, 3, 4, 5]) AS d),
orders AS (
    SELECT [a.d, b.d, c.d, d.d, e.d] AS seq FROM digits a, digits b, digits c, digits d, digits e
    WHERE len(list_distinct([a.d, b.d, c.d, d.d, e.d])) = 5
), steps AS (
    SELECT seq, s.d AS step, seq[s.d] AS f, seq[1 : s.d - 1] AS earlier FROM orders, digits s
), tried AS (
    SELECT part, seq, step, f, n, good, toxic, fails[f] AS fails_this,
           len(list_filter(earlier, lambda x: fails[x])) > 0 AS gone,
           len(list_filter(fails, lambda x: x)) = 1 AS only_one
    FROM kinds, steps
), summed AS (
    SELECT part, seq, step, f,
           SUM(CASE WHEN NOT gone AND NOT fails_this THEN n ELSE 0 END) AS kept,
           SUM(CASE WHEN NOT gone AND fails_this THEN n ELSE 0 END) AS removed,
           SUM(CASE WHEN gone AND fails_this THEN n ELSE 0 END) AS redundant,
           SUM(CASE WHEN fails_this AND only_one THEN n ELSE 0 END) AS unique_fails,
           SUM(CASE WHEN NOT gone AND fails_this THEN good ELSE 0 END) AS good_lost,
           SUM(CASE WHEN NOT gone AND fails_this THEN toxic ELSE 0 END) AS toxic_lost
    FROM tried GROUP BY part, seq, step, f
)
SELECT part, array_to_string(list_transform(seq, lambda x: substr('ABCDE', x, 1)), '') AS filter_order,
       CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM summed"""
