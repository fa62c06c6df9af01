"""Hard negatives: for each anchor and positive, the best rows of other labels just below the positive.

A window of a positive holds the rows of other labels whose score with the anchor is between a share of the
positive's score and that score. The windows of one anchor overlap, but their upper limits cut the
scores into disjoint slots:

* Vectors become whole numbers once, and are stored. Anchors and rows are dealt to blocks of bounded size, and
  a task multiplies one block of anchors with one block of rows: all rows are read for every block of
  anchors, and no score leaves its task unless it may be a result.
* First pass: each block keeps an anchor's best rows of its own label; the best of all blocks are its positives.
* Second pass: the distinct scores of the positives are the slots' upper limits. A row of another label
  falls in the slot of the smallest limit that is not below its score. Each block keeps the best rows of every slot
  (the combiner), and again the best of all blocks stay.
* A window starts at its positive's slot and goes down. From the lowest slot up, the best of a slot
  and of the merged slots below are merged: each suffix answers the windows that begin there. As
  higher scores come first, the window's lower limit only cuts the end off.

Scores are whole and exact. Ties go to the smaller vec_id.

Defined cases: a row takes no part if its label, vector or vec_id is null, if a component is null or
not finite, or if the vector's product with itself is 2**62 or more, beyond which scores leave the longs.
Missing components of a shorter vector count as 0. Rows that repeat a vec_id are rows of their own: another row of that
id can be a positive, and each such anchor has results. Other columns are ignored. Without anchors there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.frames import Batches, Columns, by_batch, by_group
from bazaarlens.sources.storage import materialize

POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least this share of its positive's score.
SHARE = (80, 100)
SCALE = 256
#: Vectors of a block, and anchors that a task scores at a time.
BLOCK = 4096
CHUNK = 256
#: Whole numbers below this are exact as doubles.
EXACT = float(2**53)

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_vectors(rows: DataFrame, label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """The rows that take part: ``row`` (unique), ``vec_id``, ``label``, and ``codes``, whole numbers."""
    label = F.col("label") if label is None else label
    plain = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    # Above this, the square of one component is too much already.
    known = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**31 / scale))
    codes = F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    norm = F.aggregate("codes", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    return (
        plain.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
        .where(known)
        .select("vec_id", "label", codes.alias("codes"))
        .withColumn("norm", norm)
        .where(F.col("norm") < 2.0**62)
        .withColumn("row", F.monotonically_increasing_id())
    )


def noisy_label() -> Column:
    """The label, moved to the next of ten where vec_id is divisible by 7."""
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)


def matrix(codes: pa.Array) -> np.ndarray:
    """Lists of whole numbers as the rows of a matrix, shorter ones filled up with 0."""
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    sizes = codes.value_lengths().to_numpy(zero_copy_only=False)
    flat = codes.flatten().to_numpy(zero_copy_only=False)
    wide = int(sizes.max(initial=0))
    if (sizes == wide).all():
        return flat.reshape(len(sizes), wide).astype(np.int64, copy=False)
    out = np.zeros((len(sizes), wide), np.int64)
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


def products(anchors: np.ndarray, rows: np.ndarray, bound: float) -> np.ndarray:
    """All exact inner products. ``bound`` is the largest that any can be."""
    wide = min(anchors.shape[1], rows.shape[1])
    if bound < EXACT:
        a, r = anchors[:, :wide].astype(np.float64), rows[:, :wide].astype(np.float64)
        return (a @ r.T).astype(np.int64)
    return anchors[:, :wide] @ rows[:, :wide].T


def best(place: np.ndarray, at: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Which of the entries are among the ``most`` best of their place; ``at`` breaks ties, the smaller first."""
    order = np.lexsort((at, -score, place))
    sorted_places = place[order]
    firsts = np.flatnonzero(np.diff(sorted_places, prepend=-1))
    rank = np.arange(len(order)) - np.repeat(firsts, np.diff(np.append(firsts, len(order))))
    return order[rank < most]


def slots(limits: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The slot of each score: the last of the descending ``limits`` (one row per score) not below it; -1 above all."""
    return (score[:, None] <= limits).sum(axis=1) - 1


def least(score: int, share: tuple[int, int] = SHARE) -> int:
    """The smallest score in the window of a positive with this score."""
    low, whole = share
    return -(-low * score // whole)


def crossed(anchors: DataFrame, rows: DataFrame, block: int) -> DataFrame:
    """Every block of anchors beside every block of rows: the union of both with a ``pair`` of blocks."""
    n_anchors, n_rows = (max(1, -(-frame.count() // block)) for frame in (anchors, rows))

    def dealt(frame: DataFrame, own: int, other: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("row"), F.lit(own))
        return frame.select("*", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("theirs"))

    left = dealt(anchors, n_anchors, n_rows).withColumn("pair", F.col("mine") * n_rows + F.col("theirs"))
    right = dealt(rows, n_rows, n_anchors).withColumn("pair", F.col("theirs") * n_rows + F.col("mine"))
    left = left.withColumn("is_anchor", F.lit(True))
    right = right.withColumn("is_anchor", F.lit(False)).withColumn("limits", F.array().cast("array<long>"))
    return left.unionByName(right).drop("mine", "theirs")


def scored(pairs: DataFrame, positives: int, negatives: int, share: tuple[int, int]) -> DataFrame:
    """The best rows of every anchor in every pair of blocks: of its own label where it has no limits
    yet, else of other labels by slot. Columns: anchor (its row), anchor_id, slot, vec_id, score."""

    def each(group: pa.RecordBatch) -> Columns | None:
        sides = [group.filter(group.column("is_anchor")), group.filter(pc.invert(group.column("is_anchor")))]
        if not all(s.num_rows for s in sides):
            return None
        anchors, rows = sides[0], sides[1].sort_by([("vec_id", "ascending"), ("row", "ascending")])
        a_codes, r_codes = matrix(anchors.column("codes")), matrix(rows.column("codes"))
        bound = float(np.sqrt(np.max(anchors.column("norm").to_numpy()) * np.max(rows.column("norm").to_numpy())))
        column = {
            (side, name): frame.column(name).to_numpy()
            for side, frame in (("a", anchors), ("r", rows)) for name in ("row", "vec_id", "label")
        }
        limits = anchors.column("limits").to_pylist()
        found: list[tuple[np.ndarray, ...]] = []
        for start in range(0, anchors.num_rows, CHUNK):
            part = slice(start, start + CHUNK)
            scores = products(a_codes[part], r_codes, bound)
            same = column["a", "label"][part, None] == column["r", "label"][None, :]
            if limits[start]:
                # Unused limits are below all scores, and so no score's slot.
                upper = np.array([[*ls, *[-(2**63)] * (positives - len(ls))] for ls in limits[part]])
                lower = np.array([min(least(x, share) for x in ls) for ls in limits[part]])
                a, r = np.nonzero(~same & (scores <= upper[:, :1]) & (scores >= lower[:, None]))
                slot = slots(upper[a], scores[a, r])
                keep = best(a * positives + slot, r, scores[a, r], negatives)
            else:
                other = same & (column["a", "row"][part, None] != column["r", "row"][None, :])
                if scores.shape[1] > positives:
                    # Only scores from an anchor's last kept one on can matter; ties among them stay in.
                    seen = np.where(other, scores, -(2**63))
                    edge = -np.partition(-1 - seen, positives - 1, axis=1)[:, positives - 1 : positives] - 1
                    other &= scores >= edge
                a, r = np.nonzero(other)
                slot = np.zeros(len(a), np.int64)
                keep = best(a, r, scores[a, r], positives)
            a, r, slot = a[keep], r[keep], slot[keep]
            found.append((column["a", "row"][a + start], column["a", "vec_id"][a + start], slot, column["r", "vec_id"][r], scores[a, r]))
        names = ("anchor", "anchor_id", "slot", "vec_id", "score")
        return {name: np.concatenate(parts).tolist() for name, parts in zip(names, zip(*found, strict=True), strict=True)}

    return by_group(pairs, "pair", each, "anchor long, anchor_id long, slot int, vec_id long, score long")


def best_of_blocks(found: DataFrame, most: int) -> DataFrame:
    """The best rows of every anchor and slot over all blocks. Spark keeps the best of each task before it shuffles."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def suffixes(by_slot: dict[int, list[tuple[int, int]]], n_slots: int, most: int) -> list[list[tuple[int, int]]]:
    """For each slot the best (-score, vec_id) of it and all lower slots, merged from the lowest slot up."""
    merged: list[list[tuple[int, int]]] = [[] for _ in range(n_slots + 1)]
    for slot in range(n_slots - 1, -1, -1):
        merged[slot] = sorted(by_slot.get(slot, []) + merged[slot + 1])[:most]
    return merged


def windows(anchors: DataFrame, negatives: int, share: tuple[int, int]) -> DataFrame:
    """RESULT from one row per anchor: ``positives`` and ``slotted``, at most a few rows of each."""
    names = [name.split()[0] for name in RESULT.split(", ")]

    def run(batches: Batches) -> Iterator[Columns]:
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(n).to_pylist() for n in ("anchor_id", "positives", "slotted"))
            for anchor_id, positives, slotted in zip(*columns, strict=True):
                limits = sorted({p["score"] for p in positives}, reverse=True)
                by_slot: dict[int, list[tuple[int, int]]] = {}
                for row in slotted or ():
                    by_slot.setdefault(row["slot"], []).append((-row["score"], row["vec_id"]))
                merged = suffixes(by_slot, len(limits), negatives)
                for p in positives:
                    low = least(p["score"], share)
                    window = [(s, v) for s, v in merged[limits.index(p["score"])] if -s >= low]
                    out += [(anchor_id, p["vec_id"], n, v, p["score"], -s) for n, (s, v) in enumerate(window, 1)]
            yield dict(zip(names, zip(*out, strict=True), strict=True)) if out else {name: [] for name in names}

    return by_batch(anchors, run, RESULT)


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    share: tuple[int, int] = SHARE,
    block: int = BLOCK,
) -> DataFrame:
    """RESULT for ``vectors`` (the columns of :func:`whole_vectors`); ``anchors`` is true for the anchors."""
    rows = materialize(vectors, "negatives-vectors")
    chosen = rows.where(anchors)
    unlimited = chosen.withColumn("limits", F.array().cast("array<long>"))
    pairs = crossed(unlimited, rows, block)
    found = materialize(best_of_blocks(scored(pairs, positives, negatives, share), positives), "negatives-positives")
    of_anchor = found.groupBy("anchor", "anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives")
    )
    limited = of_anchor.select(
        F.col("anchor").alias("row"),
        F.sort_array(F.array_distinct(F.transform("positives", lambda p: p["score"])), asc=False).alias("limits"),
    )
    pairs = crossed(chosen.join(limited, "row"), rows, block)
    slotted = best_of_blocks(scored(pairs, positives, negatives, share), negatives)
    of_slot = slotted.groupBy("anchor").agg(F.collect_list(F.struct("slot", "score", "vec_id")).alias("slotted"))
    return windows(of_anchor.join(of_slot, "anchor").select("anchor_id", "positives", "slotted"), negatives, share)


def hard_negatives(rows: DataFrame) -> DataFrame:
    """RESULT for every anchor (vec_id divisible by 100) against all ``rows`` (vec_id, embedding, label)."""
    return mine(whole_vectors(rows, noisy_label()), F.col("vec_id") % 100 == 0)


#: All pairs, for DuckDB.
SQL = """
WITH vectors AS (
    SELECT row_number() OVER () AS row, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS codes
    FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, a.row = r.row AS itself,
           CAST(list_sum(list_transform(list_zip(a.codes, r.codes), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM vectors a, vectors r WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
    FROM scores WHERE same AND NOT itself
), ranked AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN scores n ON p.anchor = n.anchor
    WHERE p.place <= 5 AND NOT n.same
      AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5"""
