"""Near-dedup by a chosen-path similarity join over shingle sets.

* Each text becomes the set of its distinct 5-word shingles. Texts with equal sets are one
  set from here on, so copies cost nothing more, however many there are.
* In each of TREES independent trees a set chooses, level by level, the shingle that is
  least under that level's own hash, and follows the branch of that shingle. Branches with
  one set end. A branch of at most LEAF sets is a leaf; larger ones branch again, LEVELS times
  at most. Two sets of similarity s share a branch with probability s per level, so a
  pair at the threshold 0.8 is missed by all trees with probability at most
  (1 - 0.8**3)**16 = 1e-5, and by far less when its branches are small.
* The sets of a leaf are compared exhaustively, first on their TREES * LEVELS least hashes:
  pairs that agree on fewer than ROUGH of them (at 0.8 all but one in a million agree
  on more) are dropped. What is left joins sets into families, and the texts of a family
  are compared on their full sets.
* A leaf or family that is too large for a task is compared with its hub first: the set that is
  most like the others. Sets linked to the hub are joined through it, so only the others are
  compared with all, block by block. A large group of edits of one text costs one
  comparison per set.
* Inside a task two sets that are already joined through others need no comparison, so a
  tight group costs about one comparison per set, and the links returned are a forest.

Defined cases: null and wordless texts have the empty set, link with nothing and are
components of their own. Null doc_ids never name a component unless all ids in it are
null. Rows that repeat a doc_id are judged each by its text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.components import components
from bazaarlens.llm.frames import Batches, Columns, by_batch, by_group
from bazaarlens.llm.words import mix, shingle_sets
from bazaarlens.sources.storage import materialize

#: Sets are linked from this similarity on, as a percentage. TREES and ROUGH are right for 80 or more.
PERCENT = 80
TREES = 16
LEVELS = 3
LEAF = 64
ROUGH = TREES * LEVELS // 2
#: Sets of a large group that choose what its hub must be like.
SAMPLED = 256
#: Most sets, and most shingles, of a block.
BLOCK = 1024
BLOCK_SHINGLES = 2_000_000

_SEEDS = mix(np.arange(1, TREES * LEVELS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_KEYS = mix(np.array([101, 202], np.uint64))
LINKS = "a string, b string"
#: The side of sets whose task is their whole group.
WHOLE = -1
SKETCH = "doc_id long, text_key long, n_shingles long, set_id string, least array<long>"


def set_id(shingles: np.ndarray) -> str:
    """128 bits that do not depend on the order of the shingles."""
    return "".join(f"{int(mix(shingles ^ k).sum(dtype=np.uint64)):016x}" for k in _KEYS)


def least_hashes(shingles: np.ndarray) -> np.ndarray:
    """The least hash of the set under each function; the hash names the shingle."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        x = (shingles[at : at + 4096, None] ^ _SEEDS) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        np.minimum(least, x.min(axis=0), out=least)
    return least.view(np.int64)


def sketch(batches: Batches) -> Iterator[Columns]:
    for batch in batches:
        sizes, ids, least = [], [], []
        for found in shingle_sets(batch.column("text").to_pylist()):
            sizes.append(len(found))
            ids.append(set_id(found) if len(found) else None)
            least.append(least_hashes(found) if len(found) else None)
        yield {
            "doc_id": batch.column("doc_id"),
            "text_key": batch.column("text_key"),
            "n_shingles": sizes,
            "set_id": ids,
            "least": least,
        }


class Forest:
    """Sets joined so far."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> None:
        self.root[np.isin(self.root, self.root[others])] = self.root[i]


def similar(
    agree: Callable[[int, np.ndarray], np.ndarray], side: np.ndarray
) -> Iterator[tuple[int, int]]:
    """Links that join all sets which a chain of agreeing pairs connects.

    Of sets of side WHOLE all pairs count, of sides 0 and 1 only those across. ``agree`` tells
    for a set and an array of others which of them it agrees with.
    """
    forest, within = Forest(len(side)), side[0] == WHOLE
    places = np.arange(len(side))
    for i in places if within else np.flatnonzero(side == 0):
        others = places[i + 1 :] if within else np.flatnonzero(side == 1)
        others = others[forest.root[others] != forest.root[i]]
        if len(others) and len(linked := others[agree(i, others)]):
            # One link to each group of sets that are joined already.
            _, one = np.unique(forest.root[linked], return_index=True)
            for j in linked[one]:
                yield int(i), int(j)
            forest.join(i, linked)


def rough_links(rows: pa.RecordBatch) -> Columns | None:
    """Links between the sets of a leaf whose least hashes agree often enough."""
    least = rows.column("least").flatten().to_numpy().reshape(rows.num_rows, TREES * LEVELS)
    if rows.num_rows == 2 and (least[0] == least[1]).sum() < ROUGH:
        return None
    side, ids = rows.column("side").to_numpy(), rows.column("set_id").to_pylist()
    order = sorted(range(len(ids)), key=lambda n: (side[n], ids[n]))
    side, ids, least = side[order], [ids[n] for n in order], least[order]

    def agree(i: int, others: np.ndarray) -> np.ndarray:
        return (least[others] == least[i]).sum(axis=1) >= ROUGH

    return named_links(ids, similar(agree, side))


def named_links(ids: list[str], links: Iterator[tuple[int, int]]) -> Columns | None:
    found = [(ids[i], ids[j]) for i, j in links]
    return {"a": [a for a, _ in found], "b": [b for _, b in found]} if found else None


def full_links(rows: pa.RecordBatch, percent: int = PERCENT) -> Columns | None:
    """Links between the sets of a family, by their full intersections and unions."""
    sets: dict[tuple[int, str], np.ndarray] = {}
    keys, side = rows.column("set_id").to_pylist(), rows.column("side").to_pylist()
    for key, part, found in zip(keys, side, shingle_sets(rows.column("text").to_pylist()), strict=True):
        # A doc_id that stands on several rows brings texts that are not asked for.
        if len(found) and set_id(found) == key:
            sets[part, key] = found
    order = sorted(sets)
    sides, ids, found = np.array([part for part, _ in order]), [key for _, key in order], [sets[k] for k in order]
    if len(found) < 2:
        return None
    sizes = np.array([len(s) for s in found])
    values, codes = np.unique(np.concatenate(found), return_inverse=True)
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    mark = np.zeros(len(values), bool)

    def agree(i: int, others: np.ndarray) -> np.ndarray:
        fits = (100 * sizes[others] >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes[others])
        hit = np.zeros(len(others), bool)
        mark[codes[cuts[i] : cuts[i + 1]]] = True
        for k in np.flatnonzero(fits):
            j = others[k]
            both = int(np.count_nonzero(mark[codes[cuts[j] : cuts[j + 1]]]))
            hit[k] = 100 * both >= percent * (sizes[i] + sizes[j] - both)
        mark[codes[cuts[i] : cuts[i + 1]]] = False
        return hit

    return named_links(ids, similar(agree, sides))


def agreement(a: str, b: str) -> Column:
    """How many of their least hashes two sets have in common."""
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda x, y: x + y)


def hubs(members: DataFrame) -> DataFrame:
    """(group, hub, hub_least): the set of each group that is most like the others.

    It agrees best, among all members (group, set_id, n, least), with the commonest least hashes
    of about SAMPLED of them. A poor hub costs comparisons and no links.
    """
    sampled = members.where(F.pmod(F.xxhash64("set_id", F.lit(3)), F.ceil(F.col("n") / SAMPLED)) == 0)
    votes = (
        sampled.select("group", F.posexplode("least").alias("place", "value"))
        .groupBy("group", "place", "value")
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    top = votes.groupBy("group", "place").agg(F.max(F.struct("votes", "value")).alias("top"))
    # One value for each of TREES * LEVELS places.
    places = F.sort_array(F.collect_list(F.struct("place", F.col("top.value").alias("value"))))
    middle = top.groupBy("group").agg(places.alias("m")).select("group", F.col("m.value").alias("middle"))
    best = F.max(F.struct(agreement("least", "middle").alias("like"), "set_id", "least")).alias("best")
    return (
        members.join(middle, "group")
        .groupBy("group")
        .agg(best)
        .select("group", F.col("best.set_id").alias("hub"), F.col("best.least").alias("hub_least"))
    )


def crossed(members: DataFrame, linked: DataFrame) -> DataFrame:
    """Members (group, set_id, blocks, ...) that are not ``linked`` (group, set_id) against all
    members of their group: each pair of blocks is a ``task``, and ``side`` tells its blocks apart.

    Linked sets are joined to the hub of their group, so pairs of them need no comparison.
    """
    alone = members.join(linked, ["group", "set_id"], "left_anti")
    sizes = alone.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("rows"))
    task = F.concat_ws(":", "group", "row", "column").alias("task")
    others = [c for c in members.columns if c not in ("group", "blocks")]
    left = (
        alone.join(sizes, "group")
        .withColumn("row", F.pmod(F.xxhash64("set_id", F.lit(5)), F.col("rows")))
        .withColumn("column", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    )
    right = (
        members.join(sizes, "group")
        .withColumn("column", F.pmod(F.xxhash64("set_id", F.lit(7)), F.col("blocks")))
        .withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    )
    return left.select(task, F.lit(0).alias("side"), *others).union(
        right.select(task, F.lit(1).alias("side"), *others)
    )


def leaves(sets: DataFrame) -> DataFrame:
    """(set_id, leaf, n): the leaves of all trees with two sets or more."""
    rows = sets.select(
        "set_id", F.posexplode(F.expr(f"transform(sequence(0, {TREES - 1}), t -> slice(least, t * {LEVELS} + 1, {LEVELS}))")).alias("tree", "path")
    )
    found, path = [], ["tree"]
    for level in range(LEVELS):
        rows = rows.withColumn(f"step{level}", F.col("path")[level])
        path.append(f"step{level}")
        sizes = rows.groupBy(path).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = materialize(rows.drop("n").join(sizes, path), f"near-level{level}")
        last = level == LEVELS - 1
        ended = F.lit(True) if last else F.col("n") <= LEAF
        leaf = F.concat_ws(":", F.lit(level), F.hex(F.xxhash64(*path)))
        found.append(rows.where(ended).select("set_id", leaf.alias("leaf"), "n"))
        rows = rows.where(~ended)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def candidate_links(sets: DataFrame) -> DataFrame:
    """(a, b): a forest over the sets that agree roughly in some leaf."""
    found = leaves(sets).withColumnRenamed("leaf", "group")
    least = sets.select("set_id", "least")
    one_task = found.where(F.col("n") <= BLOCK).select("set_id", F.col("group").alias("task"), F.lit(WHOLE).alias("side"))
    links = by_group(one_task.join(least, "set_id"), "task", rough_links, LINKS)
    # Leaves that are too large for a task.
    large = materialize(found.where(F.col("n") > BLOCK).join(least, "set_id"), "near-large-leaves")
    near = F.col("set_id") == F.col("hub")
    near = near | (agreement("least", "hub_least") >= ROUGH)
    linked = materialize(
        large.join(hubs(large), "group").where(near).select("group", "set_id", "hub"), "near-hub-leaves"
    )
    blocked = large.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).drop("n")
    rest = by_group(crossed(blocked, linked.drop("hub")), "task", rough_links, LINKS)
    return links.union(linked.select("hub", "set_id")).union(rest).distinct()


def confirmed_links(docs: DataFrame, sets: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """(a, b): a forest over the linked sets of each family (node, root)."""
    members = materialize(
        families.select(F.col("node").alias("set_id"), F.col("root").alias("group")).join(
            sets.select("set_id", "doc_id", "n_shingles", "least"), "set_id"
        ),
        "near-families",
    )
    sizes = members.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"),
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).alias("blocks"),
    )
    light = materialize(members.join(sizes, "group"), "near-sizes")
    keys = light.select("group", "set_id", "blocks", F.col("doc_id").alias("_id"))
    texts = docs.select("doc_id", "text").join(keys, F.col("_id").eqNullSafe(F.col("doc_id")))
    texts = materialize(texts.select("group", "set_id", "blocks", "text"), "near-texts")
    compare = partial(full_links, percent=percent)
    one_task = texts.where("blocks = 1").select(F.col("group").alias("task"), F.lit(WHOLE).alias("side"), "set_id", "text")
    links = by_group(one_task, "task", compare, LINKS)
    # Families that are too large for a task: all against the hub, and what it does not link
    # against all.
    large = texts.where("blocks > 1")
    chosen = materialize(hubs(light.where("blocks > 1")).select("group", "hub"), "near-hubs")
    hub_texts = large.join(chosen, "group").where("set_id = hub")
    column = F.pmod(F.xxhash64("set_id", F.lit(7)), F.col("blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    task = F.concat_ws(":", "group", "column").alias("task")
    spokes = (
        large.withColumn("column", column)
        .select(task, F.lit(1).alias("side"), "set_id", "text")
        .union(hub_texts.withColumn("column", every).select(task, F.lit(0).alias("side"), "set_id", "text"))
    )
    hub_links = materialize(by_group(spokes, "task", compare, LINKS), "near-hub-links")
    linked = large.select("group", "set_id").join(hub_links.select(F.col("b").alias("set_id")).distinct(), "set_id")
    rest = by_group(crossed(large, linked.select("group", "set_id")), "task", compare, LINKS)
    return links.union(hub_links).union(rest)


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    return labelled(docs, percent).drop("set_id", "text_key")


def labelled(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    sketches = materialize(by_batch(docs, sketch, SKETCH), "near-sketches")
    sets = materialize(
        sketches.where("set_id is not null")
        .groupBy("set_id", "n_shingles")
        .agg(F.min("doc_id").alias("doc_id"), F.first("least").alias("least")),
        "near-sets",
    )
    families = components(candidate_links(sets))
    linked = components(confirmed_links(docs, sets, families, percent))
    ids = sets.select("set_id", F.col("doc_id").alias("first_id"))
    roots = linked.join(ids, linked["node"] == ids["set_id"]).select("root", "node", "first_id")
    least = roots.groupBy("root").agg(F.min("first_id").alias("component"))
    named = roots.join(least, "root").select(F.col("node").alias("set_id"), "component")
    labels = ids.join(named, "set_id", "left").select(
        "set_id", F.coalesce("component", "first_id").alias("component")
    )
    return (
        sketches.drop("least")
        .join(labels, "set_id", "left")
        .withColumn(
            "component_id", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component"))
        )
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            "set_id",
            "text_key",
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which each component keeps one, with all their columns.

    Texts without words are no copies of each other: they all stay. Of rows that share the
    component's doc_id and its set, one stays.
    """
    kept = labelled(docs).where("kept")
    chosen = kept.where("set_id is not null").groupBy("doc_id", "set_id")
    wordless = kept.where("set_id is null").select("doc_id", "text_key").distinct()
    kept = (
        chosen.agg(F.min("text_key").alias("text_key"), F.lit(False).alias("_wordless"))
        .drop("set_id")
        .union(wordless.withColumn("_wordless", F.lit(True)))
        .withColumnsRenamed({"doc_id": "_kept", "text_key": "_text"})
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64("text").alias("_key"),
    )
    copy = Window.partitionBy("_id", "_key").orderBy("_wordless")
    return (
        rows.join(kept, rows["_id"].eqNullSafe(kept["_kept"]) & (rows["_key"] == kept["_text"]))
        .withColumn("_copy", F.row_number().over(copy))
        .where("_copy = 1 or _wordless")
        .select("_row.*")
    )


SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id
    JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
    GROUP BY x.doc_id, y.doc_id, p.n, q.n
    HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
),
reach AS (
    SELECT doc_id, doc_id AS r FROM documents
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(r) AS component_id,
       d.doc_id = min(r) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes ON sizes.doc_id = d.doc_id
GROUP BY d.doc_id
"""
