"""Document fingerprints by improved consistent weighted sampling, in SQL expressions only.

The terms of a text are its words (runs outside ``[\\x20\\x09-\\x0D]``), weighted by how often
they occur. For each of SAMPLES positions a term has two gamma(2, 1) numbers r and c
and a uniform b, and with weight S it draws t = floor(ln S / r + b) and
a = c / exp(r * (t - b) + r). The position takes the term of the least a, and it is told
by a itself, which no other term or draw shares. Two texts agree at a position with
probability sum(min) / sum(max) of their weights, the generalised Jaccard similarity, and the
share of agreeing positions estimates it.

The random numbers are read from two small tables, one with c and one with r and b. A term's hash
names a row of either, so 2**24 kinds of terms are told apart by 2 * 4096 broadcast rows.

Each document is compared with the next one (descending doc_id, after the last the first) and
with its edited text. Documents are dealt to cells of neighbours, and a
ghost row lends each cell the first document of the cell that follows, so one shuffle brings
together all that is compared. The borders of cells are quantiles of doc_id and the text's hash
in a bounded sample, so ids that crowd, lie far out, repeat or are null make no cell large; only
rows that agree in both are kept together. Borders decide where a row is worked on, not what comes out.

Defined cases: null counts as empty. Texts without words have one fingerprint of their own:
they are wholly alike, and unlike all others. Null doc_ids come last. Rows that repeat
a doc_id, null included, stand in the order of their texts' hashes. A lone row is its own next one. Other columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLES = 64
#: Bits of a row number in either table of random numbers.
BITS = 12
#: Documents of a cell and of a task; cells are bounded, and grow beyond that.
CELL = 256
TASK = 2048
MOST_CELLS = 1 << 16
#: Sampled rows for each border of cells, so half a million at most.
PER_BORDER = 8
DIGITS = 4


def uniform(*key: Column | int) -> Column:
    """A number between 0 and 1, both excluded, by the hash of the key."""
    hashed = F.xxhash64(*[F.lit(k) if isinstance(k, int) else k for k in key])
    return (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / float(1 << 53)


def gamma(row: Column, place: Column, seed: int) -> Column:
    """A gamma(2, 1) number: the sum of two exponential ones."""
    return -F.ln(uniform(row, place, seed) * uniform(row, place, seed + 1))


def random_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(row_c, ln_c) and (row_r, r, b): 2**BITS rows of arrays each."""
    places = F.sequence(F.lit(0), F.lit(SAMPLES - 1))
    rows = spark.range(1 << BITS).select(F.col("id").cast("int").alias("row"))
    row = F.col("row")
    first = rows.select(
        row.alias("row_c"), F.transform(places, lambda i: F.ln(gamma(row, i, 1))).alias("ln_c")
    )
    second = rows.select(
        row.alias("row_r"),
        F.transform(places, lambda i: gamma(row, i, 3)).alias("r"),
        F.transform(places, lambda i: uniform(row, i, 5)).alias("b"),
    )
    return first, second


def words(text: Column) -> Column:
    """Words, with empty strings between neighbouring white space."""
    for sign in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(sign), F.lit(" "))
    return F.split(text, " ")


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The rows of ``texts`` by their ``keys`` (unique) with ``fingerprint``, a string of DIGITS hex
    digits for each position. The key columns decide the partitioning: texts that are already
    clustered by some of them are not shuffled again."""
    names, draws = random_tables(texts.sparkSession)
    kind = F.xxhash64("word").bitwiseAND((1 << 2 * BITS) - 1).cast("int")
    # An empty text has one empty word, so it keeps its row; empty words count as no term.
    terms = (
        texts.select(*keys, F.explode(words(F.col(text))).alias("word"))
        .select(*keys, F.when(F.col("word") != "", kind).alias("kind"))
        .groupBy(*keys, "kind")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("row_c", F.col("kind").bitwiseAND((1 << BITS) - 1))
        .withColumn("row_r", F.shiftright("kind", BITS))
        .withColumn("ln_s", F.ln(F.col("n").cast("double")))
    )
    drawn = terms.join(F.broadcast(names), "row_c", "left").join(F.broadcast(draws), "row_r", "left")

    def least(i: int) -> Column:
        r, b = F.col("r")[i], F.col("b")[i]
        drawn_t = F.floor(F.col("ln_s") / r + b)
        return F.min(F.col("ln_c")[i] - r * (drawn_t - b + 1.0)).alias(f"a{i}")

    least_of_all = drawn.groupBy(*keys).agg(*[least(i) for i in range(SAMPLES)])
    digits = [
        F.lpad(F.hex(F.xxhash64(f"a{i}").bitwiseAND((1 << 4 * DIGITS) - 1)), DIGITS, "0")
        for i in range(SAMPLES)
    ]
    return least_of_all.select(*keys, F.lower(F.concat(*digits)).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of positions where two fingerprints agree."""
    same = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLES - 1)),
        lambda i: (
            F.substring(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substring(b, i * DIGITS + 1, F.lit(DIGITS))
        ).cast("int"),
    )
    return F.aggregate(same, F.lit(0), lambda x, y: x + y) / float(SAMPLES)


def borders(rows: DataFrame, cells: int, share: float) -> str:
    """The first (doc_id, hash) of every cell but the first, in order, as JSON."""
    spread = F.pmod(F.xxhash64("doc_id", "hash", F.lit(29)), F.lit(1 << 20))
    chosen = rows.where(spread < math.ceil(share * (1 << 20)))
    held = chosen.agg(F.array_sort(F.collect_list(F.struct("doc_id", "hash"))).alias("held"))
    places = F.sequence(F.lit(1), F.lit(cells - 1))
    cut = F.transform(places, lambda k: F.get("held", F.floor(k * F.size("held") / cells).cast("int")))
    return held.select(F.to_json(F.array_distinct(F.array_compact(cut)))).first()[0]


def cell_of(bounds: str, cells: int) -> Column:
    """The number of borders up to a row, by bisection."""
    held = F.from_json(F.lit(bounds), "array<struct<doc_id:bigint,hash:bigint>>")
    steps = F.array(*[F.lit(1 << n) for n in reversed(range(cells.bit_length()))])
    own = F.struct("doc_id", "hash")
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(held, at + step - 1) <= own, at + step).otherwise(at)
    ).cast("long")


def in_cells(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (doc_id, text, hash, cell, ghost), and the number of tasks for them."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("hash", F.xxhash64("text"))
    n = docs.count()
    cells = min(MOST_CELLS, max(1, math.ceil(n / CELL)))
    bounds = borders(docs, cells, min(1.0, PER_BORDER * cells / n)) if cells > 1 else "[]"
    rows = docs.withColumn("cell", cell_of(bounds, cells))
    # At most MOST_CELLS rows, which fit one task and a broadcast.
    tops = rows.groupBy("cell").agg(F.max(F.struct("doc_id", "hash")).alias("top"))
    down, everything = Window.orderBy(F.desc("cell")), Window.orderBy(F.desc("cell")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    lent = tops.select(
        F.coalesce(F.lag("cell").over(down), F.last("cell").over(everything)).alias("cell"),
        F.col("cell").alias("from_cell"),
        F.col("top.doc_id").alias("top_id"),
        F.col("top.hash").alias("top_hash"),
    )
    same = (
        (F.col("own") == F.col("from_cell"))
        & (F.col("hash") == F.col("top_hash"))
        & F.col("doc_id").eqNullSafe(F.col("top_id"))
    )
    ghosts = (
        rows.withColumnRenamed("cell", "own")
        .join(F.broadcast(lent), same)
        .groupBy("cell", "doc_id", "hash")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", "hash", "cell", F.lit(True).alias("ghost"))
    )
    return rows.withColumn("ghost", F.lit(False)).unionByName(ghosts), max(1, min(cells, n // TASK))


def compared(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    rows, tasks = in_cells(docs)
    order = [
        F.asc("ghost"),
        F.desc_nulls_last("doc_id"),
        F.desc("hash"),
        F.col("text"),
    ]
    line = Window.partitionBy("cell").orderBy(*order)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    paired = (
        rows.repartition(tasks, "cell")
        .withColumn("place", F.row_number().over(line))
        .withColumn("following", F.lead("text").over(line))
        .withColumn("n_chars", F.char_length("text"))
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), F.col("n_chars") - half),
                F.substring("following", F.lit(1), half),
            ),
        )
    )
    both = F.when(F.col("ghost"), F.array("text")).otherwise(F.array("text", "edited"))
    texts = paired.select("cell", "place", F.posexplode(both).alias("kind_of_text", "body"))
    prints = fingerprints(texts, ["cell", "place", "kind_of_text"], "body")
    chosen = lambda k: F.max(F.when(F.col("kind_of_text") == k, F.col("fingerprint")))
    prints = prints.groupBy("cell", "place").agg(
        chosen(0).alias("fingerprint"), chosen(1).alias("edited_fingerprint")
    )
    facts = paired.select(
        "cell", "place", "ghost", "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256")
    )
    following = F.lead("fingerprint").over(Window.partitionBy("cell").orderBy("place"))
    return (
        facts.join(prints, ["cell", "place"])
        .withColumn("next_fingerprint", following)
        .where(~F.col("ghost"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        )
    )
