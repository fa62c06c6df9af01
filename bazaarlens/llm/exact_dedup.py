"""Exact dedup over an extendible-hash index on shared files.

Texts are equal when they agree after all of ``[\\x20\\x09-\\x0D]`` is deleted. Of equal
texts the row with the most code points stays, then the smallest doc_id.

* Every row gets the hash of its normalised text. The first bits of a hash are its
  cell. A directory over the cells starts with one bucket and doubles while a bucket
  holds more hashes than its capacity; only overfull buckets split, at most to the depth
  of the directory, whose 2**depth cells bound what is broadcast.
* The texts of a bucket are grouped by hash and bytes: texts with one hash and other
  bytes become links of a chain. Equal texts meet already in the task that read them, so a
  text that a third of all rows share is shuffled once per task, not once per row.
* Tasks that own ranges of buckets write the chains as index files to the shared folder,
  and light rows without text look up what stays.

Defined cases: a null text counts as empty, and all empty texts are equal. A null
doc_id comes after all others. Of rows that agree in text length and doc_id too,
exactly one stays. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.sources.scratch import scratch_path
from bazaarlens.sources.storage import materialize

#: Bits of the largest directory, and hashes that a bucket may hold before it splits.
DEPTH = 14
CAPACITY = 32_768
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for sign in WHITE:
        out = F.replace(out, F.lit(sign), F.lit(""))
    return out


def directory(hashes: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """For each cell in use its ``bucket`` (the first cell of the bucket) and local ``depth``.

    A bucket of depth d has the cells that share d leading bits. Going from one bucket
    to 2**depth, a cell stops at the first depth where its bucket is not overfull.
    """
    cells = (
        hashes.select("hash")
        .distinct()
        .groupBy(F.shiftrightunsigned("hash", 64 - depth).alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    paths = cells.select(
        "cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth")
    ).withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
    totals = paths.groupBy("depth", "prefix").agg(F.sum("n").alias("total"))
    fits = (F.col("total") <= capacity) | (F.col("depth") == depth)
    return (
        paths.join(totals, ["depth", "prefix"])
        .where(fits)
        .groupBy("cell")
        .agg(F.min("depth").alias("depth"))
        .withColumn("bucket", F.expr(f"shiftleft(shiftright(cell, {depth} - depth), {depth} - depth)"))
    )


def build_index(
    docs: DataFrame, entries: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH
) -> DataFrame:
    """The index read back from its files: one row per distinct text."""
    spark = docs.sparkSession
    cells = materialize(directory(entries, capacity, depth), "dedup-directory")
    norm = normalised(F.col("text"))
    texts = (
        docs.select(norm.alias("norm"))
        .withColumn("hash", F.xxhash64("norm"))
        .withColumn("cell", F.shiftrightunsigned("hash", 64 - depth))
        # At most 2**depth rows of three numbers.
        .join(F.broadcast(cells.select("cell", "bucket")), "cell")
    )
    chains = (
        texts.groupBy("bucket", "hash", "norm")
        .agg(F.count(F.lit(1)).alias("group_size"))
        .select("bucket", "hash", F.sha2("norm", 256).alias("text_sha256"), "group_size")
    )
    best = (
        entries.groupBy("hash", "text_sha256")
        .agg(
            F.max(
                F.struct("n_chars", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("flipped"))
            ).alias("best")
        )
        .select(
            "hash",
            "text_sha256",
            F.bitwise_not(F.col("best.flipped")).alias("keep_id"),
            F.col("best.n_chars").alias("keep_chars"),
        )
    )
    path = scratch_path(spark, "dedup-index")
    (
        chains.join(best, ["hash", "text_sha256"])
        .repartitionByRange("bucket", "hash")
        .withColumn(
            "link",
            F.row_number().over(Window.partitionBy("bucket", "hash").orderBy("text_sha256")),
        )
        .sortWithinPartitions("bucket", "hash", "link")
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    entries = materialize(
        docs.select(
            "doc_id",
            F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars"),
            normalised(F.col("text")).alias("norm"),
        ).select(
            "doc_id", "n_chars", F.xxhash64("norm").alias("hash"), F.sha2("norm", 256).alias("text_sha256")
        ),
        "dedup-entries",
    )
    index = build_index(docs, entries, capacity, depth).drop("bucket", "link")
    copy = Window.partitionBy("doc_id", "text_sha256").orderBy(F.desc("n_chars"))
    return (
        entries.join(index, ["hash", "text_sha256"])
        .withColumn("copy", F.row_number().over(copy))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (
                F.col("doc_id").eqNullSafe(F.col("keep_id"))
                & (F.col("n_chars") == F.col("keep_chars"))
                & (F.col("copy") == 1)
            ).alias("kept"),
            "text_sha256",
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_dedup(docs).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.sha2(normalised(F.col("text")), 256).alias("_sha"),
        F.char_length(F.coalesce("text", F.lit(""))).alias("_chars"),
    )
    same = rows["_id"].eqNullSafe(kept["_id"]) & (rows["_sha"] == kept["_sha"])
    first = Window.partitionBy("_id", "_sha").orderBy(F.desc("_chars"))
    return (
        rows.join(kept, same, "left_semi")
        .withColumn("_copy", F.row_number().over(first))
        .where("_copy = 1")
        .select("_row.*")
    )


SQL = """
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
