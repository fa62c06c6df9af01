"""Small Spark helpers that the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Mapping
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Cells that each group is dealt to when its rows are numbered.
CELLS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application."""
    package = Path(__file__).resolve().parent.parent
    name = f"{package.name}.zip"
    context = spark.sparkContext
    if package.is_dir() and not any(os.path.basename(f) == name for f in context.listFiles):
        path = os.path.join(os.path.realpath(tempfile.mkdtemp()), name)
        with zipfile.ZipFile(path, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(path)


Batches = Iterator[pa.RecordBatch]
#: Columns by name: lists or arrays of one length.
Columns = Mapping[str, Any]


def by_batch(frame: DataFrame, run: Callable[[Batches], Iterator[Columns]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package that yields columns.

    Integers beside nulls stay exact on the way, unlike in pandas.
    """
    ship(frame.sparkSession)
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def typed(batches: Batches) -> Batches:
        for columns in run(batches):
            arrays = [pa.array(columns[f.name], f.type, from_pandas=False) for f in kinds]
            yield pa.RecordBatch.from_arrays(arrays, schema=kinds)

    return frame.mapInArrow(typed, schema)


def bounded_sample(frame: DataFrame, most: int, *key: str) -> DataFrame:
    """At most ``most`` rows, chosen by the hash of their key from all of them."""
    share = min(1.0, 2.0 * most / max(frame.count(), 1))
    spread = F.pmod(F.xxhash64(*key, F.lit(23)), F.lit(1_000_003))
    return frame.where(spread <= share * 1_000_003).orderBy(spread, *key).limit(most)


def numbered(frame: DataFrame, group: str, cell: Column, name: str) -> DataFrame:
    """Number the rows of each group from 0 without a gap, none of them in one task.

    ``cell`` gives a long in 0 to CELLS - 1 and is the order of the numbers; within a
    cell they follow the frame's other columns, so that a repeated task numbers
    rows alike. Rows are numbered within their cell, and the counts of the cells
    before (a small table) are added. The frame is read twice: store it first if it is dear.
    """
    keyed = frame.withColumn("_cell", cell)
    own = Window.partitionBy(group, "_cell").orderBy(*frame.columns)
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        keyed.groupBy(group, "_cell")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        keyed.withColumn("_own", F.row_number().over(own).cast("long") - 1)
        .join(counts, [group, "_cell"])
        .withColumn(name, F.col("_before") + F.col("_own"))
        .drop("_cell", "_own", "_before")
    )


def by_group(
    frame: DataFrame, key: str, each: Callable[[pa.RecordBatch], Columns | None], schema: str
) -> DataFrame:
    """Call ``each`` with all rows of every key, many keys in one Arrow batch.

    As a grouped map, but cheap for millions of small groups. The key must be a
    column without nulls, and a group must fit in memory.
    """

    def whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return parts[0] if len(parts) == 1 else pa.concat_batches(parts)

    def run(batches: Batches) -> Iterator[Columns]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            n, keys = batch.num_rows, batch.column(key)
            if not n:
                continue
            if held and held[-1].column(key)[-1] != keys[0]:
                if out := each(whole(held)):
                    yield out
                held = []
            ends = np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(False)) + 1
            made: list[Columns] = []
            first = 0
            for end in ends.tolist():
                if out := each(whole([*held, batch.slice(first, end - first)])):
                    made.append(out)
                held, first = [], end
            held.append(batch.slice(first))
            if made:
                yield {name: [x for out in made for x in out[name]] for name in made[0]}
        if held and (out := each(whole(held))):
            yield out

    return by_batch(frame.repartition(key).sortWithinPartitions(key), run, schema)
