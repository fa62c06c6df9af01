"""Joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_many(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """``one`` left joined with ``many`` on ``key``, where ``many`` may be skewed.

    A left join can be split by adaptive execution on its left side only. Here the skewed rows stand
    on the left of an inner join, which splits them, and keys of ``one`` that ``many`` lacks
    stand beside them as a row without values. So ``one`` is computed once: for the missing keys only
    its key column is read, and left joins below that the key does not need fall away.
    """
    others = [f for f in many.schema.fields if f.name != key]
    missing = one.select(key).distinct().join(many.select(key).distinct(), on=key, how="left_anti")
    rows = many.where(F.col(key).isNotNull()).select(key, *(f.name for f in others)).union(
        missing.select(key, *(F.lit(None).cast(f.dataType).alias(f.name) for f in others))
    )
    # A null key matches the row that stands for it, as in a left join, and no row of ``many``.
    same = F.col(f"many.{key}").eqNullSafe(F.col(f"one.{key}"))
    columns = [*(f"one.{name}" for name in one.columns), *(f"many.{f.name}" for f in others)]
    return rows.alias("many").join(one.alias("one"), same).select(*columns)


#: Bits of the marks of keys, in maps of 32,768 kept as 512 longs: 16 MB at most, however many keys there are.
PLACES = 1 << 27
#: Types whose equal values have equal hashes, whichever dataset they stand in.
HASHED = ("string", "bigint", "int", "smallint", "tinyint")


def _place_sql(key: str) -> str:
    return f"(xxhash64(`{key}`) & {PLACES - 1}L)"


def key_marks(rows: DataFrame, key: str) -> DataFrame:
    """A bit for the hash of every key, as bit maps by number: a table small enough for each executor to hold."""
    place = _place_sql(key)
    words = (
        rows.where(F.col(key).isNotNull())
        .selectExpr(f"shiftright({place}, 6) AS word", f"shiftleft(1L, int({place} & 63L)) AS bit")
        .groupBy("word")
        .agg(F.expr("bit_or(bit) AS bits"))
    )
    maps = words.groupBy(F.expr("shiftright(word, 9) AS map_no")).agg(
        F.expr("map_from_entries(collect_list(struct(word & 511L AS at, bits))) AS held")
    )
    return maps.selectExpr("map_no", "transform(sequence(0L, 511L), i -> coalesce(try_element_at(held, i), 0L)) AS longs")


def marked_rows(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key may stand in ``wanted``, before the join that decides: none that it finds is missing.

    Rows without a chance are left out where they are read, so they are neither shuffled nor sorted. As few
    others pass as there are free places: with twenty million keys one in seven. Beyond some hundred million nearly all pass, and
    the join is what it was. Keys of different types, which a join would cast, are not looked up.
    """
    kind = wanted.schema[key].dataType.simpleString()
    if kind not in HASHED or rows.schema[key].dataType.simpleString() != kind:
        return rows
    place = _place_sql(key)
    marked = f"getbit(longs[int(shiftright({place} & 32767L, 6))], int({place} & 63L)) = 1"
    found = F.expr(f"shiftright({place}, 15) = map_no AND {marked}")
    return rows.join(F.broadcast(key_marks(wanted, key)), found, "left_semi")
