"""Resharding by minimum-cost flow: the fewest bytes move from old to new shards.

The rows of an old shard form blocks by size: a block holds the rows of a shard whose
sizes lie within a factor of two. Every row of a block may stay where it is, free of charge,
or go through a hub to another shard, at the mean size of its block. The new shards
take as many rows as their capacity says. A minimum-cost flow through that small network
(shards times size classes, however many rows there are) says how many rows of each block
go where, and so which shards are affected at all.

Rows are then numbered inside their blocks, small ones first, and take the destinations
of their block in turn. Only shards that give or take rows need to be written again.

The law is ``rows``: the numbers of rows of any two new shards differ by one at most. Where
the number of rows leaves some shards one row more, the flow picks those shards as well.

Defined cases: the size of a null text is 1, and its checksum is that of no bytes. A null
doc_id is a row like others. Rows that repeat a doc_id are rows of their own. Other columns
are ignored. An empty table gives no rows, and no shards if it is rewritten.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.frames import CELLS, numbered
from bazaarlens.sources.storage import materialize

SHARDS = 16
#: Shards of the layout that the query takes as the old one: a source has one shard.
OLD_SHARDS = 12


@dataclass
class Network:
    """A directed network with capacities and costs, for successive shortest paths."""

    heads: list[int] = field(default_factory=list)
    room: list[int] = field(default_factory=list)
    cost: list[float] = field(default_factory=list)
    out: dict[int, list[int]] = field(default_factory=dict)

    def add(self, tail: int, head: int, room: int, cost: float) -> int:
        """The number of the edge; the next number is its reverse."""
        edge = len(self.heads)
        self.heads += [head, tail]
        self.room += [room, 0]
        self.cost += [cost, -cost]
        self.out.setdefault(tail, []).append(edge)
        self.out.setdefault(head, []).append(edge + 1)
        return edge

    def push(self, source: int, sink: int) -> None:
        """Send as much as there is room for, at the least cost. Costs start at 0 or above."""
        height = dict.fromkeys(self.out, 0.0)
        while True:
            far, via, heap = {source: 0.0}, {}, [(0.0, source)]
            while heap:
                d, tail = heapq.heappop(heap)
                if d > far[tail]:
                    continue
                for edge in self.out.get(tail, ()):
                    head = self.heads[edge]
                    if not self.room[edge]:
                        continue
                    # Rounding must not make a reduced cost negative.
                    through = d + max(self.cost[edge] + height[tail] - height[head], 0.0)
                    if through < far.get(head, float("inf")):
                        far[head], via[head] = through, edge
                        heapq.heappush(heap, (through, head))
            if sink not in far:
                return
            top = far[sink]
            for node in height:
                height[node] += min(far.get(node, top), top)
            path, node = [], sink
            while node != source:
                path.append(via[node])
                node = self.heads[via[node] ^ 1]
            least = min(self.room[e] for e in path)
            for edge in path:
                self.room[edge] -= least
                self.room[edge ^ 1] += least


Block = tuple[int, int]


def transfers(
    blocks: Mapping[Block, tuple[int, int]], shards: int, capacities: Mapping[int, int] | None = None
) -> list[tuple[int, int, int, int]]:
    """How many rows of each block go to which shard, as (old shard, class, new shard, rows).

    ``blocks`` maps (old shard, size class) to its rows and bytes; old shards from
    ``shards`` on are given up. Without ``capacities`` all shards get equal numbers of rows,
    and those that get one more are part of the solution. Capacities must add up to
    the rows.
    """
    total = sum(n for n, _ in blocks.values())
    if capacities is not None and sum(capacities.values()) != total:
        raise ValueError("the capacities must add up to the rows")
    net = Network()
    source, sink, hub, spare = -1, -2, -3, -4
    place = {key: n for n, key in enumerate(sorted(blocks))}
    node = lambda shard: len(place) + shard
    stays, leaves = {}, {}
    for key, at in place.items():
        rows, size = blocks[key]
        net.add(source, at, rows, 0.0)
        if key[0] < shards:
            stays[key] = net.add(at, node(key[0]), rows, 0.0)
        leaves[key] = net.add(at, hub, rows, size / rows)
    enters = {s: net.add(hub, node(s), total, 0.0) for s in range(shards)}
    for s in range(shards):
        net.add(node(s), sink, total // shards if capacities is None else capacities.get(s, 0), 0.0)
        if capacities is None and total % shards:
            net.add(node(s), spare, 1, 0.0)
    if capacities is None and total % shards:
        net.add(spare, sink, total % shards, 0.0)
    net.push(source, sink)
    moved = lambda edge: net.room[edge ^ 1]
    out = [(*key, key[0], moved(edge)) for key, edge in stays.items() if moved(edge)]
    wanted = [(s, moved(edge)) for s, edge in enters.items() if moved(edge)]
    for key, edge in leaves.items():
        rows = moved(edge)
        while rows:
            shard, need = wanted.pop()
            sent = min(rows, need)
            out.append((*key, shard, sent))
            rows -= sent
            if need > sent:
                wanted.append((shard, need - sent))
    return out


def affected(plan: Iterable[tuple[int, int, int, int]]) -> set[int]:
    """The shards, old or new, whose files change."""
    return {s for old, _, new, _ in plan if old != new for s in (old, new)}


def reshard(docs: DataFrame, old_shard: Column, shards: int = SHARDS, carry: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot,
    grown_shard, old_shard. With ``carry`` also ``row``, all columns of ``docs``, for :func:`rewrite`."""
    whole = [F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")] if carry else []
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = F.octet_length(raw).cast("long") + 1
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            size.alias("size"),
            F.crc32(raw).alias("text_crc32"),
            old_shard.cast("int").alias("old_shard"),
            *whole,
        ).withColumn("class", F.floor(F.log2("size")).cast("int")),
        "reshard-sizes",
    )
    # One row for each shard and power of two.
    blocks = rows.groupBy("old_shard", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    plan = transfers({(r["old_shard"], r["class"]): (r["n"], r["bytes"]) for r in blocks.collect()}, shards)
    # Movers come first: the small rows of a block leave.
    plan.sort(key=lambda t: (t[0], t[1], t[0] == t[2], t[2]))
    spans, at = [], 0
    for n, (old, kind, new, count) in enumerate(plan):
        at = at if n and plan[n - 1][:2] == (old, kind) else 0
        spans.append((f"{old}:{kind}", at, at + count, new))
        at += count
    spark = docs.sparkSession
    fine = F.floor(F.col("size") / F.pow(F.lit(2.0), "class") * (CELLS // 16)) - CELLS // 16
    cell = (fine * 16 + F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(16))).cast("long")
    ranked = numbered(
        rows.withColumn("block", F.concat_ws(":", "old_shard", "class")), "block", cell, "rank"
    )
    # Blocks times shards rows at most.
    lookup = F.broadcast(spark.createDataFrame(spans, "block string, begin long, stop long, shard int"))
    inside = (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("stop"))
    placed = materialize(
        ranked.join(lookup, "block").where(inside).drop("block", "rank", "begin", "stop", "class"), "reshard-placed"
    )
    spread = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(CELLS))
    return numbered(placed, "shard", spread, "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
        *(["row"] if carry else []),
    )


def rewrite(placed: DataFrame, path: str) -> tuple[str, list[int]]:
    """Write the affected shards of ``reshard(..., carry=True)`` to ``path``, one folder ``shard=N`` each, rows in
    the order of their slots. Returns the name of the folders and the affected shards.

    Rows were carried along, so repeated ones are written as often as they are there. Files hold the columns of
    the documents; if one of them is called ``shard``, the folders take the name with underscores in front. Shards that
    are not affected keep their old files. A shard that is given up is among them without a folder.
    """
    placed = materialize(placed, "reshard-rows")
    moves = placed.where("old_shard <> shard")
    changed = sorted(
        {s for r in moves.select("old_shard", "shard").distinct().collect() for s in r}
    )
    columns = [f.name for f in placed.schema["row"].dataType.fields]
    folder = "shard"
    while folder.lower() in {c.lower() for c in columns}:
        folder = f"_{folder}"
    ordered = placed.where(F.col("shard").isin(changed)).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    out = ordered.select(*(F.col("row").getField(c).alias(c) for c in columns), F.col("shard").alias(folder))
    out.write.mode("overwrite").partitionBy(folder).parquet(path)
    return folder, changed


def by_source(source: Column, shards: int = OLD_SHARDS) -> Column:
    """An old layout that keeps a source together, and so is as uneven as the sources are."""
    return F.pmod(F.crc32(F.coalesce(source, F.lit("")).cast("binary")), F.lit(shards))
