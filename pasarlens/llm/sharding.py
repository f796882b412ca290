"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``2 ** cell_bits`` cells.  Every shard puts ``virtual_nodes`` points on it, and a
cell belongs to the first point clockwise.  Rows hash to cells by their id; one aggregate
counts the rows of each cell.  The loads of the cells (their number is a parameter, not a
matter of the data) are then settled on the driver: each shard takes its own cells in ring
order until it is full, and what overflows continues clockwise to the next shard that has
room.  The answer is a list of rank ranges per cell, which is joined back to the rows, so the
rows are shuffled once, by cell, and only with their id, size and checksum.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pasarlens.llm.common import stage


def ring_points(shards: int, virtual_nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    points = []
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = hashlib.sha256(f"{shard}/{node}".encode()).digest()
            points.append((int.from_bytes(digest[:8], "big"), shard))
    return [(point * cells >> 64, shard) for point, shard in sorted(points)]


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Room of each shard; without slack the rooms add up to ``total`` and differ by one at most."""
    if slack <= 0:
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [math.ceil((1 + slack) * total / shards)] * shards


def settle(
    loads: dict[int, int], shards: int, virtual_nodes: int, cells: int, slack: float
) -> list[tuple[int, int, int, int, int]]:
    """(cell, from_rank, to_rank, shard, first_slot) for all rows of all cells."""
    points = ring_points(shards, virtual_nodes, cells)
    at = [cell for cell, _ in points]
    room = capacities(sum(loads.values()), shards, slack)
    ranges: list[tuple[int, int, int, int]] = []
    overflow: list[tuple[int, int, int, int]] = []
    for cell in sorted(loads):
        k = bisect_left(at, cell) % len(points)
        owner = points[k][1]
        taken = min(room[owner], loads[cell])
        room[owner] -= taken
        if taken:
            ranges.append((cell, 0, taken, owner))
        if taken < loads[cell]:
            overflow.append((cell, taken, loads[cell], k))
    for cell, start, end, k in overflow:
        while start < end:  # rooms add up to the load at least, so this ends within one turn
            k = (k + 1) % len(points)
            owner = points[k][1]
            taken = min(room[owner], end - start)
            room[owner] -= taken
            if taken:
                ranges.append((cell, start, start + taken, owner))
            start += taken
    used = [0] * shards
    placed = []
    for cell, start, end, owner in sorted(ranges):
        placed.append((cell, start, end, owner, used[owner]))
        used[owner] += end - start
    return placed


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    virtual_nodes: int = 64,
    slack: float = 0.0,
    cell_bits: int = 13,
) -> DataFrame:
    """Shard and slot of every row: ``doc_id, size, text_crc32, shard, slot``.

    ``slack`` is how far a shard may exceed the mean number of rows; 0 fills all shards to the
    same count, give or take one.  A row's cell comes from its ``doc_id``, or from its text if
    that is null; a row without either has a cell of its own.  Size is the UTF-8 length of the
    text plus one (null: 0 plus one), its checksum that of the text (null: empty).  Slots of a
    shard run gapless from 0 in ring order.  Equal rows are interchangeable.  An empty table
    gives an empty result; columns other than ``doc_id`` and ``text`` are not looked at.
    """
    cells = 1 << cell_bits
    text = F.coalesce(docs["text"], F.lit(""))
    place = F.when(docs["doc_id"].isNotNull(), F.xxhash64(docs["doc_id"])).otherwise(F.xxhash64(docs["text"]))
    rows = stage(
        docs.select(
            docs["doc_id"],
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            place.alias("place"),
        ),
        "ring",
    ).withColumn("cell", F.shiftrightunsigned("place", 64 - cell_bits).cast("int"))
    loads = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}
    ranges = docs.sparkSession.createDataFrame(
        settle(loads, shards, virtual_nodes, cells, slack),
        "at int, from_rank long, to_rank long, shard int, first_slot long",
    )
    within = Window.partitionBy("cell").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("rank", (F.row_number().over(within) - 1).cast("long"))
    held = (F.col("cell") == F.col("at")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    return ranked.join(F.broadcast(ranges), held).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("rank") - F.col("from_rank")).alias("slot")
    )
