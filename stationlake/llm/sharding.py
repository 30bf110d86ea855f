"""Sharding by longest-processing-time scheduling.

Texts that are equal must share a shard. Scheduling every group of copies one after the other cannot
be spread over machines, so the items of the schedule are bundles: the groups whose text hash falls
into the same of ``BUNDLES`` buckets. Groups above 1/LARGE of all bytes, of which there are fewer than
LARGE, are items of their own. The number of items is therefore bounded whatever the input, and the
greatest bundle of small groups is a vanishing part of a shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stationlake.llm.common import texts, written

BUNDLES = 1 << 16
LARGE = 1 << 12
#: A group with an item of its own may hold a third of all rows: its rows are numbered in so many parts.
PARTS = 64


def longest_first(items: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Item -> shard: items from the largest to the smallest, each to the shard with the least load."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, item in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(loads)
        placed[item] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot.

    ``size`` is the UTF-8 bytes of the text plus 1; a null text has none and counts as equal to the
    empty one. ``slot`` numbers the rows of a shard from 0 without gaps, repeated rows separately. A
    null doc_id is kept. An empty table gives no rows, other columns are not looked at.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    body = F.coalesce("text", F.lit(""))
    rows = texts(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("key"),
    )
    rows = written(rows, "shard-rows")  # one pass over the texts; 28 bytes a row from here on
    total = rows.agg(F.sum("size")).first()[0] or 0
    large = [
        row.key
        for row in rows.groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > total // LARGE).collect()
    ]  # fewer than LARGE by arithmetic (sizes are positive)
    own = spark.createDataFrame([(key, BUNDLES + i) for i, key in enumerate(sorted(large))], "key long, item int")
    rows = rows.join(F.broadcast(own), "key", "left").select(
        "doc_id",
        "size",
        "text_crc32",
        F.coalesce("item", F.pmod("key", F.lit(BUNDLES)).cast("int")).alias("item"),
        _part(F.col("item")).alias("part"),
    )
    units = rows.groupBy("item", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    plan = spark.createDataFrame(_offsets(units, shards), "item int, part int, shard int, base long")
    order = Window.partitionBy("item", "part").orderBy("doc_id", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(order))
        .join(F.broadcast(plan), ["item", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place") - 1).alias("slot"))
    )


def _part(item: Column) -> Column:
    return F.when(item.isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))


def _offsets(units: list, shards: int) -> list[tuple[int, int, int, int]]:
    """The shard of each (item, part) and the number of rows before it there."""
    sizes: dict[int, int] = {}
    for unit in units:
        sizes[unit.item] = sizes.get(unit.item, 0) + unit.bytes
    placed = longest_first([(size, item) for item, size in sizes.items()], shards)
    filled = [0] * shards
    plan = []
    for unit in sorted(units, key=lambda u: (u.item, u.part)):
        shard = placed[unit.item]
        plan.append((unit.item, unit.part, shard, filled[shard]))
        filled[shard] += unit.n
    return plan
