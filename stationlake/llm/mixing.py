"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

The documents of a source, in an order drawn from the seed, form one stream of words that is cut into
blocks of equal length. Seats of the mix are blocks: a source whose target is ``v`` blocks offers the
quotients v/1, v/3, v/5, ..., and all quotients of at least 1/2 win a seat, the highest first. Seat k
(from 0) has the quotient v/(2k + 1), so a source has won floor(f * v + 1/2) seats when the awards have
come through the fraction ``f`` of its quotients. That makes the quota of every shard of a stream (a run
of blocks) an integer by arithmetic alone, and the quotas of a source add up to its seats.

Within a shard of ``c`` blocks and a quota of ``q`` the seed sets a start ``u``, and block ``i`` is taken
floor((i + u + 1) * q / c) - floor((i + u) * q / c) times: every block equally often or once more, q in all.
How many words of a document are taken follows from where it begins and ends; no block is ever a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stationlake.llm.common import written

#: Longest block in words; a source of fewer than LEAST_BLOCKS such blocks is cut into shorter ones.
BLOCK_WORDS = 256
LEAST_BLOCKS = 1_000
#: Blocks of one shard of a stream.
SHARD_BLOCKS = 64
#: Equal rows are counted in so many parts, and a running sum sees about so many groups of rows.
PARTS = 256
GROUPS_PER_TASK = 4_096
#: Runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def _drawn(*parts: str | Column) -> Column:
    """32 bits of the SHA-256 of the parts, joined by colons, as hexadecimal digits before all others."""
    return F.sha2(F.concat_ws(":", *parts), 256)


def _first_bits(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def ranked(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the rank (from 0) of distinct values in code point order, null last, in ranges of their own."""
    order = F.col(column).asc_nulls_last()
    dealt = df.repartitionByRange(order).withColumn("range", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    counts = dealt.groupBy("range").count().orderBy("range").collect()  # one row a shuffle partition
    bases, total = [], 0
    for row in counts:
        bases.append((row["range"], total))
        total += row["count"]
    base = df.sparkSession.createDataFrame(bases, "range int, base long")
    place = F.row_number().over(Window.partitionBy("range").orderBy(order))
    return dealt.withColumn("place", place).join(F.broadcast(base), "range").withColumn(
        name, F.col("base") + F.col("place") - 1
    ).drop("range", "place", "base")


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size, part and the number of such rows; the only pass over the texts."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).alias("part"),
    )
    return written(rows.groupBy("doc_id", "source", "size", "part").agg(F.count(F.lit(1)).alias("copies")), "mix-sizes")


def with_targets(sources: DataFrame, ceiling: int) -> DataFrame:
    """``sources`` (words, weight) with ``target``: shares by weight of all words, at most ``ceiling`` times the own.

    What the sources above their ceiling leave is shared again by weight until none is above. Only the
    words per unit of weight pass through the driver, once a round.
    """
    full, most = F.col("words") * ceiling, F.col("weight")
    totals = sources.agg(F.sum("words").alias("words"), F.sum(most).alias("weight")).first()
    words, state = totals.words or 0, (0, totals.weight or 1)
    while True:
        level = (words - state[0]) / state[1]
        above = full < F.lit(level) * most
        found = sources.agg(F.sum(F.when(above, full)).alias("full"), F.sum(F.when(~above, most)).alias("left")).first()
        now = (found["full"] or 0, found["left"] or 1)
        if now == state:
            return sources.withColumn("target", F.when(above, full.cast("double")).otherwise(F.lit(level) * most))
        state = now


def with_blocks(sources: DataFrame, block_words: int, least_blocks: int) -> DataFrame:
    """``sources`` with the words of a block and ``seats``, what the highest quotients give each source."""
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.expr(f"words div {least_blocks}"))).cast("long")
    return sources.withColumn("block", block).withColumn("rate", F.col("target") / F.greatest("words", F.lit(1))).withColumn(
        "seats", _won(F.col("words"))
    )


def _won(words: Column) -> Column:
    """Seats that a source has won with the first ``words`` words of its stream."""
    return F.floor(F.col("rate") * (words / F.col("block")) + F.lit(0.5)).cast("long")


def _shard(shard: Column, shard_blocks: int) -> tuple[Column, Column, Column]:
    """Seats won before a shard, its blocks and its quota."""
    lo = shard * F.col("block") * shard_blocks
    hi = F.least(F.col("words"), lo + F.col("block") * shard_blocks)
    before = _won(lo)
    blocks = F.ceil((hi - lo) / F.col("block")).cast("long")
    return before, blocks, _won(hi) - before


def quotas(sources: DataFrame, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """source, shard, blocks, quota: how many blocks each shard of a source's stream gives to the mix."""
    last = F.expr(f"(words - 1) div (block * {shard_blocks})")
    shards = sources.where("words > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("shard"))
    _, blocks, quota = _shard(F.col("shard"), shard_blocks)
    return shards.select("source", "shard", blocks.alias("blocks"), quota.alias("quota"))


def _whole(numerator: Column, denominator: Column) -> Column:
    """Whole quotient of numbers that are not negative, exact for longs; nothing by nothing is 0."""
    return F.call_function("div", numerator, F.greatest(denominator, F.lit(1)))


def _taken_before(df: DataFrame, place: str, name: str, shard_blocks: int, seed: int) -> DataFrame:
    """``df`` with the words taken from the first ``place`` words of the stream of its source."""
    last = F.greatest(F.col(place) - 1, F.lit(0))  # the word before the place lies in the block that counts
    df = df.withColumn("i", _whole(last, F.col("block")))
    df = df.withColumn("shard", _whole(F.col("i"), F.lit(shard_blocks)))
    before, blocks, quota = _shard(F.col("shard"), shard_blocks)
    df = df.withColumns({"before": before, "blocks": blocks, "quota": quota})
    start = _first_bits(_drawn(F.lit(str(seed)), F.col("rank").cast("string"), F.col("shard").cast("string")))
    df = df.withColumn("u", F.pmod(start, F.greatest("blocks", F.lit(1))))
    within = F.col("i") - F.col("shard") * shard_blocks + F.col("u")
    to, after = (_whole(x * F.col("quota"), F.col("blocks")) for x in (within, within + 1))
    first = _whole(F.col("u") * F.col("quota"), F.col("blocks"))
    part = F.col(place) - F.col("i") * F.col("block")
    taken = (F.col("before") + to - first) * F.col("block") + part * (after - to)
    return df.withColumn(name, F.when(F.col(place) > 0, taken).otherwise(0)).drop(
        "i", "shard", "before", "blocks", "quota", "u"
    )


def source_table(
    groups: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    ceiling: int = 3,
    block_words: int = BLOCK_WORDS,
    least_blocks: int = LEAST_BLOCKS,
) -> DataFrame:
    """source, words, rank, weight, target, block, rate, seats of every source of ``sizes``."""
    totals = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    sources = ranked(totals, "source", "rank")
    cycle = F.array(*(F.lit(int(w)).cast("long") for w in weights))
    sources = sources.withColumn("weight", F.element_at(cycle, (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")))
    return with_blocks(with_targets(written(sources, "sources"), ceiling), block_words, least_blocks)


def mix_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    ceiling: int = 3,
    seed: int = 42,
    block_words: int = BLOCK_WORDS,
    least_blocks: int = LEAST_BLOCKS,
    shard_blocks: int = SHARD_BLOCKS,
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken, first_word, block.

    ``size`` is the words of the text (null: 0), ``target`` the words the mix wants of the source,
    ``taken`` the words of this document in it, repeats counted. Sources by code point, null last as a
    source of its own, have the given weights in turn. A source misses its target by less than
    ``ceiling`` + 1 blocks; no block, so no word, is taken more than ``ceiling`` times. ``first_word`` is where the document begins in
    the stream of its source; ``taken_spans`` cuts it by that. Rows equal in id, source and size are
    interchangeable; null ids are kept; documents without words take nothing; an empty table gives no
    rows; other columns are not looked at. Reruns agree, however the input is split.
    """
    if not weights or min(weights) < 1 or ceiling < 1 or min(block_words, least_blocks, shard_blocks) < 1:
        raise ValueError("weights, ceiling, block_words, least_blocks and shard_blocks must be at least 1")
    groups = sizes(docs, id_col, text_col, source_col)
    sources = written(source_table(groups, weights, ceiling, block_words, least_blocks), "source-targets")
    bits = min(31, max(0, (groups.count() // GROUPS_PER_TASK).bit_length()))
    key = _drawn(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    named = groups.join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    named = named.withColumn("key", key).withColumn("bucket", F.shiftright(_first_bits(F.col("key")), 32 - bits))

    # Where each group of equal rows begins: words of earlier buckets, and of earlier groups in its own.
    weight = F.col("size") * F.col("copies")
    totals = named.groupBy("rank", "bucket").agg(F.sum(weight).alias("own"))
    earlier = F.sum("own").over(Window.partitionBy("rank").orderBy("bucket")) - F.col("own")
    bases = totals.select("rank", "bucket", earlier.alias("base"))
    order = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "size", "part")
    inner = F.sum(weight).over(order.rowsBetween(Window.unboundedPreceding, 0)) - weight
    placed = named.withColumn("inner", inner).join(bases, ["rank", "bucket"])
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    placed = placed.select("*", copy).withColumn("lo", F.col("base") + F.col("inner") + F.col("copy") * F.col("size"))
    placed = placed.withColumn("hi", F.col("lo") + F.col("size"))
    placed = _taken_before(placed, "lo", "to_lo", shard_blocks, seed)
    placed = _taken_before(placed, "hi", "to_hi", shard_blocks, seed)
    return placed.select(
        "doc_id",
        "source",
        "size",
        F.col("words").alias("source_size"),
        "target",
        (F.col("to_hi") - F.col("to_lo")).alias("taken"),
        F.col("lo").alias("first_word"),
        "block",
        "rank",
        "rate",
    )


def taken_spans(mix: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = 42) -> DataFrame:
    """The blocks of ``mix_documents`` as word ranges: doc_id, source, start, stop, times; one row a block taken."""
    last = _whole(F.col("first_word") + F.col("size") - 1, F.col("block"))
    block = F.sequence(_whole(F.col("first_word"), F.col("block")), last)
    rows = mix.where("size > 0").withColumn("words", F.col("source_size")).select("*", F.explode(block).alias("n"))
    lo, hi = F.col("n") * F.col("block"), (F.col("n") + 1) * F.col("block")
    rows = rows.withColumn("a", F.greatest(lo, "first_word")).withColumn("b", F.least(hi, F.col("first_word") + F.col("size")))
    rows = _taken_before(_taken_before(rows, "a", "to_a", shard_blocks, seed), "b", "to_b", shard_blocks, seed)
    times = _whole(F.col("to_b") - F.col("to_a"), F.col("b") - F.col("a"))
    start, stop = (F.col(n) - F.col("first_word") for n in ("a", "b"))
    found = rows.select("doc_id", "source", start.alias("start"), stop.alias("stop"), times.alias("times"))
    return found.where("times > 0")
