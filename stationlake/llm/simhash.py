"""SimHash fingerprints and near-duplicate groups by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import annotated, grouped, spans, starts_of_groups, text_bytes, texts, with_marks, written
from stationlake.llm.components import components, local_forest

BITS = 64
SEED = 42
#: A node of the trie with more fingerprints is handed out as pairs of the nodes below it.
NODE_LIMIT = 1 << 14
#: Fingerprints that a task walks at once, pairs of nodes in one step, words hashed at once.
WALK = 1 << 17
FRONTIER = 1 << 18
HASHED = 1 << 20


# --- fingerprints -----------------------------------------------------------------------------------


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits over the XXH64 of all word shingles of a text whose A-Z is lower case already."""
    words = text.split()  # on bytes: exactly blank and 0x09 - 0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    counts = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for k in range(0, n, HASHED):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[k : min(n, k + HASHED)], last[k : k + HASHED])])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8)).reshape(-1, BITS)
        counts += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int, text_col: str = "text") -> DataFrame:
    """``docs`` with ``fp``, 64 bits as a signed long."""

    def compute(column: pa.Array) -> list[pa.Array]:
        return [pa.array([fingerprint(text.lower(), shingle) for text in text_bytes(column)], pa.int64())]

    return annotated(docs, text_col, "fp long", compute)


# --- self-join --------------------------------------------------------------------------------------


def blocks(distance: int) -> list[int]:
    """Widths of ``distance + 1`` blocks of bits."""
    n = distance + 1
    return [BITS // n + (i < BITS % n) for i in range(n)]


def budgets(distance: int, turn: int) -> np.ndarray:
    """Differing bits allowed above each depth of the trie whose first block is block ``turn``.

    If two fingerprints differ in at most ``distance`` bits, there is a block from which on, going
    round, the first l blocks together differ in at most l - 1 bits, for every l. So one of the
    ``distance + 1`` rotated tries meets the pair with errors within this schedule.
    """
    widths = blocks(distance)
    widths = widths[turn:] + widths[:turn]
    return np.repeat(np.arange(distance + 1), widths)


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """a, b: enough pairs of fingerprints at ``distance`` or fewer differing bits to give all components.

    ``distinct`` has one row per fingerprint (``fp``). Each fingerprint goes to the node of its first
    block in every rotated trie. A node is walked in one task; a crowded one is first opened into the
    pairs of nodes some levels below it that the budget still allows, so no task gets a crowd whole.
    """
    widths = blocks(distance)
    offsets = [sum(widths[:i]) for i in range(len(widths))]
    turned = F.array(
        *(
            F.struct(F.lit(t).alias("turn"), F.lit(widths[t]).alias("width"), _rotated(offsets[t]).alias("bits"))
            for t in range(distance + 1)
        )
    )
    rows = distinct.select(F.explode(turned).alias("x")).select("x.*")
    rows = rows.withColumn("node", F.expr(f"shiftrightunsigned(bits, {BITS} - width)"))
    # At most (distance + 1) * 2**13 nodes exist, so this list is bounded.
    crowded = [
        (r.turn, r.node, min(12, max(1, int(np.ceil(np.log2(r.n / NODE_LIMIT))) + 2)))
        for r in rows.groupBy("turn", "node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > NODE_LIMIT).collect()
    ] if distance else []
    if crowded:
        table = distinct.sparkSession.createDataFrame(crowded, "turn int, node long, extra int")
        rows = rows.join(F.broadcast(table), ["turn", "node"], "left").fillna(0, ["extra"])
    else:
        rows = rows.withColumn("extra", F.lit(0))
    # Below the first block one differing bit is allowed: a node meets itself (side 0) and, for each
    # of the extra levels, the node that differs there; both meet under the number without that bit.
    rows = rows.withColumn("depth", F.col("width") + F.col("extra"))
    rows = rows.withColumn("below", F.expr(f"shiftrightunsigned(bits, {BITS} - depth)"))
    rows = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.col("extra"))))
    rows = rows.withColumn("mask", F.expr("case when level = 0 then 0L else shiftleft(1L, level - 1) end"))
    rows = rows.withColumn("meet", F.expr("below & ~mask")).withColumn("side", F.expr("(below & mask) != 0"))
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["turn", "depth", "level", "meet"]
    placed = rows.select(*keys, "side", "bits").repartition(parts, *keys).sortWithinPartitions(*keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, keys, WALK):
            columns = [table.column(k).to_numpy() for k in keys]
            side = table.column("side").to_numpy(zero_copy_only=False)
            bits = table.column("bits").to_numpy().view(np.uint64)
            cuts = [*starts_of_groups(columns[:2]), table.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                turn, depth = int(columns[0][lo]), int(columns[1][lo])
                group = np.zeros(hi - lo, dtype=np.int64)
                group[starts_of_groups([c[lo:hi] for c in columns])] = 1
                crossing = columns[2][lo:hi] > 0
                a, b = walk(bits[lo:hi], np.cumsum(group), crossing, side[lo:hi], depth, distance, budgets(distance, turn))
                back = np.uint64(offsets[turn])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_turn_right(x, back).view(np.int64)) for x in (a, b)], ["a", "b"]
                )

    return placed.mapInArrow(work, "a long, b long")


def _rotated(by: int):
    return F.col("fp") if not by else F.expr(f"shiftleft(fp, {by}) | shiftrightunsigned(fp, {BITS - by})")


def _turn_right(x: np.ndarray, by: np.uint64) -> np.ndarray:
    return x if not by else (x >> by) | (x << (np.uint64(BITS) - by))


def walk(bits, group, crossing, side, depth, distance, budget) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (a forest of them) among fingerprints that share a node pair at ``depth``.

    ``crossing`` marks groups that are two different nodes, its sides; the others are one node. A node
    of the trie is a range of the sorted fingerprints. Pairs of nodes are opened level by
    level; a pair is left when its differing bits exceed the budget of its depth, when both nodes
    lie wholly in one component found before, or, with few fingerprints, compared directly.
    """
    order = np.lexsort((bits, side, group))
    bits, group, side, crossing = bits[order], group[order], side[order], crossing[order]
    n = len(bits)
    label = np.arange(n)
    found_a, found_b, pending = [], [], 0
    ones: dict[int, np.ndarray] = {}

    starts = starts_of_groups([group, side])
    ends = np.append(starts[1:], n)
    met = np.flatnonzero(np.append(group[starts[1:]] == group[starts[:-1]], False))  # both sides are there
    own = np.flatnonzero(~crossing[starts])
    two_nodes = np.column_stack((starts[met], ends[met], starts[met + 1], ends[met + 1], np.ones(len(met), dtype=np.int64)))
    one_node = np.column_stack((starts[own], ends[own], starts[own], ends[own], np.zeros(len(own), dtype=np.int64)))
    stack = [(depth, p) for p in (two_nodes, one_node) if len(p)]
    changes = np.zeros(n + 1, dtype=np.int64)
    uniform = False

    while stack:
        d, pairs = stack.pop()
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            stack += [(d, pairs[:half]), (d, pairs[half:])]
            continue
        a0, a1, b0, b1, err = pairs.T
        keep = err <= (budget[d - 1] if d else distance)
        if uniform:
            one = (changes[a1 - 1] == changes[a0]) & (changes[b1 - 1] == changes[b0]) & (label[a0] == label[b0])
            keep &= ~one
        same = a0 == b0
        keep &= ~(same & (a1 - a0 < 2))
        small = keep & ((a1 - a0) * (b1 - b0) <= 64)
        if small.any():
            rows = pairs[small]
            na, nb = rows[:, 1] - rows[:, 0], rows[:, 3] - rows[:, 2]
            cell = spans(np.zeros(len(rows), dtype=np.int64), na * nb)
            width = np.repeat(nb, na * nb)
            i = np.repeat(rows[:, 0], na * nb) + cell // width
            j = np.repeat(rows[:, 2], na * nb) + cell % width
            hit = (i != j) & (np.bitwise_count(bits[i] ^ bits[j]) <= distance)
            if hit.any():
                found_a.append(i[hit])
                found_b.append(j[hit])
                pending += int(hit.sum())
        pairs = pairs[keep & ~small]
        if pending >= WALK or (pending and not uniform and len(pairs) > WALK // 4):
            label, changes = _merge(label, found_a, found_b)
            found_a, found_b, pending, uniform = [], [], 0, True
        if not len(pairs) or d >= BITS:
            continue
        if d not in ones:
            ones[d] = np.concatenate(([0], np.cumsum((bits >> np.uint64(BITS - 1 - d)) & np.uint64(1)))).astype(np.int32)
        a0, a1, b0, b1, err = pairs.T
        am, bm = a1 - (ones[d][a1] - ones[d][a0]), b1 - (ones[d][b1] - ones[d][b0])
        same = a0 == b0
        two = ~same
        kids = np.concatenate(
            (
                np.column_stack((a0, am, b0, bm, err)),
                np.column_stack((am, a1, bm, b1, err)),
                np.column_stack((a0, am, bm, b1, err + 1)),
                np.column_stack((am, a1, b0, bm, err + 1))[two],
            )
        )
        kids = kids[(kids[:, 1] > kids[:, 0]) & (kids[:, 3] > kids[:, 2]) & (kids[:, 4] <= budget[d])]
        if len(kids):
            stack.append((d + 1, kids))
    label, _ = _merge(label, found_a, found_b)
    child = np.flatnonzero(label != np.arange(n))
    return bits[child], bits[label[child]]


def _merge(label, found_a, found_b):
    if found_a:
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        kept = np.arange(len(label))
        label = local_forest(np.concatenate((a, kept)), np.concatenate((b, label)), len(label))
    changes = np.concatenate(([0], np.cumsum(label[1:] != label[:-1]), [0])) if len(label) else np.zeros(1, int)
    return label, changes


# --- operator ---------------------------------------------------------------------------------------


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Words are runs of characters other than blank and 0x09 - 0x0D, A-Z lower-cased. A text of fewer
    words than a shingle is one shingle; null and wordless texts have fingerprint zero and are linked
    like any other. ``component_id`` is the smallest doc_id that links of ``distance`` or fewer
    differing bits reach; rows with a null doc_id are linked too but never name a component (null if
    all its rows are so). Repeated rows come back repeated. An empty table gives no rows.
    """
    if shingle < 1 or not 0 <= distance < BITS:
        raise ValueError("shingle must be at least 1, distance from 0 to 63")
    marked = written(fingerprints(texts(docs, id_col, text_col), shingle).select("doc_id", "fp"), "fingerprints")
    named = _components(marked, distance)
    lowest = marked.groupBy("fp").agg(F.min("doc_id").alias("low")).join(named, "fp")
    lowest = lowest.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id (null ids last, equal rows once)."""
    row = F.struct(*(n for n in docs.columns if n != text_col)).alias("row")
    whole = docs.select(row, F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("number"))
    whole = written(fingerprints(whole, shingle), "fingerprints")  # the numbers of the rows are settled here
    rows = whole.select("number", F.col(f"row.`{id_col}`").cast("long").alias("doc_id"), "fp")
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), "number")
    least = rows.groupBy("fp").agg(F.min(order).alias("least")).join(_components(rows, distance), "fp")
    kept = written(least.groupBy("component").agg(F.min("least").getField("number").alias("number")), "kept")
    # Of the texts only those that may go are moved; most are the only ones of their group.
    whole = with_marks(whole, rows.select("number").join(kept, "number", "left_anti"), "number")
    columns = (F.col("text").alias(n) if n == text_col else F.col(f"row.`{n}`").alias(n) for n in docs.columns)
    columns = list(columns)
    single = whole.where(~F.col("marked")).select(*columns)
    return single.unionByName(whole.where("marked").join(kept, "number", "left_semi").select(*columns))


def _components(rows: DataFrame, distance: int) -> DataFrame:
    """fp, component (a fingerprint of the group) of every fingerprint."""
    distinct = rows.select("fp").distinct()
    labels = components(links(distinct, distance), "a", "b").withColumnRenamed("node", "fp")
    return distinct.join(labels, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))
