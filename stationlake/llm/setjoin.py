"""Self-join of token sets by Jaccard similarity: candidates from keys, exact checks within components.

Units (lines, paragraphs) with the same set form one class and are represented by their first place.
A caller supplies the keys under which classes that may be similar meet. Entered with them are the
set's size, a bit map of its tokens and the position of the key. Under a key only links are found, and
only enough of them to connect what may be similar; the sets themselves are then read once for each class that has a
link, and all classes of a component are compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import grouped, slices, spans, starts_of_groups, text_bytes, with_marks, written
from stationlake.llm.components import components, local_forest
from stationlake.llm.hashing import mixed

#: Bytes of text whose sets are made at once; entries compared at once; classes of a block of pairs.
STRETCH = 1 << 20
ENTRIES = 1 << 16
BLOCK = 1 << 11
#: Rows of a key from which on they meet block by block, and rows of such a block; pairs met at once.
CROWD, PAIRS = 1 << 9, 1 << 17
#: Longest bit map, in 64 bits.
WIDEST = 64

#: From the texts of a batch: the tokens, each one's text and unit, in any order and with repeats.
Tokens = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


class Sets:
    """The distinct tokens of every unit of some texts, unit after unit."""

    def __init__(self, tokens: Tokens, texts: list[bytes]):
        token, text, unit = tokens(texts)  # units follow each other
        group = np.cumsum(_changes(text, unit)) - 1 if len(token) else token.astype(np.int64)
        order = sorted_in_groups(group, token)
        token, text, unit = token[order], text[order], unit[order]
        fresh = _changes(token, group)
        self.token, text, unit = token[fresh], text[fresh], unit[fresh]
        self.start = starts_of_groups([text, unit])
        self.size = np.diff(np.append(self.start, len(self.token)))
        self.text, self.unit = text[self.start], unit[self.start]
        if len(self.start):
            self.label = np.add.reduceat(mixed(self.token), self.start) + self.size.astype(np.uint64)
        else:
            self.label = np.zeros(0, dtype=np.uint64)
        self.label = mixed(self.label)

    def maps(self) -> pa.Array:
        """A bit map of each set, of 64 bits for up to 64 tokens and twice as many for each doubling.

        Each token turns one bit, so two sets differ in no fewer tokens than their maps in bits; the
        wider map is folded first.
        """
        width = np.ones(len(self.size), dtype=np.int64)
        while (wider := (self.size > 64 * width) & (width < WIDEST)).any():
            width[wider] *= 2
        at = np.cumsum(width) - width
        flat = np.zeros(int(width.sum()), dtype=np.uint64)
        place = np.repeat(at, self.size) + ((self.token >> np.uint64(6)).astype(np.int64) & np.repeat(width - 1, self.size))
        np.bitwise_xor.at(flat, place, np.uint64(1) << (self.token & np.uint64(63)))
        offsets = np.append(at, len(flat)).astype(np.int32) * 8
        return pa.Array.from_buffers(pa.binary(), len(width), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


class Maps:
    """Bit maps of rows, to be compared at the width of the narrower one."""

    def __init__(self, column: pa.Array, order: np.ndarray):
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
        self.start, self.width = offsets[:-1][order] // 8, np.diff(offsets)[order] // 8
        self.data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint64)
        self.narrow = self.folded(np.arange(len(order)), 1)[:, 0]

    def folded(self, rows: np.ndarray, wide: int) -> np.ndarray:
        """The maps of some rows, folded to a width that none of them is below."""
        out = np.zeros((len(rows), wide), dtype=np.uint64)
        width = self.width[rows]
        for own in np.unique(width):
            some = np.flatnonzero(width == own)
            whole = self.data[self.start[rows[some]][:, None] + np.arange(own)]
            out[some] = np.bitwise_xor.reduce(whole.reshape(len(some), own // wide, wide), axis=1)
        return out

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Differing bits of rows a and b. Wide maps are only looked at for pairs that come here."""
        common = np.minimum(self.width[a], self.width[b])
        out = np.zeros(len(a), dtype=np.int64)
        for wide in np.unique(common):
            at = np.flatnonzero(common == wide)
            out[at] = np.bitwise_count(self.folded(a[at], wide) ^ self.folded(b[at], wide)).sum(axis=1)
        return out


def _changes(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = False
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _shared(key: np.ndarray) -> np.ndarray:
    """The rows of keys that more than one row has; equal keys are together."""
    start = starts_of_groups([key])
    count = np.diff(np.append(start, len(key)))
    return np.flatnonzero(np.repeat(count > 1, count))


def sorted_in_groups(group: np.ndarray, *values: np.ndarray) -> np.ndarray:
    """The order by group and then by the values; groups are numbered in the order of the rows.

    One sort of a single number that has the group and the leading bits of the values; only where
    rows agree in it but not in the values is the order by all columns needed.
    """
    if not len(group):
        return np.zeros(0, dtype=np.int64)
    bits = max(1, int(group[-1]).bit_length())
    room = 64 - bits
    key = group.astype(np.uint64) << np.uint64(room)
    for k, value in enumerate(values):
        if k == len(values) - 1:
            key |= value >> np.uint64(64 - room)
        else:  # a small number before the last value
            size = max(1, int(value.max()).bit_length())
            if size > room - 16:
                return np.lexsort((*values[::-1], group))
            key |= value.astype(np.uint64) << np.uint64(room - size)
            room -= size
    order = key.argsort()
    ranked = key[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    if any((value[order[same]] != value[order[same + 1]]).any() for value in values):
        return np.lexsort((*values[::-1], group))
    return order


def least_shared(t: Fraction, a, b):
    """Tokens that sets of sizes ``a`` and ``b`` share at least if their similarity reaches ``t``."""
    return -(-t.numerator * (a + b) // (t.numerator + t.denominator))


def units(body: DataFrame, tokens: Tokens, counters: int = 0, stretch: int = STRETCH) -> DataFrame:
    """ord, tie, unit, size, label of every unit that has a token; equal sets have equal labels.

    With ``counters``, each task also counts the units of the tokens by their hash modulo that number:
    rows of tie -1 with the counter as ``ord`` and the count as ``size``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, dtype=np.int64)
        for batch in slices(batches, stretch):
            sets = Sets(tokens, text_bytes(batch.column(2)))
            if counters:
                at = (sets.token % np.uint64(counters)).astype(np.int64)
                total += np.bincount(at, minlength=counters)
            ids, ties = (batch.column(k).to_numpy()[sets.text] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (ids, ties, sets.unit, sets.size, sets.label.view(np.int64))],
                ["ord", "tie", "unit", "size", "label"],
            )
        at = np.flatnonzero(total)
        zero = np.zeros(len(at), dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (at, zero - 1, zero, total[at], zero)],
            ["ord", "tie", "unit", "size", "label"],
        )

    return body.select("ord", "tie", "text").mapInArrow(work, "ord long, tie long, unit long, size long, label long")


def entries(
    body: DataFrame, tokens: Tokens, keys: Callable[[Sets], tuple[np.ndarray, ...]], stretch: int = STRETCH
) -> DataFrame:
    """sizes, map, key, label: under which keys a set looks for similar ones.

    ``keys`` gives the key, the number of the set and the tokens of the set that come after that key.
    Sets that repeat within a stretch of text are entered once. The hashes come last, next to the bytes of
    the map: what is before them is much alike from row to row, and is packed well when rows are moved.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, stretch):
            sets = Sets(tokens, text_bytes(batch.column(2)))
            key, owner, rest = keys(sets)
            _, first = np.unique(sets.label, return_index=True)
            once = np.zeros(len(sets.label), dtype=bool)
            once[first] = True
            kept = once[owner]
            key, owner, rest = key[kept], owner[kept], rest[kept]
            packed = sets.size[owner] << 32 | np.minimum(rest, 0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays(
                [pa.array(packed), sets.maps().take(pa.array(owner)), *(pa.array(x.view(np.int64)) for x in (key, sets.label[owner]))],
                ["sizes", "map", "key", "label"],
            )

    return body.select("ord", "tie", "text").mapInArrow(work, "sizes long, map binary, key long, label long")


def candidates(found: DataFrame, t: Fraction, parts: int) -> DataFrame:
    """a, b: links among labels that meet under a key and may be similar, as a forest of each key's graph.

    Two sets may be similar if their sizes allow it, if the tokens before and after the key could
    still make up the share needed, and if their maps differ in no more bits than the sets may differ
    in tokens.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["key"], ENTRIES):
            columns = [table.column(k).to_numpy() for k in ("key", "label", "sizes")]
            rows = _shared(columns[0])  # most keys are met once
            rows = rows[np.lexsort([c[rows] for c in (columns[1], columns[2], columns[0])])]  # by key and size
            rows = rows[_changes(columns[0][rows], columns[1][rows])]
            rows = rows[_shared(columns[0][rows])]
            if not len(rows):
                continue
            key, label, sizes = (c[rows] for c in columns)
            maps = Maps(table.column("map").combine_chunks(), rows)
            start = starts_of_groups([key])
            count = np.diff(np.append(start, len(key)))
            a, b = _meeting(start, count, _Rows(sizes >> 32, sizes & 0xFFFFFFFF, maps, t))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(label[x]) for x in (a, b)], ["a", "b"])

    dealt = found.repartition(parts, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(work, "a long, b long")


class _Rows:
    """Size, tokens after the key, and map of the rows of some keys."""

    def __init__(self, size: np.ndarray, rest: np.ndarray, maps: Maps, t: Fraction):
        self.size, self.rest, self.maps, self.t = size, rest, maps, t

    def similar(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs that may be similar."""
        size, rest = self.size, self.rest
        shared = least_shared(self.t, size[a], size[b])
        before = np.minimum(size[a] - rest[a], size[b] - rest[b])  # the key itself included
        able = before + np.minimum(rest[a], rest[b]) >= shared
        able &= (np.minimum(size[a], size[b]) >= shared) & (a != b)
        a, b, most = a[able], b[able], (size[a] + size[b] - 2 * shared)[able]
        narrow = self.maps.narrow
        near = np.bitwise_count(narrow[a] ^ narrow[b]) <= most
        a, b, most = a[near], b[near], most[near]
        near = self.maps.differ(a, b) <= most
        return a[near], b[near]


def _meeting(start, count, rows: _Rows) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may be similar within groups, as a forest."""
    n = len(rows.size)
    label = np.arange(n)
    # A group is in the order of sizes: each member meets those before it that are not too small for it.
    group = np.repeat(np.arange(len(start)), count) << 32
    least = -(-rows.t.numerator * rows.size // rows.t.denominator)
    first = np.searchsorted(group + rows.size, group + least)
    small = (count > 1) & (count <= CROWD)
    left, right = [], []
    member = spans(start[small], count[small])
    member = member[first[member] < member]
    before = member - first[member]
    total = np.cumsum(before)
    lo = 0
    while lo < len(member):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] - before[lo] + PAIRS, side="right")))
        a, b = rows.similar(spans(first[member[lo:hi]], before[lo:hi]), np.repeat(member[lo:hi], before[lo:hi]))
        left.append(a)
        right.append(b)
        lo = hi
    if left:
        label = local_forest(np.concatenate(left), np.concatenate(right), n)
    for at, m in zip(start[count > CROWD].tolist(), count[count > CROWD].tolist()):
        label[at : at + m] = _crowd(at, m, first, rows)
    child = np.flatnonzero(label != np.arange(n))
    return label[child], child


def _crowd(at: int, m: int, first: np.ndarray, rows: _Rows) -> np.ndarray:
    """The forest of one crowded group, block against block; blocks joined already are passed over.

    ``first`` is the first row of its group that each row meets.
    """
    label = np.arange(m)
    for gap in range(0, m, CROWD):
        for lo in range(0, m - gap, CROWD):
            end = min(lo + CROWD, m)
            j = np.arange(lo + gap, min(lo + gap + CROWD, m))
            begin = np.maximum(first[at + j], at + lo)
            met = np.maximum(np.minimum(at + end, at + j) - begin, 0)
            if not met.any():
                continue
            if (label[lo:end] == label[lo]).all() and (label[j] == label[lo]).all():
                continue
            a, b = rows.similar(spans(begin, met), np.repeat(at + j, met))
            if len(a):
                kept = np.arange(m)
                label = local_forest(np.concatenate((a - at, kept)), np.concatenate((b - at, label)), m)
    return label + at


def classes(found: DataFrame) -> DataFrame:
    """label, size, n (units), first (place of the first unit) of every distinct set."""
    place = F.struct("ord", "tie", "unit")
    return found.groupBy("label").agg(
        F.min(place).alias("first"), F.first("size").alias("size"), F.count(F.lit(1)).alias("n")
    )


def sets_of(linked: DataFrame, body: DataFrame, tokens: Tokens, stretch: int = STRETCH) -> DataFrame:
    """component, blocks, label, ord, tie, unit, tokens (packed) of the classes in ``linked`` (component,
    blocks, label, first), read from their first unit."""
    wanted = (
        linked.select("component", "blocks", "label", "first.*")
        .groupBy("ord", "tie")
        .agg(F.collect_list(F.struct("unit", "label", "component", "blocks")).alias("wanted"))
    )
    wanted = written(wanted, "wanted")
    joined = with_marks(body, wanted, "ord").where("marked").join(wanted, ["ord", "tie"]).select("ord", "tie", "wanted", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["component", "blocks", "label", "ord", "tie", "unit", "tokens"]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in slices(batches, stretch):
            sets = Sets(tokens, text_bytes(batch.column(3)))
            at = {(t, u): k for k, (t, u) in enumerate(zip(sets.text.tolist(), sets.unit.tolist()))}
            found = []
            for text, (ord_, tie, wanted) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)))):
                for x in wanted:
                    k = at[text, x["unit"]]
                    body = sets.token[sets.start[k] : sets.start[k] + sets.size[k]].tobytes()
                    found.append((x["component"], x["blocks"], x["label"], ord_, tie, x["unit"], body))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    return joined.mapInArrow(
        work, "component long, blocks int, label long, ord long, tie long, unit long, tokens binary"
    )


def similar(
    found: DataFrame,
    body: DataFrame,
    tokens: Tokens,
    keys: Callable[[Sets], tuple[np.ndarray, ...]],
    threshold: float,
    forest_only: bool,
    stretch: int = STRETCH,
) -> tuple[DataFrame, DataFrame]:
    """The classes of the units ``found`` in ``body`` (ord, tie, text), and the links of similar classes.

    The links are, with ``forest_only``, enough pairs ``a, b`` to connect what is connected; else
    ``label, links, earliest``: the number of similar classes and the first place among them.
    """
    t = Fraction(threshold).limit_denominator(1000)
    parts = int(body.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = classes(found)
    graph = components(candidates(entries(body, tokens, keys, stretch), t, parts), "a", "b").withColumnRenamed("node", "label")
    # A component of many classes is compared in pairs of blocks; the number of blocks follows its size.
    graph = written(graph, "graph")
    blocks = graph.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    linked = first.join(graph.join(blocks, "component"), "label")
    sets = sets_of(linked, body, tokens, stretch)
    sets = sets.withColumn("own", F.pmod(F.xxhash64("label"), F.col("blocks")).cast("int"))
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = ["component", "lo", "hi"]
    dealt = sets.select(
        "component",
        F.least("own", "other").alias("lo"),
        F.greatest("own", "other").alias("hi"),
        "own",
        "label",
        "ord",
        "tie",
        "unit",
        "tokens",
    )
    dealt = dealt.repartition(parts, *group).sortWithinPartitions(*group)
    schema = "a long, b long" if forest_only else "label long, links long, ord long, tie long, unit long"
    checked = dealt.mapInArrow(_checker(t, group, forest_only), schema)
    if not forest_only:
        place = F.struct("ord", "tie", "unit")
        checked = checked.groupBy("label").agg(F.sum("links").alias("links"), F.min(place).alias("earliest"))
    return first, checked


def _checker(t: Fraction, group: list[str], forest_only: bool):
    def pairs(own: np.ndarray, lo: int, hi: int, tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Similar rows: within the block, or between the two blocks."""
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        value, code, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        common = count > 1
        place = np.cumsum(common) - 1
        row = np.repeat(np.arange(len(tokens)), sizes)
        kept = common[code]
        row, code, width = row[kept], place[code[kept]], int(common.sum())
        shared = np.zeros((len(tokens), len(tokens)), dtype=np.float32)
        for at in range(0, width, 4096):  # counts of shared tokens, some tokens at a time
            now = (code >= at) & (code < at + 4096)
            table = np.zeros((len(tokens), min(4096, width - at)), dtype=np.float32)
            table[row[now], code[now] - at] = 1
            shared += table @ table.T
        enough = least_shared(t, sizes[:, None], sizes[None, :])
        a, b = np.nonzero(np.triu(shared >= enough, 1))
        if lo != hi:
            across = own[a] != own[b]
            a, b = a[across], b[across]
        return a, b

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, group, BLOCK):
            label, own, lo, hi = (table.column(k).to_numpy() for k in ("label", "own", "lo", "hi"))
            packed = table.column("tokens").to_pylist()
            start = starts_of_groups([table.column(k).to_numpy() for k in group])
            left, right = [], []
            for at, end in zip(start, np.append(start[1:], len(label))):
                if end - at > 1:
                    tokens = [np.frombuffer(x, dtype=np.uint64) for x in packed[at:end]]
                    a, b = pairs(own[at:end], int(lo[at]), int(hi[at]), tokens)
                    left.append(a + at)
                    right.append(b + at)
            if not left:
                continue
            a, b = np.concatenate(left), np.concatenate(right)
            if forest_only:
                tree = local_forest(a, b, len(label))
                child = np.flatnonzero(tree != np.arange(len(label)))
                columns, names = (label[child], label[tree[child]]), ["a", "b"]
            else:
                places = [table.column(k).to_numpy() for k in ("ord", "tie", "unit")]
                columns, names = _links(label, places, a, b), ["label", "links", "ord", "tie", "unit"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return work


def _links(label, places, a, b):
    """For each row with a link: its label, the number of links, the first place among its partners."""
    one, other = np.concatenate((a, b)), np.concatenate((b, a))
    rank = np.empty(len(label), dtype=np.int64)
    by_place = np.lexsort(places[::-1])
    rank[by_place] = np.arange(len(label))
    order = np.lexsort((rank[other], one))
    one, other = one[order], other[order]
    start = starts_of_groups([one])
    links = np.diff(np.append(start, len(one)))
    earliest = other[start]
    return label[one[start]], links, *(p[earliest] for p in places)
