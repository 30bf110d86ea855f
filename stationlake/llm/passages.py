"""Removal of every passage that also stands earlier in the corpus, byte by byte.

A string of ``length`` bytes is looked for wherever it starts. Each such window is dealt to one
shard by its anchor: the least hash of the short byte sequences inside it, so equal windows meet.
Windows of one anchor occurrence form one segment. Equal segments are one class: all but the first
hold only windows that start earlier, too. The first ones of all classes that share an anchor, less the
windows that differ from all others in the bytes around it, form the text of a shard; its suffix array
gives the windows that segments share in part. An anchor with very many classes is replaced by a longer one; where that has very many segments, too, its windows are
compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import last_group, numbered, slices, spans, starts_of_groups, written
from stationlake.llm.hashing import digests, mixed, rolling
from stationlake.llm.suffix import common_prefixes, suffix_array

#: Bytes of an anchor, and of the second one that splits an anchor with very many classes.
ANCHOR, SECOND_ANCHOR = 16, 64
CROWDED = 5_000
#: Bytes worked off at once; segments of a shard at least.
STRETCH = 1 << 20
SHARD_SEGMENTS = 4_000
_PLACE = 22  # bits for a place within a stretch
#: Places of the anchor in a window that are looked at together before the suffix array.
GRAIN = 8


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of the ``size`` values from each place on."""
    k = 1
    while 2 * k <= size:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[: len(x) - (size - k)], x[size - k :]) if size > k else x


def segments(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int, size: int):
    """The windows that start in [lo, hi) of each text in ``data``, as runs of starts with one anchor.

    Returns the number of the text, the first start and the number of starts of each run, and the
    hash of its anchor. ``data`` must hold ``length - 1`` bytes behind the last start.
    """
    if len(data) < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    place = np.uint64((1 << _PLACE) - 1)
    hashes = rolling(data, size)
    keys = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_least(keys, length - size + 1) & place).astype(np.int64)
    text = np.repeat(np.arange(len(lo)), hi - lo)
    start = spans(lo, hi - lo)
    runs = starts_of_groups([text, anchor[start]])
    first = start[runs]
    return text[runs], first, np.diff(np.append(runs, len(start))), hashes[anchor[first]].view(np.int64)


def _stretches(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Bytes, the texts' bounds of window starts in them, the rows, and the place of the bytes in a long text."""
    column = batch.column(batch.num_columns - 1)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    lo, hi = offsets[:-1].astype(np.int64), np.maximum(offsets[1:] - length + 1, offsets[:-1]).astype(np.int64)
    base, end = int(offsets[0]), int(offsets[-1])
    if end - base <= 2 * STRETCH:
        yield data[base:end], lo - base, hi - base, np.arange(len(lo)), 0
        return
    for row in range(len(lo)):  # only slices of one long text come here
        for at in range(int(lo[row]), int(hi[row]), STRETCH):
            stop = min(at + STRETCH, int(hi[row]))
            zero = np.zeros(1, dtype=np.int64)
            yield data[at : stop + length - 1], zero, zero + (stop - at), zero + row, at - int(lo[row])


def _runs(docs: DataFrame, length: int) -> DataFrame:
    """Segments of all texts: route, digest, ord, tie, span. The span has the first start and, in its low 16
    bits, the number of starts; its bits are turned for segments that repeat one before in the same
    stretch (their route is arbitrary, they need no further look)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, STRETCH):
            ids, ties = (batch.column(k).to_numpy() for k in (0, 1))
            for data, lo, hi, rows, shift in _stretches(batch, length):
                if not (hi > lo).any():
                    continue
                text, first, n, route = segments(data, lo, hi, length, ANCHOR)
                digest = digests(data, first, first + n + length - 1).view(np.int64)
                row, pos = rows[text], first - lo[text] + shift
                order = np.lexsort((pos, ties[row], ids[row], digest, route))
                repeated = np.zeros(len(order), dtype=bool)
                sorted_ = [route[order], digest[order]]
                repeated[order] = True
                repeated[order[starts_of_groups(sorted_)]] = False
                spread = np.where(repeated, mixed((pos + row).astype(np.uint64)).view(np.int64), route)
                span = pos << 16 | n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (spread, digest, ids[row], ties[row], np.where(repeated, ~span, span))],
                    ["route", "digest", "ord", "tie", "span"],
                )

    return docs.select("ord", "tie", "text").mapInArrow(
        work, "route long, digest long, ord long, tie long, span long"
    )


def _classes(runs: DataFrame, parts: int, crowded: int) -> DataFrame:
    """Segments to remove (kind 0), and the first of each class where an anchor has several (kind 1; 2 if
    it has very many)."""

    columns = ["route", "ord", "tie", "pos", "n", "kind"]

    def several(table: pa.Table) -> list[pa.RecordBatch]:
        """Of whole anchors' classes, those that have company."""
        edge = starts_of_groups([table.column("route").to_numpy()])
        classes = np.diff(np.append(edge, table.num_rows))
        classes = np.repeat(classes, classes)
        kind = pa.array(np.where(classes > crowded, 2, 1).astype(np.int32))
        kept = table.append_column("kind", kind).filter(pa.array(classes > 1))
        return kept.select(columns).combine_chunks().to_batches()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            route, digest, span = (batch.column(k).to_numpy() for k in (0, 1, 4))
            again = span < 0
            span = np.where(again, ~span, span)
            batch = pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in (0, 2, 3)), pa.array(span >> 16), pa.array(span & 0xFFFF)], columns[:5]
            )
            first = np.ones(len(route), dtype=bool)
            first[1:] = (route[1:] != route[:-1]) | (digest[1:] != digest[:-1]) | again[:-1]
            first[0] = before != (route[0], digest[0])
            first &= ~again  # a row that goes anyway is not the first of its class
            before = None if again[-1] else (route[-1], digest[-1])
            old = batch.filter(pa.array(~first))
            yield old.append_column("kind", pa.array(np.zeros(old.num_rows, dtype=np.int32))).select(columns)
            waiting.append(batch.filter(pa.array(first)))
            if sum(w.num_rows for w in waiting) >= 50_000:
                table = pa.Table.from_batches(waiting).combine_chunks()
                edge = last_group(table, ["route"])
                yield from several(table.slice(0, edge))
                waiting = table.slice(edge).to_batches()
        if sum(w.num_rows for w in waiting):
            yield from several(pa.Table.from_batches(waiting).combine_chunks())

    dealt = runs.repartition(parts, "route").sortWithinPartitions("route", "digest", "ord", "tie", "span")
    return dealt.mapInArrow(work, "route long, ord long, tie long, pos long, n long, kind int")


def _bytes_of(needed: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of the segments: route, ord, tie, pos, body."""
    wanted = needed.groupBy("ord", "tie").agg(F.collect_list(F.struct("route", "pos", "n", "kind")).alias("wanted"))
    joined = docs.join(wanted, ["ord", "tie"]).select("ord", "tie", "wanted", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for ord_, tie, wanted, text in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3).cast(pa.binary()).to_pylist()):
                for x in wanted:
                    body = text[x["pos"] : x["pos"] + x["n"] + length - 1]
                    if x["kind"] == 1:
                        found.append((x["route"], ord_, tie, x["pos"], body))
                        continue
                    data = np.frombuffer(body, dtype=np.uint8)
                    for _, first, n, route in zip(*segments(data, np.zeros(1, int), np.full(1, x["n"]), length, SECOND_ANCHOR)):
                        found.append((int(route), ord_, tie, x["pos"] + int(first), body[first : first + n + length - 1]))
            if found:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["route", "ord", "tie", "pos", "body"]
                )

    return joined.mapInArrow(work, "route long, ord long, tie long, pos long, body binary")


def _shards(batches: Iterator[pa.RecordBatch], crowded: int) -> Iterator[tuple[pa.Table, bool]]:
    """Whole routes, some thousand segments at a time, and True; of routes with over ``crowded`` segments
    parts as they come, and False. No more than a batch and ``crowded`` or SHARD_SEGMENTS rows are held."""

    def divided(table: pa.Table) -> Iterator[tuple[pa.Table, bool]]:
        edge = starts_of_groups([table.column("route").to_numpy()])
        count = np.diff(np.append(edge, table.num_rows))
        many = np.repeat(count > crowded, count)
        for mask, whole in ((~many, True), (many, False)):
            if mask.any():
                yield table.filter(pa.array(mask)).combine_chunks(), whole

    kept: list[pa.RecordBatch] = []
    rows, open_ = 0, None
    for batch in batches:
        if open_ is not None and batch.num_rows:
            own = int(np.searchsorted(batch.column("route").to_numpy(), open_, side="right"))
            if own:
                yield pa.Table.from_batches([batch.slice(0, own)]), False
            batch = batch.slice(own)
            open_ = None if batch.num_rows else open_
        if not batch.num_rows:
            continue
        kept.append(batch)
        rows += batch.num_rows
        if rows < SHARD_SEGMENTS:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        edge = last_group(table, ["route"])
        if edge:
            yield from divided(table.slice(0, edge))
            table = table.slice(edge)
        kept, rows = table.to_batches(), table.num_rows
        if rows > crowded:
            yield table, False
            kept, rows, open_ = [], 0, table.column("route")[0].as_py()
    if rows:
        yield from divided(pa.Table.from_batches(kept).combine_chunks())


def _candidates(data: np.ndarray, begin: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments in which a window may equal one of another segment, the first such window and the number up to
    the last one. The ``n`` windows of a segment, from ``begin`` on, have one anchor.

    Equal windows have it in the same place. So those with the anchor in one of GRAIN neighbouring places agree
    in all bytes that windows of these places have in common; where no other segment has these bytes, no window
    can be equal.
    """
    keys = rolling(data, ANCHOR) >> np.uint64(_PLACE)
    anchor = np.zeros(len(begin), dtype=np.int64)
    least = keys[begin]
    for k in range(1, length - ANCHOR + 1):
        key = keys[begin + k]
        lower = key < least
        least[lower] = key[lower]
        anchor[lower] = k
    low, high = (anchor - n + 1) // GRAIN, anchor // GRAIN
    segment = np.repeat(np.arange(len(begin)), high - low + 1)
    cell = spans(low, high - low + 1)
    common = begin[segment] + anchor[segment] - cell * GRAIN
    digest = digests(data, common, common + length - GRAIN + 1) + cell.astype(np.uint64)
    order = digest.argsort()
    equal = np.flatnonzero(digest[order[1:]] == digest[order[:-1]])
    met = np.zeros(len(digest), dtype=bool)
    met[order[equal]] = met[order[equal + 1]] = True
    met = np.flatnonzero(met)
    edge = starts_of_groups([segment[met]])
    found = segment[met[edge]]
    least, most = cell[met[edge]], cell[met[np.append(edge, len(met))[1:] - 1]]
    lo = np.maximum(anchor[found] - most * GRAIN - GRAIN + 1, 0)
    hi = np.minimum(anchor[found] - least * GRAIN, n[found] - 1)
    return found, lo, hi - lo + 1


def _shared(bodies: DataFrame, length: int, parts: int, crowded: int) -> DataFrame:
    """Runs of windows that also start earlier, from the suffix array of each shard: ord, tie, pos, n. Where
    a route is crowded, all its windows, with their digest and n = 0."""
    columns = ["ord", "tie", "pos", "n", "route", "digest"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, whole in _shards(batches, crowded):
            ids, ties, at = (table.column(k).to_numpy() for k in ("ord", "tie", "pos"))
            bodies = table.column("body").to_pylist()
            sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
            data = np.frombuffer(b"\0".join(bodies) + b"\0", dtype=np.uint8)
            begin = np.cumsum(sizes + 1) - sizes - 1
            if not whole:
                routes = table.column("route").to_numpy()
                for lo in range(0, len(bodies), 2_000):
                    part = slice(lo, lo + 2_000)
                    windows = spans(begin[part], sizes[part] - length + 1) - begin[lo]
                    owner = np.repeat(np.arange(len(bodies))[part], sizes[part] - length + 1)
                    own = data[begin[lo] : begin[owner[-1]] + sizes[owner[-1]]]
                    digest = digests(own, windows, windows + length).view(np.int64)
                    place = at[owner] + windows + begin[lo] - begin[owner]
                    none = np.zeros(len(owner), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (ids[owner], ties[owner], place, none, routes[owner], digest)], columns
                    )
                continue
            found, lo, n = _candidates(data, begin, sizes - length + 1, length)
            if not len(found):
                continue
            ids, ties, at, begin, sizes = ids[found], ties[found], at[found] + lo, begin[found] + lo, n + length - 1
            data = data[spans(begin, sizes + 1)]
            begin = np.cumsum(sizes + 1) - sizes - 1
            value = np.zeros(len(data) + 1, dtype=np.uint16)
            value[:-1] = data
            value[:-1] += 2
            value[begin + sizes] = 1  # between segments
            order = suffix_array(value)
            windows = spans(begin, n)
            owner = np.repeat(np.arange(len(n)), n)
            prefix = common_prefixes(data, order, windows, length)

            # Windows in suffix order; a new group where less than a whole window is shared. Their numbers are
            # in the order of the rows, as all that are equal have one route.
            number = np.full(len(order), -1, dtype=np.int64)
            number[windows] = np.arange(len(windows))
            by_rank = number[order]
            by_rank = by_rank[by_rank >= 0]
            place = at[owner] + windows - begin[owner]
            repeated = np.ones(len(windows), dtype=bool)
            edge = np.flatnonzero(np.append(True, prefix[by_rank[1:]] < length))
            repeated[np.minimum.reduceat(by_rank, edge)] = False
            hit = np.flatnonzero(repeated)
            if not len(hit):
                continue
            new = np.flatnonzero(np.append(True, (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])))
            n = np.diff(np.append(new, len(hit)))
            row = owner[hit[new]]
            none = np.zeros(len(row), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (ids[row], ties[row], place[hit[new]], n, none, none)], columns
            )

    dealt = bodies.repartition(parts, "route").sortWithinPartitions("route", "ord", "tie", "pos")
    return dealt.mapInArrow(work, "ord long, tie long, pos long, n long, route long, digest long")


def _later(windows: DataFrame, parts: int) -> DataFrame:
    """All but the first of equal windows, row by row in their order: ord, tie, pos, n."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            route, digest = (batch.column(k).to_numpy() for k in ("route", "digest"))
            first = np.ones(len(route), dtype=bool)
            first[1:] = (route[1:] != route[:-1]) | (digest[1:] != digest[:-1])
            first[0] = before != (route[0], digest[0])
            before = route[-1], digest[-1]
            old = batch.filter(pa.array(~first))
            one = pa.array(np.ones(old.num_rows, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*(old.column(k) for k in ("ord", "tie", "pos")), one], ["ord", "tie", "pos", "n"])

    dealt = windows.repartition(parts, "route", "digest").sortWithinPartitions("route", "digest", "ord", "tie", "pos")
    return dealt.mapInArrow(work, "ord long, tie long, pos long, n long")


def _kept(docs: DataFrame, removed: DataFrame, length: int, content: bool) -> DataFrame:
    """What is left of every document."""
    runs = removed.groupBy("ord", "tie").agg(F.collect_list(F.struct("pos", "n")).alias("runs"))
    joined = docs.join(runs, ["ord", "tie"], "left").select("doc_id", "runs", "text")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * content

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for runs, text in zip(batch.column(1), batch.column(2).cast(pa.binary()).to_pylist()):
                removed = parts = 0
                rest = text
                if runs.is_valid:
                    pos, n = (runs.values.field(k).to_numpy() for k in (0, 1))
                    edge = np.zeros(len(text) + 1, dtype=np.int64)
                    np.add.at(edge, pos, 1)
                    np.add.at(edge, pos + n + length - 1, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed = int(gone.sum())
                    parts = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    rest = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                found.append((len(text), removed, parts, hashlib.sha256(rest).hexdigest(), rest)[: 4 + content])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(work, schema + ", kept binary" * content)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 100,
    content: bool = True,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``content``, kept.

    A byte goes if a window of ``length`` bytes that covers it also starts earlier: in a document with
    a smaller doc_id, or earlier in the same one. Windows are judged on the input, may overlap, and
    never cross documents. ``n_spans`` counts the maximal runs of removed bytes, ``kept`` is what
    remains. A null text is empty. Null ids come after all others; rows with the same id are ordered
    by the SHA-256 of their text, and of equal rows one counts as the earlier. Other columns are not
    looked at; an empty table gives no rows.
    """
    if length < SECOND_ANCHOR:
        raise ValueError(f"length must be at least {SECOND_ANCHOR}")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = numbered(docs, id_col, text_col)
    classes = written(_classes(_runs(body, length), parts, crowded), "segments")
    partly = written(_shared(_bytes_of(classes.where("kind > 0"), body, length), length, parts, crowded), "shared")
    removed = classes.where("kind = 0").select("ord", "tie", "pos", "n")
    removed = removed.unionByName(partly.where("n > 0").select("ord", "tie", "pos", "n"))
    removed = removed.unionByName(_later(partly.where("n = 0"), parts))
    return _kept(body, removed, length, content)
