import zlib

import pytest

from stationlake.llm.sharding import longest_first, shard_documents


def check(df, rows, shards=8):
    found = df.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in found) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = {}
    loads = [0] * shards
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    of = {}
    texts = {i: t for i, t in rows}
    for r in found:
        of.setdefault(texts[r.doc_id] or "", set()).add(r.shard)
    assert all(len(s) == 1 for s in of.values())
    return loads


def test_given_documents(documents):
    table, rows = documents
    loads = check(shard_documents(table), rows)
    largest = max(sum(len(t.encode()) + 1 for _, t in rows if t == x) for x in {t for _, t in rows})
    assert max(loads) <= max(largest, sum(loads) / 8 * 1.02)


def test_longest_first_is_greedy():
    placed = longest_first([(7, 0), (6, 1), (5, 2), (4, 3), (3, 4)], 2)
    assert placed == {0: 0, 1: 1, 2: 1, 3: 0, 4: 0} or placed == {0: 0, 1: 1, 2: 1, 3: 0, 4: 1}


def test_a_group_that_holds_a_third_of_the_rows(frame):
    rows = [(k, "same text") for k in range(300)] + [(k, f"text {k}" * (k % 7)) for k in range(300, 900)]
    check(shard_documents(frame(rows)), rows)


def test_odd_rows_and_empty_table(odd, frame):
    table, rows = odd
    check(shard_documents(table), rows)
    assert shard_documents(frame([])).count() == 0
    with pytest.raises(ValueError):
        shard_documents(table, shards=0)
