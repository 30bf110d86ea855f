import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm.passages import _candidates, _shards, remove_repeats, segments
from stationlake.llm.suffix import common_prefixes, suffix_array


def brute(rows, length=100):
    """Every row's bytes, spans and digest by looking each window up in those before."""
    order = sorted(
        range(len(rows)),
        key=lambda k: (rows[k][0] is None, rows[k][0] or 0, hashlib.sha256((rows[k][1] or "").encode()).hexdigest()),
    )
    seen, out = set(), []
    for k in order:
        data = (rows[k][1] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        rest = bytes(b for b, g in zip(data, gone) if not g)
        out.append((rows[k][0], len(data), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array_is_the_sorted_order(values):
    text = np.array([*values, 0])
    assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_suffix_array_sorts_small_alphabets_by_counting(monkeypatch):
    from stationlake.llm import suffix

    kinds, sort = [], suffix._slots
    monkeypatch.setattr(suffix, "_slots", lambda values, heads: kinds.append(values.dtype) or sort(values, heads))
    random = np.random.default_rng(2)
    for most in (258, 1 << 16, 1 << 33):
        text = np.append(random.integers(1, 5, 3000), 0)
        text[:2] = most, most - 1
        if most < 1 << 20:  # a bucket for each value
            assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix._narrow(most) == (np.uint16 if most < 1 << 16 else np.int32 if most < 1 << 31 else np.int64)
    assert set(kinds) == {np.dtype(np.uint16), np.dtype(np.int32)}


@pytest.mark.parametrize("unit, times", [(1, 900), (2, 400), (60, 30), (500, 3)])
def test_names_that_repeat_are_sorted_without_another_scan(monkeypatch, unit, times):
    from stationlake.llm import suffix

    scans, scan = [], suffix._scan
    monkeypatch.setattr(suffix, "_scan", lambda *a: scans.append(len(a[0])) or scan(*a))
    random = np.random.default_rng(unit)
    text = np.concatenate([np.tile(random.integers(1, 20, unit), times), random.integers(1, 3, 300), [0]])
    assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert scans == [len(text)] * 4


def test_common_prefixes():
    data = np.frombuffer(b"abracadabra abracadabra....................", dtype=np.uint8)
    order = suffix_array(np.append(data.astype(np.int64) + 1, 0))
    found = common_prefixes(data, order, np.arange(20), 16)
    rank = np.argsort(order)
    for i in range(20):
        if rank[i]:
            a, b = data[i:].tobytes(), data[order[rank[i] - 1] :].tobytes()
            assert found[i] == next((k for k in range(16) if a[k : k + 1] != b[k : k + 1]), 16)


def test_equal_windows_have_equal_anchors():
    random = np.random.default_rng(3)
    data = random.integers(97, 100, 600, dtype=np.uint8)
    data[400:] = data[100:300]
    _, first, n, route = segments(data, np.array([0]), np.array([501]), 100, 16)
    of = np.repeat(route, n)
    assert n.sum() == 501 and (of[400:501] == of[100:201]).all()


def test_only_windows_that_may_be_equal_are_candidates():
    random = np.random.default_rng(8)
    letters = lambda n: random.integers(97, 123, n, dtype=np.uint8).tobytes()
    found = equal = other = 0
    for _ in range(60):
        whole = letters(190)
        lo = int(random.integers(0, 100))
        part = whole[lo : lo + int(random.integers(60, 191 - lo))]
        texts = [letters(110) + whole + letters(110), letters(130) + part + letters(130)]
        bodies = []
        for text in texts:
            data = np.frombuffer(text, dtype=np.uint8)
            for _, first, n, route in zip(*segments(data, np.zeros(1, int), np.full(1, len(text) - 99), 100, 16)):
                bodies.append((int(route), text[first : first + n + 99], int(n)))
        data = np.frombuffer(b"".join(b + b"\0" for _, b, _ in bodies), dtype=np.uint8)
        n = np.array([x for *_, x in bodies])
        begin = np.cumsum(n + 100) - n - 100
        seen = [(route, body[k : k + 100]) for route, body, size in bodies for k in range(size)]
        again = {(s, k) for s, (route, body, size) in enumerate(bodies) for k in range(size) if seen.count((route, body[k : k + 100])) > 1}
        kept = {(s, k) for s, lo, size in zip(*_candidates(data, begin, n, 100)) for k in range(lo, lo + size)}
        assert again <= kept <= {(s, k) for s in range(len(n)) for k in range(n[s])}
        assert kept or len(part) < 100
        assert not kept or len(part) >= 93
        found, equal, other = found + len(kept), equal + len(again), other + int(n.sum())
    assert 0 < equal <= found < other / 2


def test_against_brute_force(documents):
    table, rows = documents
    assert result(remove_repeats(table, content=False)) == brute(rows)


def test_overlaps_long_texts_and_repeated_rows(frame):
    random = np.random.default_rng(5)
    base = "".join(map(chr, random.integers(97, 123, 900)))
    rows = [
        (5, base),
        (2, base[100:700] + "é" + base[300:500]),
        (9, "a" * 400),
        (9, "a" * 400),
        (9, base),
        (None, base[:150]),
        (11, base[:99]),
        (12, None),
        (13, base[:400] * 6000),
        (14, ""),
    ]
    assert result(remove_repeats(frame(rows))) == brute(rows)


def test_crowded_anchors_are_split(frame):
    random = np.random.default_rng(6)
    part = "".join(map(chr, random.integers(97, 123, 140)))
    rows = [(k, "".join(map(chr, random.integers(97, 123, 90))) + part[k % 7 :] + str(k) * 40) for k in range(60)]
    assert result(remove_repeats(frame(rows), crowded=3)) == brute(rows)


def test_string_in_very_many_documents(frame):
    random = np.random.default_rng(7)
    licence = "".join(map(chr, random.integers(97, 123, 64)))
    longer = "".join(map(chr, random.integers(97, 123, 150)))
    around = ["".join(map(chr, random.integers(97, 123, 60))) for _ in range(160)]
    rows = [(k, around[k] + (licence if k % 2 else longer) + around[(k * 7 + 1) % (80 if k % 3 else 160)]) for k in range(160)]
    assert result(remove_repeats(frame(rows), crowded=5)) == brute(rows)


@pytest.mark.parametrize("rows", [1, 100, 10_000, 30_000, 300_000])
def test_crowded_route_is_never_held_whole(rows):
    routes = np.sort(np.concatenate([np.repeat(5, rows), np.arange(-3000, 3000)]))
    batches = pa.table({"route": routes, "at": np.arange(len(routes))}).to_batches(max_chunksize=10_000)
    shards = list(_shards(iter(batches), 5_000))
    assert max(table.num_rows for table, _ in shards) <= 15_000
    assert sorted(x for table, _ in shards for x in table.column("at").to_pylist()) == list(range(len(routes)))
    whole = {r for table, kind in shards if kind for r in table.column("route").to_pylist()}
    split = {r for table, kind in shards if not kind for r in table.column("route").to_pylist()}
    assert not whole & split and split == ({5} if rows >= 5_000 else set())


def test_odd_rows_and_empty_table(odd, frame):
    table, rows = odd
    assert result(remove_repeats(table)) == brute(rows)
    assert remove_repeats(frame([])).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(table, length=10)
