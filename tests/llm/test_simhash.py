import numpy as np
import pytest
import xxhash

from stationlake.llm.simhash import budgets, one_of_each_group, simhash_groups, walk

SPACE = " \t\n\r\x0b\x0c"


def plain_fingerprint(text, shingle=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in SPACE else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(count)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > count)


def groups_by_force(codes, distance):
    """The smallest position reachable from each."""
    label = list(range(len(codes)))
    changed = True
    near = [[j for j in range(len(codes)) if (codes[i] ^ codes[j]).bit_count() <= distance] for i in range(len(codes))]
    while changed:
        changed = False
        for i, others in enumerate(near):
            low = min(label[j] for j in others)
            if low < label[i]:
                label[i], changed = low, True
    return label


def expected(rows, distance=4):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    codes = [plain_fingerprint(t) for _, t in rows]
    label = groups_by_force(codes, distance)
    return sorted(((rows[i][0], f"{codes[i]:016x}", rows[label[i]][0]) for i in range(len(rows))), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_given_documents(documents):
    table, rows = documents
    assert got(simhash_groups(table)) == expected(rows)


def test_odd_rows_and_empty_table(odd, frame):
    table, rows = odd
    assert got(simhash_groups(table)) == expected(rows)
    assert simhash_groups(frame([])).count() == 0
    with pytest.raises(ValueError):
        simhash_groups(table, distance=64)


def test_one_of_each_group(odd):
    table, rows = odd
    kept = one_of_each_group(table)
    assert kept.columns == table.columns
    want = {r[2] for r in expected(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


@pytest.mark.parametrize("distance", [0, 1, 3, 4, 7])
def test_walk_finds_all_components(distance):
    random = np.random.default_rng(distance)
    centres = random.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)
    codes = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(25):
            for b in random.integers(0, 64, random.integers(1, 9)):
                c ^= 1 << int(b)
            codes.add(c)
    codes = np.array(sorted(codes), dtype=np.uint64)
    zero = np.zeros(len(codes), dtype=np.int64)
    # From the root, without a first block: the whole distance is the budget of every depth.
    a, b = walk(codes, zero, zero > 0, zero > 0, 0, distance, np.full(64, distance))
    place = {int(c): k for k, c in enumerate(codes)}
    label = list(range(len(codes)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, y in zip(a.tolist(), b.tolist()):
        assert (x ^ y).bit_count() <= 64
        i, j = sorted((root(place[x]), root(place[y])))
        label[j] = i
    assert [root(i) for i in range(len(codes))] == groups_by_force([int(c) for c in codes], distance)


def test_budgets_follow_the_blocks():
    assert budgets(4, 0).tolist() == [0] * 13 + [1] * 13 + [2] * 13 + [3] * 13 + [4] * 12
    assert budgets(4, 4).tolist() == [0] * 12 + [1] * 13 + [2] * 13 + [3] * 13 + [4] * 13


def test_crowded_nodes_give_the_same_groups(frame, monkeypatch):
    from stationlake.llm import simhash

    base = " ".join(f"w{k}" for k in range(300)).split()
    rows = [(k, " ".join([*base[: k * 2], f"n{k}", *base[k * 2 + 1 :]])) for k in range(120)]
    monkeypatch.setattr(simhash, "NODE_LIMIT", 4)
    assert got(simhash_groups(frame(rows))) == expected(rows)
