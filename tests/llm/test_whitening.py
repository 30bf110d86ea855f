import math

import numpy as np
import pytest

from stationlake.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(vector):
    return vector and all(c is not None and math.isfinite(c) and abs(c) <= 2**30 for c in vector)


def expected(rows, k=4):
    """Eigenvectors of the covariance of the distinct rows, by a dense solver."""
    kept = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if usable(v)]
    distinct = np.array(sorted({x for _, x in kept}), dtype=np.int64)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for i, x in kept:
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        y = (np.array(x) - sums / n) @ vectors / np.sqrt(np.maximum(values, 1e-300))
        out.setdefault((i, deviation), []).append(y)
    total = np.trace(centred.T @ centred / n)
    return n, out, values, total


def check(table, rows, k=4, tolerance=1e-8, exact=True):
    found = whitening.whiten(table, components=k).collect()
    n, want, values, total = expected(rows, k)
    count = int((values > values[0] * 1e-12).sum()) if n > 1 else 0
    assert len(found) == count * sum(len(y) for y in want.values())
    got = {}
    for r in found:
        assert r.n == n and 1 <= r.component <= count and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / total, rel=1e-9)
        got.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    assert got.keys() == (want.keys() if count else set())
    if exact:
        for component in range(count):
            pairs = [(got[key][component + 1][0], want[key][0][component]) for key in got]
            mine, theirs = np.array(pairs).T
            sign = np.sign(mine @ theirs)
            assert np.abs(mine * sign - theirs).max() < tolerance * max(1, np.abs(theirs).max())
    return found


def make(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(map(lambda c: c if c is None else float(c), v)), 0) for i, v in rows], SCHEMA)


def test_given_embeddings(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    check(table, [(r.vec_id, r.embedding) for r in table.collect()])


def test_odd_rows_repeats_and_clashing_names(spark):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=5).astype(np.float32).tolist()) for i in range(60)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (None, rows[3][1])]
    rows += [(100 + k, rows[11][1]) for k in range(40)]  # many copies weigh once
    rows += [(200, None), (201, [1.0, None, 0, 0, 0]), (202, [math.nan] * 5), (203, [math.inf] + [0.0] * 4), (204, [0.0] * 5)]
    table = make(spark, rows).selectExpr("*", "1 as x", "2 as n", "'q' as component")
    check(table, rows)
    longer = make(spark, rows + [(300, [1.0, 2.0]), (301, []), (302, [1e35] * 5)])
    check(longer, rows)


def test_few_rows_or_directions(spark):
    check(make(spark, [(1, [1, 2, 3]), (2, [2, 2, 5]), (3, [0, 1, 1])]), [(1, [1, 2, 3]), (2, [2, 2, 5]), (3, [0, 1, 1])])
    rows = [(i, [i, 2 * i, 7.0]) for i in range(20)]  # one direction only
    assert {r.component for r in check(make(spark, rows), rows)} == {1}
    for rows in ([], [(1, [1, 2])], [(1, [1, 2]), (2, [1, 2])], [(1, None)], [(1, [])]):
        assert whitening.whiten(make(spark, rows)).count() == 0
    with pytest.raises(ValueError):
        whitening.whiten(make(spark, []), components=0)


def test_equal_variances(spark):
    """One start vector sees each eigenvalue once; the others of its kind must be found all the same."""
    rows = [(i, v) for i, v in enumerate([*np.eye(6).tolist(), *(-np.eye(6)).tolist()])]
    found = check(make(spark, rows), rows, exact=False)
    assert {r.component for r in found} == {1, 2, 3, 4}


def test_runs_that_stop_early_find_repeated_values(spark, monkeypatch):
    monkeypatch.setattr(whitening, "CONVERGED", 1e-9)
    monkeypatch.setattr(whitening, "CHECKED", 1)
    axes = np.diag([64, 64, 16, 8, 4, 2, 1, 0.5, 0.25, 0.25, 0.125, 0.125])
    rows = [(i, v) for i, v in enumerate([*axes.tolist(), *(-axes).tolist()])]
    found = check(make(spark, rows), rows, exact=False)
    values = sorted({(r.component, round(r.explained, 12)) for r in found})
    assert values[0][1] == values[1][1]


def test_large_means_lose_no_digits(spark):
    random = np.random.default_rng(2)
    rows = [(i, (1_000_000 + random.integers(-8, 9, size=6) / 8).tolist()) for i in range(80)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    check(table, rows)


def test_deviations_beyond_a_long():
    small = whitening._deviations(np.array([[1, 2], [3, 4]]), 2, [4, 6])
    assert small == [(2 - 4) ** 2 + (4 - 6) ** 2, (6 - 4) ** 2 + (8 - 6) ** 2]
    big = whitening._deviations(np.array([[1 << 31, 0], [0, 0]]), 2, [1 << 31, 0])
    assert big == [1 << 62, 1 << 62]
    assert whitening._deviations(np.array([[1 << 33]]), 3, [0]) == [None]
