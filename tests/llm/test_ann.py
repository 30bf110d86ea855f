import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.ann import SPREAD, encode, estimate, nearest, rotation

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.StringType())]
)


def brute(rows, step, k):
    good = [
        (i, np.array(v, dtype=np.float64))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for i, v in good:
        if i % step:
            continue
        scores = []
        for j, w in good:
            if j != i and len(w) == len(v):
                cos = (v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))
                scores.append((-cos, j))
        out += [(i, r + 1, j, -c) for r, (c, j) in enumerate(sorted(scores)[:k])]
    return out


def run(spark, rows, step=5, k=5, **options):
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    found = nearest(table, F.col("vec_id") % step == 0, k=k, **options).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)


def same(found, want):
    assert [f[:3] for f in found] == [w[:3] for w in want]
    assert np.allclose([f[3] for f in found], [w[3] for w in want], rtol=1e-12)


def test_copies_ties_and_unusable_vectors(spark):
    random = np.random.default_rng(2)
    base = random.standard_normal((60, 16)).astype(np.float32)
    rows = [(k, base[k % 40].tolist() if k % 3 else base[7].tolist()) for k in range(200)]
    rows += [(200, None), (205, [0.0] * 16), (210, [float("nan")] * 16), (215, [None, 1.0]), (220, [float("inf"), 1.0])]
    rows += [(225, []), (230, [1.0, 2.0]), (None, base[3].tolist()), (235, (base[7] * 2).tolist())]
    found, want = run(spark, rows), sorted(brute(rows, 5, 5))
    same([f for f in found if f[0] != 235], [w for w in want if w[0] != 235])
    same(run(spark, rows, block=7), found)
    assert run(spark, []) == []


def test_recall_on_given_vectors(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.select("vec_id", "embedding").collect()]
    want = {(q, j) for q, _, j, _ in brute(rows, 50, 5)}
    found = nearest(table, F.col("vec_id") % 50 == 0).collect()
    assert len({(r.query_id, r.vec_id) for r in found} & want) >= 0.99 * len(want)


def test_estimates_keep_their_bounds():
    random = np.random.default_rng(4)
    vectors = random.standard_normal((500, 64))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turn = rotation(64)
    codes, scalars = encode(vectors, turn)
    assert codes.shape == (500, 8)
    guess, width = estimate(codes, scalars, unit[:20] @ turn, 3.0)
    off = np.abs(guess - unit[:20] @ unit.T) > width
    assert off.mean() < 0.005


def test_estimates_keep_the_bounds_in_use():
    random = np.random.default_rng(4)
    vectors = random.standard_normal((2_000, 64))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turn = rotation(64)
    codes, scalars = encode(vectors, turn)
    guess, width = estimate(codes, scalars, unit[:40] @ turn, SPREAD)
    off = np.abs(guess - unit[:40] @ unit.T) > width
    assert off.mean() < 0.07  # a normal error leaves 1.9 deviations in 5.7 % of cases


def test_recall_with_the_bounds_in_use(spark):
    random = np.random.default_rng(12)
    centres = random.standard_normal((30, 48))
    vectors = np.concatenate([random.standard_normal((1_500, 48)), centres[np.arange(1_500) % 30] + 0.3 * random.standard_normal((1_500, 48))])
    rows = [(k, v) for k, v in enumerate(vectors.astype(np.float32).tolist())]
    want = {(q, j) for q, _, j, _ in brute(rows, 50, 5)}
    assert len({(q, j) for q, _, j, _ in run(spark, rows, step=50)} & want) >= 0.99 * len(want)
