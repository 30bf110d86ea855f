import numpy as np
import pytest

from stationlake.llm.components import components, local_forest


def by_force(edges):
    label = {n: n for e in edges for n in e if None not in e and e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in label and b in label and label[a] != label[b] and a != b:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def graphs():
    random = np.random.default_rng(1)
    path = [(int(a), int(b)) for p in [random.permutation(200)] for a, b in zip(p[:-1], p[1:])]
    star = [(500, k) for k in range(501, 700)]
    sparse = [tuple(map(int, e)) for e in random.integers(1000, 1300, (200, 2))]
    return [[], path, star, sparse, path + star + sparse + [(5, 5), (None, 7), (8, None), (1, 2), (1, 2), (2, 1)]]


@pytest.mark.parametrize("edges", graphs(), ids=range(5))
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.component for r in found} == by_force(edges)


def test_local_forest():
    edges = [e for e in graphs()[4] if None not in e]
    a, b = (np.array(x) for x in zip(*edges))
    label = local_forest(a, b, 1300)
    want = by_force(edges)
    assert all(label[n] == want.get(n, n) for n in range(1300))
