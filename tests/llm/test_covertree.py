"""Cover trees against all pairs, and odd rows."""

import numpy as np
import pytest

from asterism.llm import covertree


def plain(rows, least):
    """(key, n_links, component, kept) by all pairs."""
    units = []
    for _, vector, label in rows:
        fine = vector is not None and len(vector) and label is not None and None not in vector
        array = np.array(vector, float) if fine else None
        units.append(array / np.linalg.norm(array) if fine and np.isfinite(array).all() and array.any() else None)
    n = len(rows)
    links = [[a != b and units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b])
              and units[a] @ units[b] >= least for b in range(n)] for a in range(n)]
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(n):
            if links[a][b]:
                parent[root(a)] = root(b)
    out = []
    for a in range(n):
        keys = [rows[b][0] for b in range(n) if root(b) == root(a) and rows[b][0] is not None]
        component = min(keys) if keys else None
        out.append((rows[a][0], sum(links[a]), component, rows[a][0] == component))
    return sorted(out, key=repr)


@pytest.fixture
def near(spark, rows):
    def run(data, kind="float", **how):
        df = spark.createDataFrame([(*row, "x", 7) for row in data], f"vec_id long, embedding array<{kind}>, label int, component_id string, `a.b` int")
        return rows(covertree.near_vectors(df, **how))

    return run


def clustered(n, dims, seed, spread):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((8, dims))
    vectors = centers[rng.integers(0, 8, n)] + spread * rng.standard_normal((n, dims))
    return [(int(i), [float(np.float32(x)) for x in v], int(rng.integers(0, 2))) for i, v in zip(rng.permutation(n), vectors)]


@pytest.mark.parametrize("spread,least", [(0.02, 0.98), (0.1, 0.98), (0.3, 0.9)])
def test_same_as_all_pairs_over_many_blocks(near, monkeypatch, spread, least):
    # Blocks of 16 vectors, so that most links are between two trees.
    monkeypatch.setattr(covertree, "BLOCK_VALUES", 1)
    data = clustered(150, 6, 3, spread)
    assert near(data, least=least) == plain(data, least)
    assert any(n > 0 for _, n, _, _ in plain(data, least))


def test_odd_rows(near):
    a, b = [1.0, 0.0, 0.01], [0.0, 1.0, 0.0]
    data = [
        (5, a, 0), (3, a, 0), (3, a, 0), (4, [2.0, 0.0, 0.02], 0), (6, a, 1), (7, a, None), (8, None, 0), (9, [], 0), (10, [0.0, 0.0, 0.0], 0),
        (11, [1.0, None, 0.0], 0), (12, [float("nan"), 1.0, 0.0], 0), (13, [float("inf"), 0.0, 0.0], 0), (None, b, 0), (None, b, 0), (14, [1.0, 0.0], 0),
        (None, a, 2), (2, [-0.0, 1.0, 0.0], 2), (1, [0.0, 1.0, -0.0], 2), (None, None, None),
    ]
    assert near(data, "double") == plain(data, 0.98)
    assert near([]) == []


def test_extreme_numbers(near):
    data = [(1, [1e300, 1e300], 0), (2, [1e-300, 1e-300], 0), (3, [5e-324, 0.0], 0), (4, [1.0, 0.0], 0)]
    # The plain version's norms overflow; 1 and 2 point one way, 3 and 4 another.
    assert near(data, "double") == [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False)]


def test_large_group_of_copies(near):
    data = [(i, [1.0, 2.0, 3.0], 0) for i in range(500)] + [(1000, [3.0, -1.0, 0.0], 0)]
    got = near(data)
    assert got[0] == (0, 499, 0, True) and (1000, 0, 1000, True) in got and len(got) == 501


def test_tree_is_nested_and_covers():
    rng = np.random.default_rng(5)
    vectors = covertree._units(rng.standard_normal((300, 5)))
    tree, order = covertree.cover_tree(np.arange(300), np.ones(300, np.int64), vectors)
    assert (tree.ids == order).all() and sorted(order) == list(range(300))
    for node in range(len(tree.radius)):
        own = tree.vectors[tree.start[node] : tree.end[node]]
        apart = covertree._apart(own @ tree.vectors[tree.center[node]])
        assert apart.max() <= tree.radius[node] + covertree.SLACK
        children = range(tree.first[node], tree.last[node])
        if len(children):
            assert tree.center[children[0]] == tree.center[node]
            within = 2.0 ** (np.ceil(np.log2(tree.radius[node])) - 1)
            assert max(tree.radius[c] for c in children) <= within < tree.radius[node] + covertree.SLACK
            assert tree.start[children[0]] == tree.start[node] and tree.end[children[-1]] == tree.end[node]
