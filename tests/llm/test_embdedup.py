import numpy as np
import pytest

from ledgerloom.llm import embdedup

from .plain import cosine_classes

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=1, groups=12, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        rows += [(centre + rng.standard_normal(dim) * rng.choice([0.05, 0.15, 0.3])).astype(np.float32).tolist() for _ in range(int(rng.integers(1, 25)))]
    rows += [rows[0]] * 5 + [[2 * x for x in rows[3]]]
    order = rng.permutation(len(rows))
    return [(int(i) * 2, rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("window", [3, 64])
def test_against_all_pairs(spark, window):
    rows = vectors() + [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] + [1.0] * 15), (905, [float("inf")] + [1.0] * 15), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embdedup.near_duplicates(df, window=window).collect()}
    want = cosine_classes(rows)
    assert set(got) == set(want)
    wanted = sum(n for n, _, _ in want.values())
    assert sum(n for n, _, _ in got.values()) >= 0.9 * wanted
    if window == 64:
        assert got == want


def test_dense_group_is_counted_whole(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(8)
    rows = [(i, (centre + 0.01 * rng.standard_normal(8)).astype(np.float32).tolist()) for i in range(300)]
    got = embdedup.near_duplicates(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), window=4).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(299, 0)}


def test_tiles_add_up(spark):
    rows = [(i, [1.0, 0.001 * i, 0.0]) for i in range(60)]
    members = spark.createDataFrame([(0, i, v, 1 + i % 2) for i, v in rows], "root long, id long, vec array<double>, copies long")
    got = {r.id: r.n for r in embdedup.link_counts(members, 0.95, tile=8).collect()}
    assert got == {i: 90 - (1 + i % 2) for i, _ in rows}


def test_odd_rows(spark):
    v = [1.0, 0.0]
    df = spark.createDataFrame([(None, v, 0), (4, v, 0), (4, v, 1), (9, v, None)], SCHEMA)
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in embdedup.near_duplicates(df).collect())
    assert got == [(-1, 0, -1, True), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False)]
    assert embdedup.near_duplicates(df.limit(0)).count() == 0


def test_passes_follow_the_size():
    assert embdedup.passes_for(10, 0.95, 64, 0.99) == 1
    assert embdedup.passes_for(10**6, 0.95, 64, 0.99) < embdedup.passes_for(10**9, 0.95, 64, 0.99)


def cone(n, close, pairs, dim=64, seed=4):
    """Vectors of which the first third are in one cone (cosine ``close`` to each other), with pairs at 0.951 all over."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[: n // 3] = np.sqrt(close) * np.eye(dim)[0] + np.sqrt(1 - close) * x[: n // 3]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    at = rng.permutation(n)[: 2 * pairs]
    for a, b in zip(at[:pairs], at[pairs:]):
        away = rng.standard_normal(dim)
        away -= (away @ x[a]) * x[a]
        x[b] = 0.951 * x[a] + np.sqrt(1 - 0.951**2) * away / np.linalg.norm(away)
    return x


def joined(found, x):
    """Share of the linked pairs that stand in one component: in the cone, outside it."""
    i, j = np.nonzero(np.triu(x @ x.T >= 0.95, 1))
    label = np.array([c for _, c in sorted((r.vec_id, r.component_id) for r in found)])
    inside = x[i, 0] > 0.6
    return (label[i] == label[j])[inside].mean(), (label[i] == label[j])[~inside].mean()


@pytest.mark.parametrize("close", [0.75, 0.85])
def test_pairs_in_a_crowded_cone(spark, monkeypatch, close):
    """By windows alone: no plan of any step compares all pairs."""
    plans, store = [], embdedup.stored

    def seen(df, tag):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, tag)

    monkeypatch.setattr(embdedup, "stored", seen)
    x = cone(1500, close, 600)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found = embdedup.near_duplicates(df, window=4)
    assert min(joined(found.collect(), x)) >= 0.98
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 10 and not any("CartesianProduct" in p or "NestedLoop" in p for p in plans)


def test_rounds_end_where_nothing_is_left_to_join(spark):
    """A crowd that no hash can part, far larger than the window."""
    rows = [(i, [1.0, 1e-9 * i, 0.0]) for i in range(500)] + [(1000 + i, [0.0, 1.0, 1e-9 * i]) for i in range(500)]
    got = embdedup.near_duplicates(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int"), window=3).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(499, 0), (499, 1000)}


def test_planes_go_through_the_middle(spark):
    x = cone(300, 0.8, 10)[:100]
    middle = embdedup.middle_of(spark.createDataFrame([(i, (3 * v).tolist()) for i, v in enumerate(x)] + [(200, [0.0, 2.0])], "id long, vec array<double>"))
    assert np.allclose(middle[64], x.mean(axis=0)) and np.allclose(middle[2], [0, 1])
