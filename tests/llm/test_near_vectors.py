"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from threadmill.llm import entries, neardup_vectors

SF = "/root/testdata/sf0.001"


def brute(rows, least=0.95):
    """{vec_id: (n_links, component_id, kept)} from all pairs of usable rows."""
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(np.array(v, dtype=float)).all() and np.any(np.array(v, dtype=float))]
    out = {i: (0, i, True) for i, _ in rows}
    u = np.stack([v / np.linalg.norm(v) for _, v in ok])
    ids = np.array([i for i, _ in ok])
    linked = u @ u.T >= least
    root = ids.copy()
    while True:
        new = np.array([root[row].min() for row in linked])
        if (new == root).all():
            break
        root = new
    out |= {int(i): (int(linked[n].sum()) - 1, int(root[n]), bool(i == root[n])) for n, i in enumerate(ids)}
    return out


def found(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def planted(n=1500, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    rows = list(rng.standard_normal((n, dim)))
    for i in range(0, 200, 4):
        rows[i + 1] = rows[i] + rng.standard_normal(dim) * 0.08 * np.linalg.norm(rows[i]) / np.sqrt(dim)
        rows[i + 2] = rows[i] * 3
    centre = rng.standard_normal(dim)
    for i in range(300, 800):  # a large group of different vectors
        rows[i] = centre + rng.standard_normal(dim) * 0.05 * np.linalg.norm(centre) / np.sqrt(dim)
    for i in range(900, 940):  # a chain
        t = (i - 900) * 0.25
        rows[i] = np.eye(dim)[0] * np.cos(t) + np.eye(dim)[1] * np.sin(t)
    return [(i, [float(x) for x in v]) for i, v in enumerate(np.array(rows, dtype=np.float32))]


@pytest.mark.parametrize("window,chunk", [(256, 4096), (16, 64)])
def test_planted_groups(spark, monkeypatch, window, chunk):
    monkeypatch.setattr(neardup_vectors, "CHUNK", chunk)
    rows = planted()
    got = found(neardup_vectors.near_groups(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), window=window))
    truth = brute(rows)
    assert got.keys() == truth.keys()
    right = sum(got[i] == truth[i] for i in truth)
    assert right >= 0.99 * len(truth)
    assert sum(g[0] for g in got.values()) >= 0.99 * sum(t[0] for t in truth.values())
    assert all(got[i][0] <= truth[i][0] for i in truth)  # no false link


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert found(entries.op12_sorted_projections(spark, SF)) == brute(rows)


def test_sketch_bounds_the_cosine():
    v = neardup_vectors.units(np.random.default_rng(2).standard_normal((50, 64)))
    codes, scale, off = neardup_vectors.sketch(v)
    near = (codes.astype(float) @ codes.T.astype(float)) * np.outer(scale, scale)
    assert (np.abs(near - v @ v.T) <= off[:, None] + off[None, :] + np.outer(off, off) + 1e-12).all()


def test_passes_grow_slowly():
    assert neardup_vectors.n_passes(100, 0.95) == 2
    assert neardup_vectors.n_passes(10**9, 0.95) < 60


def test_odd_inputs(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<float>, v int, id int, h1 int, n int, node int, kept int, root int, p int"
    some = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1e-30, 0.0]), (9, [3e38, 0.0]), (9, [3e38, 0.0]), (10, [1.0, 0.0, 0.0]), (None, [2.0, 0.0]), (12, [0.0, 1.0]), (13, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, *[0] * 8) for r in some], schema)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in neardup_vectors.near_groups(df).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, 12, 13)]
    group = [(7, 4, 7, True), (8, 4, 7, False), (9, 4, 7, False), (9, 4, 7, False), (None, 4, 7, False)]
    assert got == sorted(alone + group, key=repr)
    assert neardup_vectors.near_groups(df.limit(0)).count() == 0


def test_many_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(3000)] + [(3000, [3.0, -2.0, 1.0])]
    got = found(neardup_vectors.near_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert got == {**{i: (2999, 0, i == 0) for i in range(3000)}, 3000: (0, 3000, True)}
