"""The bidiagonal solver and the whitening of a table, against numpy and exact integers."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, whitening

SMALL = "/root/testdata/sf0.001"


def check_axes(r, tolerance=1e-10):
    values, axes = whitening.principal_axes(r)
    exact = np.linalg.svd(r, compute_uv=False) ** 2
    top = max(exact[0], 1e-300)
    assert np.abs(values - exact).max() <= 1e-13 * top
    assert np.abs(axes.T @ axes - np.eye(len(axes))).max() < tolerance
    assert np.abs(r.T @ (r @ axes) - axes * values).max() < tolerance * top


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(0, 10**6), st.integers(0, 3))
def test_axes_of_random_triangles(d, seed, digits):
    a = np.random.default_rng(seed).standard_normal((d + 5, d))
    check_axes(np.linalg.qr(np.round(a, digits) if digits else a, mode="r"))


def test_axes_of_hard_triangles():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    equal = np.repeat([3.0, 2.0, 1.0], 10)
    check_axes(np.zeros((4, 4)))
    check_axes(np.eye(12))
    check_axes(np.diag(equal) @ turn)
    check_axes(np.diag(equal + 1e-9 * rng.standard_normal(30)) @ turn)
    check_axes(np.diag(10.0 ** -np.arange(30.0)) @ turn)
    check_axes(np.repeat(rng.standard_normal((5, 1)), 5, axis=1))
    check_axes(np.array([[-2.0]]))


def test_small_singular_values_are_accurate():
    """Entries of a bidiagonal matrix fix all its singular values, also those far below the largest."""
    diagonal, above = 10.0 ** -np.arange(0, 24, 2.0), 0.5 * 10.0 ** -np.arange(0, 22, 2.0)
    got = whitening.squared_singular_values(diagonal, above)
    exact = 1.0
    for x in diagonal:
        exact *= x**2
    assert np.isclose(np.prod(got), exact, rtol=1e-12, atol=0)


def covariance(x):
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums).astype(float) / n
    return centred, centred.T @ centred / n


def entries(vectors):
    return np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    x = entries([r.embedding for r in rows])
    centred, v = covariance(x)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:32], axes[:, ::-1][:, :32]
    out = queries.op12_whitening(spark, SMALL).toPandas()
    assert len(out) == 32 * len(rows)
    whitened = out.pivot(index="vec_id", columns="component", values="whitened").loc[[r.vec_id for r in rows]]
    wanted = centred @ axes / np.sqrt(values)
    signs = np.sign((whitened.to_numpy() * wanted).sum(axis=0))
    assert np.allclose(whitened.to_numpy() * signs, wanted, atol=1e-8)
    share = out.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(share, values / np.trace(v), rtol=1e-10)
    n, sums = len(x), x.sum(axis=0)
    deviation = {r.vec_id: sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for r, row in zip(rows, x)}
    assert out.drop_duplicates("vec_id").set_index("vec_id")["deviation"].to_dict() == deviation
    assert set(out["n"]) == {n} and out["identity_error"].nunique() == 1 and out["identity_error"][0] < 1e-10


NAN, INF = float("nan"), float("inf")
AWKWARD = [
    (1, [0.5, 1.5, -2.0]),
    (2, None),
    (3, [1.0, None, 2.0]),
    (4, [1.0, NAN, 2.0]),
    (5, [1.0, -INF, 2.0]),
    (6, []),
    (None, [0.25, 3.0, 1.0]),
    (7, [4.0, 1.0, 0.0]),
    (7, [4.0, 1.0, 0.0]),
    (8, [1.0, -1.0, 0.5]),
]


def test_awkward_vectors(spark):
    df = spark.createDataFrame(AWKWARD, "vec_id int, embedding array<double>")
    df = df.selectExpr("*", "'x' AS id", "1 AS n", "2 AS component", "'y' AS r", "3 AS at")
    model = whitening.fit(df)
    out = whitening.whiten(df, model).collect()
    usable = [v for _, v in AWKWARD if v and None not in v and np.isfinite(v).all()]
    assert len(out) == 3 * len(usable) and {r.n for r in out} == {len(usable)}
    assert sorted({r.vec_id for r in out if r.vec_id is not None}) == [1, 7, 8]
    w = np.array([r.whitened for r in out]).reshape(-1, 3)
    assert np.allclose(w.T @ w / len(usable), np.eye(3)) and out[0].identity_error < 1e-12
    assert whitening.whiten(df.where("false"), whitening.fit(df.where("false"))).isEmpty()
    assert whitening.whiten(df.where("vec_id < 7"), whitening.fit(df.where("vec_id = 1"))).isEmpty()
    # A flat dimension has no component.
    flat = df.where("vec_id IN (1, 7, 8)").selectExpr("vec_id", "array(embedding[0], 1D, embedding[2]) AS embedding")
    assert len(whitening.fit(flat).eigenvalues) == 2


def test_vectors_of_other_lengths_and_too_large_numbers_are_refused(spark):
    ragged = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id int, embedding array<double>")
    with pytest.raises(Exception, match="several lengths|vectors of"):
        whitening.fit(ragged.repartition(2))
    large = spark.createDataFrame([(1, [1e30]), (2, [1.0])], "vec_id int, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        whitening.fit(large)


def test_many_triangles_are_merged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet").repartition(40)
    x = entries([r.embedding for r in df.collect()])
    model = whitening.fit(df, components=64)
    values = np.linalg.eigvalsh(covariance(x)[1])[::-1]
    assert np.allclose(model.eigenvalues, values[: len(model.eigenvalues)], rtol=1e-9, atol=1e-9 * values[0])
