"""Whitening against a plain eigendecomposition, exact integers included."""

import numpy as np
import pytest

from packedts.llm.whitening import _rounds, op12_whitening, orthogonal_columns, pivoted_cholesky, principal, whiten

SCHEMA = "vec_id long, embedding array<double>, component string, n string, whitened string"


def plain(vectors, k):
    """x, deviations, whitened values up to sign, and shares, by numpy alone."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[float(a * n - s) / n for a, s in zip(row, sums)] for row in x])
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1][:k], components[:, ::-1][:, :k]
    return deviation, centred @ components / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def agree(found, ids, vectors, k):
    deviation, whitened, explained = plain(vectors, k)
    table = {(r.vec_id, r.component): r for r in found}
    assert len(found) == len(table) == len(ids) * k
    mine = np.array([[table[i, j + 1].whitened for j in range(k)] for i in ids])
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.allclose(mine, whitened * signs, atol=1e-8)
    assert [table[i, 1].deviation for i in ids] == deviation
    assert np.allclose([table[ids[0], j + 1].explained for j in range(k)], explained, rtol=1e-9)
    assert {r.n for r in found} == {len(vectors)}
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


@pytest.mark.parametrize("d", [1, 2, 5, 8])
def test_every_pair_of_columns_meets_once(d):
    pairs = [(int(a), int(b)) for p, q in _rounds(d) for a, b in zip(p, q)]
    assert sorted(pairs) == [(a, b) for a in range(d) for b in range(a + 1, d)]
    for p, q in _rounds(d):
        assert len({*p, *q}) == 2 * len(p)


@pytest.mark.parametrize("rank", [0, 1, 4, 9])
def test_factor_and_eigenvalues(rank):
    rng = np.random.default_rng(rank)
    b = rng.normal(size=(9, rank)) * 10.0 ** rng.integers(-3, 3, rank)
    a = b @ b.T
    order, factor = pivoted_cholesky(a)
    assert factor.shape[1] == rank
    assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], atol=1e-12 * max(1, np.abs(a).max()))
    assert (np.abs(np.triu(factor, 1)) == 0).all()
    turned = orthogonal_columns(factor)
    gram = turned.T @ turned
    assert np.allclose(gram, np.diag(np.diag(gram)), atol=1e-12 * max(1, np.abs(gram).max(initial=0)))
    values, vectors = principal(a)
    expected = np.linalg.eigvalsh(a)[::-1][:rank]
    assert np.allclose(values, expected, rtol=1e-6) and (np.diff(values) <= 0).all()
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-9)


def test_small_eigenvalues_keep_their_digits():
    q, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(6, 6)))
    scale = np.diag(10.0 ** -np.arange(6))
    a = scale @ (q @ np.diag([1.0, 2, 3, 4, 5, 6]) @ q.T) @ scale  # graded
    values, _ = principal(a)
    g = np.linalg.cholesky(a)
    assert np.allclose(np.sqrt(values), np.linalg.svd(g, compute_uv=False), rtol=1e-8)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    return (rng.normal(size=(90, 6)) @ rng.normal(size=(6, 6)) + 3).tolist()


def test_all_rows_count(spark, vectors):
    held = [*vectors, vectors[3], vectors[3]]
    ids = [*range(90), 90, 91]
    rows = [(i, v, "c", "n", "w") for i, v in zip(ids, held)]
    odd = [None, [1.0, None, 2.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf"), *[0.0] * 5], [1e30, *[0.0] * 5]]
    rows += [(200 + k, v, "c", "n", "w") for k, v in enumerate(odd)]
    found = whiten(spark.createDataFrame(rows, SCHEMA).repartition(4), 5).collect()
    agree(found, ids, held, 5)


def test_shorter_vectors_are_continued_by_zeros(spark, vectors):
    held = [v[: 3 + k % 4] for k, v in enumerate(vectors)]
    found = whiten(spark.createDataFrame([(k, v, "", "", "") for k, v in enumerate(held)], SCHEMA), 4).collect()
    agree(found, list(range(90)), [v + [0.0] * (6 - len(v)) for v in held], 4)


def test_repeated_rows_and_null_ids_are_returned_each(spark, vectors):
    rows = [(k, v, "", "", "") for k, v in enumerate(vectors)] * 2 + [(None, vectors[0], "", "", "")]
    found = whiten(spark.createDataFrame(rows, SCHEMA), 2).collect()
    assert len(found) == 2 * 181 and sum(r.vec_id is None for r in found) == 2 and {r.n for r in found} == {181}


def test_directions_without_variance_are_left_out(spark, vectors):
    flat = [[v[0], v[1], v[0], 5.0] for v in vectors]
    found = whiten(spark.createDataFrame([(k, v, "", "", "") for k, v in enumerate(flat)], SCHEMA), 4).collect()
    assert {r.component for r in found} == {1, 2} and found[0].identity_error < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]])
def test_tables_without_variance_have_no_components(spark, rows):
    assert whiten(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)).collect() == []


def test_deviations_beyond_64_bits_are_null(spark):
    rows = [(1, [2.0**43, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 3.0])]
    found = whiten(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA), 1).collect()
    assert {r.deviation for r in found} == {None}
    x = [[int(64 * c) + 1_000_000 for c in v] for v in ([2.0**24, 1.0], [0.0, 2.0], [1.0, 3.0])]
    rows = [(1, [2.0**24, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 3.0])]
    found = whiten(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA), 1).collect()
    sums = [sum(c) for c in zip(*x)]
    exact = {i + 1: sum((3 * a - s) ** 2 for a, s in zip(row, sums)) for i, row in enumerate(x)}
    assert {r.vec_id: r.deviation for r in found} == {i: d if d < 2**63 else None for i, d in exact.items()}


def test_registered_query(spark):
    found = op12_whitening(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    agree(found, [r.vec_id for r in rows], [r.embedding for r in rows], 32)
