"""Distributed principal components against a dense decomposition."""

import numpy as np
import pytest

from tickerlark.operators.decomposition import Svd, _blocks, principal_components
from tickerlark.operators.vectors import reduce_dimensions, tfidf_vectors

EXACT = Svd(steps=40, tolerance=1e-13, block_entries=60, fan_in=2)


def sparse(seed, rows, columns, share):
    rng = np.random.default_rng(seed)
    dense = np.where(rng.random((rows, columns)) < share, rng.random((rows, columns)), 0.0)
    dense[0] = dense[7] = 0.0
    return dense * np.linspace(3, 0.5, columns)


def entries_of(spark, dense):
    at = np.argwhere(dense)
    return spark.createDataFrame([(int(i), f"t{j}", float(dense[i, j])) for i, j in at], "row long, column string, value double")


@pytest.mark.parametrize("columns, k", [(30, 5), (6, 4), (6, 10)])
def test_equals_a_dense_decomposition(spark, columns, k):
    dense = sparse(3, 50, columns, 0.2)
    scores, values, zero = principal_components(entries_of(spark, dense), k, len(dense), EXACT)
    centred = dense - dense.mean(axis=0)
    u, s, vt = np.linalg.svd(centred, full_matrices=False)
    k = min(k, columns)
    assert values == pytest.approx(s[:k], rel=1e-6)
    sign = np.sign((vt[:k] ** 3).sum(axis=1))
    want = centred @ vt[:k].T * sign
    got = {r["row"]: r["components"] for r in scores.collect()}
    assert set(got) == {i for i in range(len(dense)) if dense[i].any()}
    for i, row in got.items():
        assert row == pytest.approx(want[i], abs=1e-5)
    assert zero == pytest.approx(want[0], abs=1e-5)


def test_a_block_is_one_row_of_numbers(spark):
    dense = sparse(4, 50, 12, 0.3)
    blocks = _blocks(entries_of(spark, dense), Svd(block_entries=60)).collect()
    assert len(blocks) <= -(-np.count_nonzero(dense) // 60) and len({b["block"] for b in blocks}) == len(blocks)
    got, rows = np.zeros(dense.shape), []
    for b in blocks:
        assert b["row"] == sorted(b["row"])
        rows += b["rows"]
        for i, j, x in zip(b["row"], b["column"], b["value"], strict=True):
            got[b["rows"][i], int(b["columns"][j][1:])] += x
    assert len(rows) == len(set(rows)) and (got == dense).all()


def test_a_row_without_a_name_keeps_its_entries_apart(spark):
    rows = [(1, "a", 1.0), (None, "b", 2.0), (None, "a", 1.0), (2, "b", 3.0)]
    scores, _, _ = principal_components(spark.createDataFrame(rows, "row long, column string, value double"), 2, p=EXACT)
    got = {r["row"]: r["components"] for r in scores.collect()}
    dense = np.array([[1.0, 0], [1, 2], [0, 3]])
    centred = dense - dense.mean(axis=0)
    vt = np.linalg.svd(centred)[2]
    want = centred @ vt.T * np.sign((vt**3).sum(axis=1))
    for i, name in enumerate([1, None, 2]):
        assert got[name] == pytest.approx(want[i], abs=1e-5)


def test_nothing_to_reduce(spark):
    scores, values, zero = principal_components(entries_of(spark, np.zeros((9, 2))), 3, 9)
    assert scores.count() == 0 and len(values) == len(zero) == 0


def test_posts_keep_their_rows(spark):
    posts = [("a", "up up alpha", []), ("b", "down beta", ["#x"]), ("c", "the", []), ("d", "up beta", [])]
    df = spark.createDataFrame(posts, "id string, content string, hashtags array<string>")
    got = {r["id"]: r["components"] for r in reduce_dimensions(tfidf_vectors(df), df, k=2, settings=EXACT).collect()}
    assert set(got) == {"a", "b", "c", "d"} and all(len(x) == 2 for x in got.values())
    assert np.sum(list(got.values()), axis=0) == pytest.approx([0, 0], abs=1e-8)
