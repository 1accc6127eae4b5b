"""Linked vectors against all pairs."""

import numpy as np
import pytest

from assayer.llm import vector_dedup


def test_against_all_pairs(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + 0.08 * random.normal(size=16)).tolist()) for i in range(600)]
    rows += [(600 + i, random.normal(size=16).tolist()) for i in range(600)]
    rows += [(2000 + i, rows[5][1]) for i in range(70)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in vector_dedup.linked_vectors(frame, 0.9).collect()}
    ids = np.array([r[0] for r in rows])
    vectors = vector_dedup.unit(np.array([r[1] for r in rows]))
    near = vectors @ vectors.T >= 0.9
    np.fill_diagonal(near, False)
    want, got = near.sum(), sum(r.n_links for r in found.values())
    assert 0.97 * want <= got <= want
    assert all(found[i].n_links <= n for i, n in zip(ids.tolist(), near.sum(axis=1), strict=True))
    assert found[2003].component_id == found[5].component_id


def test_unusable_vectors_and_none(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [2.0, 0.0], None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0]]
    rows = list(enumerate(vectors)) + [(None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.linked_vectors(frame).collect()}
    assert found[0] == (1, 0) and found[1] == (1, 0)
    assert all(found[k] == (0, k) for k in range(2, 9))
    # The vector of one component has none of its length to link with.
    assert found[None] == (0, None)
    assert vector_dedup.linked_vectors(frame.filter("vec_id = 2")).count() == 1
    assert vector_dedup.linked_vectors(frame.filter("false")).count() == 0


@pytest.mark.parametrize("few", [4096, 100])
def test_every_length_links(spark, monkeypatch, few):
    """Vectors link with those of their own length, however few have it."""
    monkeypatch.setattr(vector_dedup, "FEW", few)
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=3).tolist(), 7) for i in range(400)]
    rows += [(1000 + i, (random.normal(size=5) * 0.01 + i % 40).tolist(), 7) for i in range(200)]
    rows += [(2000, [1.0, 2.0], 7), (2001, [1.0, 2.0], 7), (2002, [2.0, 4.0], 7), (2003, [2.0, -1.0], 7), (2004, [3.0] * 5000, 7)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, vector int")
    frame = frame.selectExpr("*", "'x' AS id", "1 AS cell", "2 AS length")
    found = {r.vec_id: r for r in vector_dedup.linked_vectors(frame, 0.9).collect()}
    assert [found[i].n_links for i in range(2000, 2005)] == [2, 2, 2, 0, 0]
    assert found[2002].component_id == 2000 and not found[2002].kept and found[2004].kept
    for low, high, size in ((0, 400, 3), (1000, 1200, 5)):
        vectors = vector_dedup.unit(np.array([r[1] for r in rows if low <= r[0] < high]))
        near = vectors @ vectors.T >= 0.9
        want = near.sum() - len(vectors)
        got = sum(found[i].n_links for i in range(low, high))
        assert 0.95 * want <= got <= want and (few < 400 or got == want)
