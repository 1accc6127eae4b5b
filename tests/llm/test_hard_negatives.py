"""Hard negatives against comparing all pairs, and the parts of the method."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.llm import hard_negatives, queries
from assayer.llm.hard_negatives import Best, hilbert_keys, interval, products

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize(("axes", "bits"), [(2, 4), (3, 3), (4, 2), (2, 1)])
def test_neighbours_on_the_curve_are_neighbours(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    random = np.random.default_rng(1)
    rows, anchors = random.integers(-300, 300, (50, 6)), random.integers(-300, 300, (9, 6))
    low, high = rows.min(axis=0)[None], rows.max(axis=0)[None]
    least, most = interval(anchors.astype(float), low.astype(float), high.astype(float))
    score = products(anchors.astype(float), rows.astype(float))
    assert (score == anchors @ rows.T).all()
    assert (least <= score).all() and (score <= most).all()
    large = np.full((1, 2), 1e300)
    assert products(large, large).tolist() == [[np.iinfo(np.int64).max]]
    assert products(np.full((1, 2), 2.0**30), np.full((1, 2), 2.0**30 + 1)).tolist() == [[2**61 + 2**31]]
    least, most = interval(large, -large, large)
    assert least <= -hard_negatives.LAST and most >= hard_negatives.LAST


def test_best_keeps_the_first_of_each_slot():
    best = Best(np.full(2, -100), 2)
    best.offer(np.array([0, 0, 1]), np.array([5, 5, 1]), np.array([9, 3, 1]))
    best.offer(np.array([0, 1]), np.array([5, 7]), np.array([4, 2]))
    assert list(zip(best.slot, best.score, best.id, strict=True)) == [(0, 5, 3), (0, 5, 4), (1, 7, 2), (1, 1, 1)]
    assert best.last.tolist() == [5, 1]


def expected(rows):
    """All pairs, one by one."""
    own = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        own.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for anchor, label, vector in own:
        if anchor % 100:
            continue
        scored = [
            (sum(a * b for a, b in zip(vector, v, strict=True)), i, other)
            for i, other, v in own
            if i != anchor and len(v) == len(vector)
        ]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            inside = [x for x in scored if x[2] != label and 30 * s <= 100 * x[0] <= 90 * s][:10]
            found += [(anchor, p, rank, n, s, t) for rank, (t, n, _) in enumerate(inside, 1)]
    return sorted(found)


def run(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "vector": F.lit(1), "rank": F.lit(2)})
    frame.write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(map(tuple, queries.op12(spark, str(tmp_path)).collect()))


def test_query_against_all_pairs(spark, tmp_path):
    random = np.random.default_rng(3)
    centres = random.normal(size=(12, 8)) * np.array([1, 1, 1, 0.5, 0.3, 0.1, 0.1, 0.1])
    rows = []
    for i in range(1500):
        vector = (centres[i % 12] + 0.2 * random.normal(size=8)).round(2)
        rows.append((i, vector.tolist(), int(random.integers(0, 2) * random.integers(0, 10))))
    nan, inf = float("nan"), float("inf")
    rows += [(2000 + 100 * i, v, 1) for i, v in enumerate([None, [], [nan] * 8, [inf] * 8, [None] * 8])]
    rows += [(3000, rows[5][1], None), (None, rows[5][1], 1), (3100, [0.0] * 8, 2), (3200, [1.0, 2.0], 3)]
    rows += [(3201, [1.0, 1.0], 3), (3202, [0.5, 0.9], 4), (3203, [3.4e38] * 8, 3), (3300, [-1.0] * 8, 9)]
    rows += [(3400 + i, rows[5][1], 4 + i % 2) for i in range(700)]
    assert run(spark, tmp_path, rows) == expected(rows)


def test_blocks_of_any_size_give_the_same(spark):
    random = np.random.default_rng(4)
    rows = [(i, random.normal(size=6).tolist(), i % 3) for i in range(900)]
    frame = hard_negatives.scaled(spark.createDataFrame(rows, SCHEMA), 256)
    anchors = frame.filter("id % 50 = 0")
    one, two = (sorted(map(tuple, hard_negatives.mine(frame, anchors, block=b).collect())) for b in (7, 512))
    assert one == two and len(one) > 100


def test_far_blocks_are_not_read(spark, tmp_path, monkeypatch):
    """Of many far apart groups an anchor reads the few that its windows reach."""
    random = np.random.default_rng(5)
    centres = random.normal(size=(40, 4)) * 50
    rows = [(i, (centres[i % 40] + random.normal(size=4)).tolist(), i % 2) for i in range(4000)]
    frame = hard_negatives.scaled(spark.createDataFrame(rows, SCHEMA), 1.0)
    curve = hard_negatives.on_curve(frame, hard_negatives.axes_of(frame))
    manifest = hard_negatives.write_blocks(curve, str(tmp_path / "blocks"), 50)
    manifest.write.parquet(str(tmp_path / "manifest"))
    read = []
    whole = hard_negatives.Store._block
    monkeypatch.setattr(hard_negatives.Store, "_block", lambda s, *a: read.append(a) or whole(s, *a))
    batch = frame.filter("id = 100").toArrow().to_batches()[0]
    store = hard_negatives.Store(str(tmp_path / "manifest"))
    found = hard_negatives.search(store, batch, 5, 10, 30, 90)
    assert found.num_rows == 50 and len(read) < 40 and manifest.selectExpr("sum(groups)").first()[0] >= 80


def test_repeats_and_none(spark, tmp_path):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (1, [0.9, 0.1], 1), (2, [0.5, 0.5], 2)]
    found = run(spark, tmp_path, rows)
    # Vector 0 takes label 2 as its id is divisible by 7, and so vector 2 for its positive.
    assert found == [(0, 2, rank, None, 0, 0) for rank in ()] and expected(rows) == []
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (1, [0.9, 0.1], 1), (2, [0.5, 0.5], 2)]
    assert run(spark, tmp_path, rows) == expected(rows) and len(expected(rows)) == 4
    assert run(spark, tmp_path, []) == []
