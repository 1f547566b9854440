"""The k best against brute force."""

import numpy as np
import pytest

from tablewright.llm import topk


def brute(rows, wanted, k):
    out = set()
    for q, vq in rows:
        if q not in wanted:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(vq, v)), i) for i, v in rows if i != q and len(v) == len(vq)
        )
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


@pytest.mark.parametrize("shard, block, scale", [(16_384, 4_096, 1), (100, 7, 1), (150, 9, 2**25)])
def test_agrees_with_brute_force(spark, monkeypatch, shard, block, scale):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "LEAF", 16)
    rng = np.random.default_rng(shard)
    rows = [(i, rng.integers(-3, 4, 6).tolist()) for i in range(500)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(2000 + i, [1, 2]) for i in range(3)]
    rows = [(i, [x * scale for x in v]) for i, v in rows]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>")
    out = topk.best(vectors, vectors.filter("vec_id % 50 = 0"), 5)
    found = {(r.query_id, r.rank, r.vec_id, r.score) for r in out.collect()}
    wanted = {i for i, _ in rows if i % 50 == 0}
    assert found == brute(rows, wanted, 5)


def test_every_vector_of_a_query_id_is_searched(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 20)
    monkeypatch.setattr(topk, "BLOCK", 2)
    monkeypatch.setattr(topk, "LEAF", 4)
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-9, 10, 4).tolist()) for i in range(200)]
    asked = [(i, [x * s for x in v]) for i, v in rows[:6] for s in (1, -1)]
    asked += [(7, [1, 2, 3, 4]), (7, [1, 2]), rows[8], rows[8]]
    kind = "vec_id long, v array<long>"
    out = topk.best(spark.createDataFrame(rows, kind), spark.createDataFrame(asked, kind).repartition(5))
    expected = []
    for q in {q for q, _ in asked}:
        every = {tuple(v) for i, v in asked if i == q}
        scored = sorted(
            (-sum(a * b for a, b in zip(w, v)), i)
            for w in every for i, v in rows if i != q and len(v) == len(w)
        )
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, out.collect())) == sorted(expected)


def test_quantised(spark):
    rows = [(1, [0.5, -0.001, None]), (2, [0.5, -0.001]), (3, None), (4, [float("nan")]),
            (5, [float("inf")]), (6, []), (None, [1.0]), (7, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {(r.vec_id, tuple(r.v)) for r in topk.quantised(df).collect()}
    assert found == {(2, (128, -1)), (7, (256, 512))}


def test_few_or_no_candidates(spark):
    one = spark.createDataFrame([(0, [1]), (3, [2]), (4, [2])], "vec_id long, v array<long>")
    found = [tuple(r) for r in topk.best(one, one.filter("vec_id = 0")).collect()]
    assert sorted(found) == [(0, 1, 3, 2), (0, 2, 4, 2)]
    assert topk.best(one.filter("false"), one.filter("false")).collect() == []
    assert topk.best(one.filter("vec_id = 0"), one.filter("vec_id = 0")).collect() == []
