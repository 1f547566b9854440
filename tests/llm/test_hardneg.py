"""Hard negatives against brute force."""

import numpy as np
import pytest

from tablewright.llm import hardneg

KIND = "vec_id long, label long, v array<long>"


def brute(rows, anchors, k, m, percent):
    out = []
    for a, label, q in {(i, lab, tuple(v)) for i, lab, v in anchors}:
        scored = [
            (-sum(x * y for x, y in zip(q, v)), i, lab) for i, lab, v in rows if i != a and len(v) == len(q)
        ]
        for ps, p, _ in sorted(s for s in scored if s[2] == label)[:k]:
            good = sorted(s for s in scored if s[2] != label and -percent[0] * ps <= -100 * s[0] <= -percent[1] * ps)
            out += [(a, p, r, n, -ps, -s) for r, (s, n, _) in enumerate(good[:m], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard, block, scale", [(32_768, 1_024, 1), (40, 6, 1), (60, 9, 2**20)])
def test_agrees_with_brute_force(spark, monkeypatch, shard, block, scale):
    """Ties, repeated rows and ids, other lengths, a hot label, anchors of one id with two labels."""
    monkeypatch.setattr(hardneg, "SHARD", shard)
    monkeypatch.setattr(hardneg, "BLOCK", block)
    monkeypatch.setattr(hardneg, "AT_ONCE", 4)
    monkeypatch.setattr(hardneg, "CHUNK", 16)
    rng = np.random.default_rng(shard)
    rows = [(i, int(rng.choice([0, 0, 0, 1, 2, 3])), rng.integers(-3, 5, 11).tolist()) for i in range(260)]
    rows += [(300 + i, i % 2, rows[0][2]) for i in range(12)] + [(400 + i, i % 3, [1, 2]) for i in range(6)]
    rows += [rows[5], (20, 2, rows[20][2]), (500, 0, []), (501, 1, []), (502, 0, [0] * 11)]
    rows = [(i, lab, [x * scale for x in v]) for i, lab, v in rows]
    anchors = [r for r in rows if r[0] % 20 == 0] + [rows[40]]
    df = spark.createDataFrame(rows, KIND)
    found = hardneg.hard_negatives(df, spark.createDataFrame(anchors, KIND), 4, 3, 70, 95)
    assert sorted(map(tuple, found.collect())) == brute(rows, anchors, 4, 3, (70, 95))


def test_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for d, size in ((1, 1), (8, 5), (13, 200), (64, 2**20)):
        v, q = rng.integers(-size, size, (9, d)), rng.integers(-size, size, (7, d))
        planes = int(max(v.max(), -v.min() - 1)).bit_length() + 1
        bits = (v[:, None, :] >> np.arange(planes - 1, -1, -1)[None, :, None] & 1).astype(bool)
        packed = np.packbits(bits, axis=2, bitorder="little")
        assert (hardneg.scores(hardneg.tables_of(q), packed) == v @ q.T).all()


def test_whole_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001], 3), (2, None, 3), (3, [1.0, None], 3), (4, [nan], 3), (5, [inf], 3), (6, [1.0], None),
            (None, [1.0], 3), (7, [], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = [(r.vec_id, r.label, r.v) for r in hardneg.whole_vectors(df).collect()]
    assert sorted(found) == [(1, 3, [128, -1]), (7, 3, [])]


def test_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, 1, [3]), (1, 1, [2]), (2, 2, [2]), (3, 2, [-1])], KIND)
    assert list(map(tuple, hardneg.hard_negatives(df, df.filter("vec_id = 0")).collect())) == [(0, 1, 1, 2, 6, 6)]
    for vectors, anchors in ((df.filter("false"), df), (df, df.filter("false")), (df.filter("false"),) * 2):
        assert hardneg.hard_negatives(vectors, anchors).collect() == []
    with pytest.raises(ValueError, match="too large"):
        large = df.selectExpr("vec_id", "label", "transform(v, x -> x * 1000000000000) AS v")
        hardneg.hard_negatives(large, large)
