"""Whitening against plain integer arithmetic and numpy."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.whitening import cross_products, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, whitened string"


def frame(spark, vectors, keys=None):
    keys = keys or range(len(vectors))
    return spark.createDataFrame([(k, v, 0, "c", "n", "w") for k, v in zip(keys, vectors, strict=True)], SCHEMA)


def integers(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def collected(df):
    out = {}
    for row in df.collect():
        out.setdefault(row.vec_id, {})[row.component] = row
    return out


@settings(max_examples=40, deadline=None)
@given(
    st.integers(1, 5).flatmap(
        lambda d: st.lists(st.lists(st.integers(0, 2**41), min_size=d, max_size=d), min_size=1, max_size=90)
    )
)
def test_cross_products_are_exact(vectors):
    x = np.array(vectors, np.int64)
    bits = np.array([max(1, int(v).bit_length()) for v in x.max(axis=0)])
    ones = [[*row, 1] for row in vectors]
    size = len(ones[0])
    expected = [[sum(r[i] * r[j] for r in ones) for j in range(size)] for i in range(size)]
    assert cross_products(x, bits).tolist() == expected


def brute_force(vectors):
    x = [integers(v) for v in vectors]
    fit = sorted({tuple(v) for v in x})
    n, d = len(fit), len(fit[0])
    s = [sum(v[k] for v in fit) for k in range(d)]
    deviation = [sum((n * v[k] - s[k]) ** 2 for k in range(d)) for v in x]
    centred = np.array(fit, float) - np.array([t / n for t in s])
    covariance = centred.T @ centred / n
    return x, n, s, deviation, covariance


def test_whitening_equals_plain_arithmetic(spark):
    draw = np.random.default_rng(5)
    base = draw.normal(size=(300, 20)) @ draw.normal(size=(20, 20))
    vectors = [*base.astype(np.float32).tolist(), *base[:40].astype(np.float32).tolist()]
    got = collected(whiten(frame(spark, vectors).repartition(5)))
    x, n, s, deviation, covariance = brute_force(vectors)
    assert n == 300 and len(got) == 340
    values, axes = np.linalg.eigh(covariance)
    for key, row in enumerate(x):
        assert sorted(got[key]) == list(range(1, 17))
        for k in range(1, 17):
            line, value = got[key][k], values[-k]
            assert (line.n, line.deviation) == (n, deviation[key])
            plain = (np.array([v - t / n for v, t in zip(row, s, strict=True)]) @ axes[:, -k]) / math.sqrt(value)
            assert abs(line.whitened) == pytest.approx(abs(plain), rel=1e-6, abs=1e-9)
            assert line.explained == pytest.approx(value / np.trace(covariance), rel=1e-9)
            assert 0 <= line.identity_error < 1e-9


def test_signs_are_the_same_in_all_rows(spark):
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(200, 3)).astype(np.float32).tolist()
    got = collected(whiten(frame(spark, vectors).repartition(8)))
    z = np.array([[got[k][c].whitened for c in (1, 2, 3)] for k in range(200)])
    assert np.allclose(np.cov(z.T, bias=True), np.eye(3), atol=1e-9)


def test_odd_vectors(spark):
    good = [[1.0, 2.0], [3.0, 5.0], [-4.0, 0.5], [1.0, 2.0]]
    odd = [None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0], [7.0]]
    keys = [1, 2, None, 1, *range(10, 17)]
    rows = whiten(frame(spark, good + odd, keys)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in rows) == sorted(
        [(False, 1)] * 4 + [(False, 2)] * 2 + [(True, 0)] * 2
    )
    assert {r.n for r in rows} == {3}


def test_flat_dimensions_and_single_vectors(spark):
    flat = [[1.0, float(k), 2.0] for k in range(5)]
    assert {r.component for r in whiten(frame(spark, flat)).collect()} == {1}
    assert whiten(frame(spark, [[1.0, 2.0]] * 3)).collect() == []
    assert whiten(frame(spark, [None, []])).collect() == []
    assert whiten(frame(spark, [])).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
    ]


def test_wide_entries(spark):
    vectors = [[1e9, -3e9], [2.5e9, 1.0], [0.0, 7e9], [1e9, 1e9]]
    scaled = [[float(np.float32(c)) for c in v] for v in vectors]
    with pytest.raises(Exception, match="long|int|large"):
        whiten(frame(spark, vectors)).collect()  # squares beyond a long
    small = [[c / 1e3 for c in v] for v in scaled]
    got = collected(whiten(frame(spark, small)))
    _, n, _, deviation, _ = brute_force(small)
    assert [got[k][1].deviation for k in range(4)] == deviation and n == 4
    with pytest.raises(Exception, match="in size"):
        whiten(frame(spark, [[1e30, 1.0], [1.0, 2.0]])).collect()
