import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import whitening


def brute(rows, k=16):
    """numpy: fit list, covariance, eigenvectors, projections of every sound row."""
    sound = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in sound), default=0)
    sound = [(i, np.floor(np.asarray(v, np.float64) * 64).astype(np.int64) + 1_000_000) for i, v in sound if len(v) == d and d]
    fit = np.unique(np.array([x for _, x in sound]), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    cov = c.T @ c / n
    w, u = np.linalg.eigh(cov)
    order = [j for j in np.argsort(w)[::-1] if w[j] > 1e-12 * np.trace(cov)][:k]
    out = {}
    for i, x in sound:
        y = (x - s / n) @ (u[:, order] / np.sqrt(w[order]))
        dev = int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s)))
        for j in range(len(order)):
            out.setdefault((i, j + 1), []).append((n, dev, y[j], w[order[j]] / np.trace(cov)))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 20)) * rng.uniform(0.1, 2.0, size=20)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(base)]
    rows += [(100, rows[3][1]), (100, rows[3][1]), (None, rows[4][1])]  # copies, a null id
    rows += [(200, None), (201, [1.0] * 19 + [None]), (202, [float("nan")] + [0.0] * 19), (203, [float("inf")] * 20), (204, [1.0] * 5), (205, [])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"x": F.lit("clash"), "index": F.lit(1), "n": F.lit(None)})


def test_equals_brute_force(spark, rows):
    got = whitening.whiten(frame(spark, rows).repartition(3)).collect()
    want = brute(rows)
    assert sorted({(r.vec_id, r.component) for r in got}, key=str) == sorted(want, key=str)
    assert len(got) == sum(len(v) for v in want.values())
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() <= 1e-4
    for r in got:
        options = want[(r.vec_id, r.component)]
        n, dev, y, share = options[0]
        assert (r.n, r.deviation) == (n, dev)
        assert abs(abs(r.whitened) - abs(y)) < 1e-9
        assert abs(r.explained - share) <= 1e-4 * share


def test_one_sign_for_all_rows(spark, rows):
    got = whitening.whiten(frame(spark, rows)).collect()
    want = brute(rows)
    for component in range(1, 17):
        signs = {np.sign(r.whitened) == np.sign(want[(r.vec_id, component)][0][2]) for r in got if r.component == component and abs(r.whitened) > 1e-6}
        assert len(signs) == 1


def test_empty_and_unsound_tables(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [float("nan")])])).collect() == []


def test_fewer_rows_than_components(spark):
    rows = [(1, [0.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.0, 2.0, 0.0]), (4, [0.0, 2.0, 0.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2}  # rank two
    assert len(got) == 8
