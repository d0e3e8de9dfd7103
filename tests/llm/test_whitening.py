"""Whitening against plain numpy and Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import bidiagonal, whitening
from daybook.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute(vectors, k=16):
    """n, deviations, variances, trace and absolute whitened values, by the contract."""
    xs = [tuple(math.floor(64 * float(c)) + 1000000 for c in v) for v in vectors]
    distinct = sorted(set(xs))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in distinct], dtype=object).astype(float) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1].T
    rows = np.array([[n * c - s for c, s in zip(x, sums)] for x in xs], dtype=object)
    deviation = [int(sum(int(c) ** 2 for c in row)) for row in rows]
    return n, deviation, e[:k], e.sum(), (rows.astype(float) / n) @ v[:k].T


def check(rows, vectors, ids):
    n, deviation, e, trace, projected = brute(vectors)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(rows) == len(vectors) * len(e) and set(got) == set(ids)
    for i, d, p in zip(ids, deviation, projected):
        for c, r in got[i].items():
            assert (r["n"], r["deviation"]) == (n, d)
            assert r["explained"] == pytest.approx(e[c - 1] / trace, rel=1e-9, abs=1e-14)
            assert r["identity_error"] < 1e-9
            if e[c - 1] > 1e-9 * e[0]:
                assert abs(r["whitened"]) == pytest.approx(abs(p[c - 1]) / math.sqrt(e[c - 1]), rel=1e-7, abs=1e-7)
    for c in range(1, len(e) + 1):                   # one sign for all rows
        signs = [np.sign(got[i][c]["whitened"] * p[c - 1]) for i, p in zip(ids, projected)
                 if got[i][c]["whitened"] is not None and abs(p[c - 1]) > 1e-3 * math.sqrt(e[0])]
        assert len(set(signs)) <= 1


def test_query(spark):
    rows = QUERIES["op11_whitening"](spark, SF_SMALL).collect()
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(rows, [r[1] for r in table], [r[0] for r in table])


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    good = [rng.standard_normal(5).tolist() for _ in range(60)] + [[0.0] * 5] * 3
    data = [(i, v) for i, v in enumerate(good)] + [(i + 100, good[0]) for i in range(40)]   # copies count once
    bad = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]), (903, [1.0, float("nan"), 0.0, 0.0, 0.0]),
           (904, [1.0, float("inf"), 0.0, 0.0, 0.0]), (905, [1.0, 2.0])]
    df = spark.createDataFrame(data + bad, "vec_id bigint, embedding array<double>").repartition(7)
    rows = whitening.whiten(df.withColumn("x", F.lit(1)).withColumn("id", F.lit("clash"))).collect()
    check(rows, [v for _, v in data], [i for i, _ in data])


def test_no_variance_ties_and_large_entries(spark):
    def run(vectors):
        return whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>"))
    one = run([[1.0, 2.0]] * 3).collect()
    assert len(one) == 6 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in one)
    tied = run([[1.0, 0.0, 3.0], [-1.0, 0.0, 3.0], [0.0, 1.0, 3.0], [0.0, -1.0, 3.0]]).collect()
    assert all((r["whitened"] is None) == (r["component"] == 3) for r in tied)
    assert all(r["explained"] == pytest.approx(0.5 if r["component"] < 3 else 0) and r["identity_error"] < 1e-9 for r in tied)
    huge = run([[1e300, 0.0], [-1e300, 1.0], [0.0, 2.0]]).collect()
    assert len(huge) == 6 and all(r["deviation"] is None or r["deviation"] >= 0 for r in huge)
    assert run([]).collect() == []
    wide = [[float(x) for x in row] for row in np.random.default_rng(1).standard_normal((40, 24))]
    check(run(wide).collect(), wide, range(40))


def test_triangles_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "STACK", 3)
    vectors = np.random.default_rng(9).standard_normal((400, 6)).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>").repartition(30)
    monkeypatch.setattr(whitening, "handoff", lambda d, name, keep=whitening.handoff: (
        keep(d, name).repartition(23) if name == "fit-list" else keep(d, name)))
    check(whitening.whiten(df).collect(), vectors, range(400))


def cases():
    rng = np.random.default_rng(1)
    turn, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    return {
        "random": rng.standard_normal((500, 64)),
        "graded": rng.standard_normal((500, 48)) * 10.0 ** -(np.arange(48) / 8),
        "equal values": np.vstack([np.diag([3.0] * 10 + [1] * 10), -np.diag([3.0] * 10 + [1] * 10)]),
        "equal values, turned": np.diag([3.0] * 10 + [2] * 10 + [1] * 20) @ turn,
        "nearly equal": np.diag(np.r_[3 + 1e-9 * np.arange(10), 2 + 1e-12 * np.arange(10), np.linspace(.1, 1, 20)]) @ turn,
        "few rows": rng.standard_normal((3, 30)),
        "clusters": np.vstack([c + .01 * rng.standard_normal((30, 60)) for c in rng.standard_normal((8, 60))]),
        "constant columns": rng.standard_normal((90, 20)) * np.r_[np.zeros(3), np.ones(17)],
        "one": rng.standard_normal((9, 1)), "two": rng.standard_normal((9, 2)), "zero": np.zeros((3, 4)),
        "wilkinson": np.diag(np.abs(np.arange(-10.0, 11))) + np.eye(21, k=1) + np.eye(21, k=-1),
    }


@pytest.mark.parametrize("name", list(cases()))
def test_singular(name):
    a = cases()[name]
    k = min(16, a.shape[1])
    squares, vectors = bidiagonal.singular(np.linalg.qr(a, mode="r"), k)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    want = np.concatenate([want, np.zeros(a.shape[1] - len(want))])
    real = want > 1e-18 * want[0]
    assert np.abs(squares - want)[real] == pytest.approx(0, abs=1e-12 * max(want[0], 1))
    assert squares[real] == pytest.approx(want[real], rel=1e-10)
    living = real[:k]
    v = vectors[living]
    if len(v):
        assert np.abs(v @ v.T - np.eye(len(v))).max() < 1e-11
        assert np.abs(a.T @ (a @ v.T) - v.T * squares[:k][living]).max() < 1e-12 * want[0] * 10
