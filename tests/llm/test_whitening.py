"""Whitening against a plain eigendecomposition in numpy and Python integers."""

import math

import numpy as np
import pytest

from actaspark.llm import queries
from actaspark.llm.whitening import fit, identity_error, vectors, whitened
from actaspark.plans.shipping import shipped

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, v string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "c", "n", "v") for i, v in rows], SCHEMA)


def plain(vs):
    x = [[math.floor(np.float32(c).astype(float) * 64) + 1_000_000 for c in v] for v in vs]
    n, sums = len(x), [sum(col) for col in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, values[::-1], columns[:, ::-1]


@pytest.fixture(scope="module")
def random_rows():
    rng = np.random.default_rng(1)
    return [(i, rng.normal(size=48) * np.linspace(2, 0.2, 48)) for i in range(400)]


def test_query_against_plain_numbers(spark, random_rows, tmp_path):
    odd = [(900, None), (901, [None] * 48), (902, [float("nan")] * 48), (903, [float("inf")] + [0.0] * 47), (904, []), (905, [1.0, 2.0]), (None, random_rows[0][1]), (5, random_rows[5][1])]
    table(spark, random_rows + odd).repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = shipped(queries.queries()["op13_subspace_whitening"])(spark, str(tmp_path)).collect()
    used = [v for _, v in random_rows] + [random_rows[0][1], random_rows[5][1]]
    n, deviation, centred, values, columns = plain(used)
    assert len(rows) == 402 * 32 and {r["n"] for r in rows} == {402}
    assert len({r["identity_error"] for r in rows}) == 1 and 0 <= rows[0]["identity_error"] < 1e-9
    want = centred @ columns[:, :32] / np.sqrt(values[:32])
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    sign = np.array([np.sign(got[7][c + 1][0]["whitened"] * want[7, c]) for c in range(32)])
    for i in range(400):
        for c in range(32):
            for r in got[i][c + 1]:
                assert r["deviation"] == deviation[i] == int(r["deviation_text"])
                assert abs(r["whitened"] - sign[c] * want[i, c]) < 1e-8
                assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
    assert len(got[5][1]) == 2 and len(got[None]) == 32


def test_blocks_narrower_than_the_space(spark, random_rows):
    rows = vectors(table(spark, random_rows))
    found = fit(rows, k=6, extra=2, most=14)
    _, _, _, values, columns = plain([v for _, v in random_rows])
    assert found.passes > 2 and found.residual <= 1e-13
    assert np.allclose(found.values, values[:6], rtol=1e-12)
    assert np.allclose(np.abs((found.components * columns[:, :6]).sum(axis=0)), 1, atol=1e-12)
    assert identity_error(rows, found) < 1e-9


def test_degenerate_tables(spark):
    assert whitened(table(spark, [])).count() == 0
    assert whitened(table(spark, [(1, None), (2, [])])).count() == 0
    assert whitened(table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitened(table(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    line = whitened(table(spark, [(i, [i, 2 * i, 0]) for i in range(5)])).collect()
    assert len(line) == 5 and {r["component"] for r in line} == {1}
    assert sorted(abs(r["whitened"]) for r in line) == pytest.approx([0, 0.5**0.5, 0.5**0.5, 2**0.5, 2**0.5], abs=1e-12)
    assert line[0]["explained"] == pytest.approx(1)


def test_large_entries_stay_exact(spark):
    rows = [(i, [(-1) ** i * 2.0**45 * (i + 1), 3.0 * i]) for i in range(6)] + [(9, [2.0**60, 0.0])]
    found = whitened(table(spark, rows)).collect()
    _, deviation, *_ = plain([v for _, v in rows[:6]])
    assert {(r["vec_id"], int(r["deviation_text"])) for r in found} == set(enumerate(deviation))
    assert all(r["deviation"] is None for r in found)
