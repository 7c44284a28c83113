"""Triangulation on Arrow buffers against one point at a time."""

import numpy as np
import pyarrow as pa
import pytest

from viewloom.operators import stereo


def one_by_one(p1, p2, left, right):
    if left is None or right is None:
        return None
    out = []
    for a, b in zip(left, right, strict=False):
        if a is None or b is None or len(a) < 2 or len(b) < 2 or None in a[:2] or None in b[:2] or p1 is None or p2 is None:
            out.append(None)
            continue
        m, k = np.reshape(p1, (3, 4)), np.reshape(p2, (3, 4))
        x = np.linalg.svd(np.stack([a[0] * m[2] - m[0], a[1] * m[2] - m[1], b[0] * k[2] - k[0], b[1] * k[2] - k[1]]))[2][-1]
        out.append(x[:3] / x[3] if x[3] else None)
    return out


def frames(rng, n):
    matrices = [(rng.normal(size=12) * 3).tolist() for _ in range(2)]
    points = lambda k: [rng.normal(size=2).tolist() for _ in range(k)]
    rows = []
    for i in range(n):
        left, right = points(i % 7), points((i * 3) % 6)
        left, right = (None if i % 11 == 3 else left), (None if i % 13 == 5 else right)
        if i == 20:
            left, right = [[1.0], None, [1.0, 2.0, 9.0], [None, 1.0]], points(4)
        rows.append((i, matrices[0], matrices[1] if i != 33 else None, left, right))
    return rows


SCHEMA = "f int, P1 array<double>, P2 array<double>, left_face array<array<double>>, right_face array<array<double>>"


@pytest.mark.parametrize("solved", [3, 1 << 16])
def test_equals_one_point_at_a_time(monkeypatch, solved):
    monkeypatch.setattr(stereo, "SOLVED", solved)
    rows = frames(np.random.default_rng(1), 60)
    kind = pa.list_(pa.list_(pa.float64()))
    whole = [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.list_(pa.float64())), (2, pa.list_(pa.float64())), (3, kind), (4, kind))]
    for cut in (slice(None), slice(17, 41)):  # a slice of a batch has buffers that begin elsewhere
        p1, p2, left, right = (c[cut] for c in whole)
        got = stereo._solved(stereo._numbers(p1, 12), stereo._numbers(p2, 12), left, right).to_pylist()
        for r, g in zip(rows[cut], got, strict=True):
            want = one_by_one(*r[1:])
            assert (g is None) == (want is None)
            for x, y in zip(g or [], want or [], strict=True):
                assert (x is None) == (y is None) and (x is None or np.allclose([x["x"], x["y"], x["z"]], y, rtol=1e-9))


def test_frames_keep_their_keys_and_nulls(spark):
    rows = frames(np.random.default_rng(2), 60)
    got = {r["f"]: r["face"] for r in stereo.triangulate(spark.createDataFrame(rows, SCHEMA), ["f"], ["face"]).collect()}
    assert len(got) == 60
    for r in rows:
        want = one_by_one(*r[1:])
        assert (got[r[0]] is None) == (want is None) and len(got[r[0]] or []) == len(want or [])
    assert stereo.triangulate(spark.createDataFrame([], SCHEMA), ["f"], ["face"]).count() == 0


def test_no_python_object_a_point(monkeypatch, spark):
    import inspect

    source = inspect.getsource(stereo._solved) + inspect.getsource(stereo.triangulate)
    assert "to_pylist" not in source and "tolist" not in source
    plan = stereo.triangulate(spark.createDataFrame([], SCHEMA), ["f"], ["face"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
