import json

import numpy as np
import pytest
from pyspark.errors import PySparkException

from viewloom import sources, streaming


def test_catalog(spark, tmp_path):
    (tmp_path / "p01/CAM_LL").mkdir(parents=True)
    (tmp_path / "p01/CAM_LL/a.MP4").write_bytes(b"12345")
    (tmp_path / "p01/b.txt").write_bytes(b"1")
    got = sources.read_catalog(spark, str(tmp_path)).collect()
    assert [(r["path"].rsplit("/", 1)[-1], r["length"]) for r in got] == [("a.MP4", 5)]


def test_annotations(spark, tmp_path):
    good = [{"video_url": "/x-p03_CAM_AV_P_TOWER_HO.mp4", "tricks": [{"start": 1.0, "end": 2.5, "labels": ["Robot Pickup and Stack (RPS)"]}]}]
    (tmp_path / "a.json").write_text(json.dumps(good))
    (tmp_path / "b.json").write_text(json.dumps([{"other": 1}]))
    rows, aside = sources.read_annotations(spark, f"{tmp_path}/*.json")
    assert [(r["file"], len(r["tricks"])) for r in rows.collect()] == [("a.json", 1)]
    assert aside.count() == 1


def test_task_plan(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"p08": ["CALIBRATION", "STAIRWAY_AP"]}, indent=1))
    assert [tuple(r) for r in sources.read_task_plan(spark, str(tmp_path / "t.json")).collect()] == [("p08", 1, "CALIBRATION"), ("p08", 2, "STAIRWAY_AP")]


def test_calibrations(spark, tmp_path):
    np.savez(tmp_path / "p01_LL_LR_stereo.npz", retval=0.5, left_mtx=np.eye(3), right_mtx=np.eye(3), left_dist=np.zeros((1, 5)), right_dist=np.zeros((1, 5)), R=np.eye(3), T=np.zeros((3, 1)))
    r = sources.read_calibrations(spark, f"{tmp_path}/*.npz").first()
    assert (r["participant"], r["pair"], r["retval"], len(r["left_mtx"]), len(r["T"])) == ("p01", "LL_LR", 0.5, 9, 3)


def test_landmark_widths(spark, tmp_path):
    df = spark.createDataFrame([(1, [[1.0, 2.0]]), (2, [[1.0, 2.0], [3.0, 4.0]]), (3, None)], "f int, face array<array<double>>")
    good, bad = sources.check_widths(df, {"face": 1})
    assert (good.count(), bad.count()) == (2, 1)
    with pytest.raises(PySparkException):
        sources.write_landmarks(df, str(tmp_path / "x"), {"face": 1})


def test_incremental_runs_add_nothing_twice(spark, tmp_path):
    src, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.range(3).write.parquet(src)
    schema = spark.range(1).schema
    run = lambda: streaming.incremental_features(spark, src, schema, lambda b: b, sink, state).awaitTermination()
    run()
    run()
    assert spark.read.parquet(sink).count() == 3
    spark.range(2).write.mode("append").parquet(src)
    run()
    assert spark.read.parquet(sink).count() == 5


def test_equal_names_in_two_folders_are_two_files(spark, tmp_path):
    for k, folder in enumerate("ab"):
        spark.range(k, k + 1).coalesce(1).write.parquet(str(tmp_path / "made" / folder))
        (tmp_path / "in" / folder).mkdir(parents=True)
        part = next((tmp_path / "made" / folder).glob("part-*.parquet"))
        (tmp_path / "in" / folder / "part-0.parquet").write_bytes(part.read_bytes())
    sink, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda where, work=lambda b: b: streaming.incremental_features(spark, str(tmp_path / "in"), spark.range(1).schema, work, sink, where, per_run=1).awaitTermination()
    run(state)
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [0, 1]
    run(str(tmp_path / "other"))  # another checkpoint reads all files again; those in the sink are left out
    assert spark.read.parquet(sink).count() == 2
    with pytest.raises(Exception, match="keep the column file"):
        run(str(tmp_path / "third"), lambda b: b.drop("file"))


def test_all_calibration_fields(spark, tmp_path):
    whole = {c: np.arange(9.0).reshape(3, 3) + i for i, c in enumerate(("left_mtx", "right_mtx", "R", "E", "F", "R1", "R2"))} | {c: np.arange(12.0).reshape(3, 4) + i for i, c in enumerate(("P1", "P2"))}
    whole |= {"Q": np.eye(4), "T": np.zeros((3, 1)), "left_dist": np.zeros((1, 5)), "right_dist": np.zeros((1, 5)), "retval": 0.5, "left_count": 12, "right_count": 14}
    np.savez(tmp_path / "p01_LL_LR.npz", **whole)
    np.savez(tmp_path / "p02_UL_UR.npz", left_mtx=np.eye(3))
    rows = {r["participant"]: r.asDict() for r in sources.read_calibrations(spark, f"{tmp_path}/*.npz").collect()}
    for c, v in whole.items():
        assert rows["p01"][c] == (np.asarray(v, float).ravel().tolist() if np.ndim(v) else v)
    assert rows["p02"]["P1"] is None and rows["p02"]["left_count"] is None and rows["p02"]["retval"] is None


def test_npz_arrays_are_numpys_own():
    import io

    import numpy as np

    from viewloom.sources import npz_arrays

    fields = {"a": np.arange(6.0).reshape(2, 3), "b": np.asfortranarray(np.arange(6).reshape(2, 3)), "c": np.float64(1.5), "d": np.zeros(0), "e": np.array(["x", "yy"])}
    headers = {}
    for save in (np.savez, np.savez_compressed):
        out = io.BytesIO()
        save(out, **fields)
        got = npz_arrays(out.getvalue(), headers)
        assert got.keys() == fields.keys() and all(np.array_equal(got[k], v) and got[k].dtype == np.asarray(v).dtype for k, v in fields.items())
    out = io.BytesIO()
    np.savez(out, a=np.array([{}], object))
    with pytest.raises(ValueError):
        npz_arrays(out.getvalue(), {})


def test_calibrations_are_dealt_to_all_tasks(spark, sf_dir):
    from pyspark.sql import functions as F

    from viewloom.queries import s5_decode_calibrations

    assert len(s5_decode_calibrations(spark, sf_dir).withColumn("at", F.spark_partition_id()).select("at").distinct().collect()) > 1
