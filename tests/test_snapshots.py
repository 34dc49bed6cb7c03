"""Snapshots: a reader sees the dataset before or after a run, never between."""

import pytest
from pyspark.sql import functions as F

from ballotlens.sources import sinks, snapshots
from conftest import rows


def frame(spark, data):
    return spark.createDataFrame(data, "epoch int, k int, v string")


def test_reader_sees_old_or_new_at_every_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ds")
    old = [(1, 1, "a"), (1, 2, "b"), (2, 3, "c")]
    sinks.write_epochs(frame(spark, old), path, ["k"])
    started = snapshots.read(spark, path)                       # a reader that has resolved its manifest
    steps, publish = [], snapshots.publish_text

    def stop(*args):
        steps.append(rows(snapshots.read(spark, path)))         # data is written, nothing is published
        raise OSError("stopped")
    monkeypatch.setattr(snapshots, "publish_text", stop)
    with pytest.raises(OSError):
        sinks.write_epochs(frame(spark, [(2, 9, "z"), (3, 4, "d")]), path, ["k"])
    with pytest.raises(OSError):
        sinks.upsert_by_key(spark, frame(spark, [(2, 1, "moved")]), path, ["k"])
    assert steps == [sorted(old, key=str)] * 2 and rows(snapshots.read(spark, path)) == sorted(old, key=str)
    monkeypatch.setattr(snapshots, "publish_text", publish)
    sinks.write_epochs(frame(spark, [(2, 9, "z"), (3, 4, "d")]), path, ["k"])
    assert rows(snapshots.read(spark, path)) == [(1, 1, "a"), (1, 2, "b"), (2, 9, "z"), (3, 4, "d")]
    assert rows(started) == sorted(old, key=str)                # its files are still there
    gone = snapshots.vacuum(spark, path, keep=1)
    assert len(gone) == 2 and rows(snapshots.read(spark, path)) == [(1, 1, "a"), (1, 2, "b"), (2, 9, "z"), (3, 4, "d")]


def test_two_runs_of_one_version_conflict(spark, tmp_path):
    path = str(tmp_path / "ds")
    sinks.write_epochs(frame(spark, [(1, 1, "a")]), path)
    base = snapshots.current(spark, path)
    sinks.write_epochs(frame(spark, [(2, 2, "b")]), path)
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, path, frame(spark, []).schema, lambda old: old, base)
    assert sinks.written_epochs(spark, path) == [1, 2]


def test_upsert_rewrites_only_epochs_of_changed_keys(spark, tmp_path):
    path = str(tmp_path / "ds")
    sinks.write_epochs(frame(spark, [(e, 10 * e + i, "x") for e in range(1, 6) for i in range(3)]), path)
    before = snapshots.current(spark, path)["parts"]
    new, gone = frame(spark, [(5, 21, "moved")]), frame(spark, [(0, 41, ""), (0, 42, ""), (0, 40, ""), (0, 99, "")])
    assert sinks.upsert_by_key(spark, new, path, ["k"], delete_keys=gone) == [2, 4, 5]
    after = snapshots.current(spark, path)["parts"]
    assert {e for e in before if before[e] == after.get(e)} == {"1", "3"} and "4" not in after
    got = {(r.epoch, r.k) for r in snapshots.read(spark, path).collect()}
    assert got == {(e, 10 * e + i) for e in (1, 2, 3, 5) for i in range(3)} - {(2, 21)} | {(5, 21)}
    assert snapshots.read(spark, path, epochs=[1, 7]).select("epoch").distinct().collect()[0].epoch == 1


def test_empty_dataset_and_never_written(spark, tmp_path):
    path = str(tmp_path / "ds")
    assert snapshots.read(spark, path) is None and sinks.written_epochs(spark, path) == []
    sinks.write_epochs(frame(spark, []), path, computed=[4], unsettled=[4])
    assert snapshots.read(spark, path).columns == ["epoch", "k", "v"] and snapshots.read(spark, path).count() == 0
    assert sinks.processed_epochs(spark, path) == [4] and sinks.unsettled_marks(spark, path) == [4]


def test_ordered_files_and_their_faults(spark, tmp_path):
    data = [(e, (7 * i) % 50 if i % 11 else None, f"v{i}") for e in (1, 2) for i in range(200)]
    path = str(tmp_path / "good")
    m = sinks.write_ordered(frame(spark, data).repartition(5), path, ["epoch", "k"], files=6)
    assert len(m["files"]) > 1 and sum(f["rows"] for f in m["files"]) == 400
    assert sinks.order_faults(spark, path).first().asDict() == {"rows": 400, "misplaced": 0, "overlaps": 0}
    first = sinks.read_ordered(spark, path).orderBy("__file", "__row").first()
    assert (first.epoch, first.k) == (1, 0)
    bad = str(tmp_path / "bad")                                  # files that are neither sorted nor apart
    frame(spark, data).repartition(3).write.parquet(f"{bad}/data/r0")
    names = sorted(r[0] for r in spark.read.parquet(f"{bad}/data/r0").select("_metadata.file_name").distinct().collect())
    snapshots.publish_text(spark, f"{bad}/_manifests", "o-0000000001.json", __import__("json").dumps(
        {"run": "r0", "order": ["epoch", "k"], "schema": frame(spark, []).schema.jsonValue(), "files": [{"file": n} for n in names]}))
    faults = sinks.order_faults(spark, bad).first()
    assert faults.misplaced > 100 and faults.overlaps == 2 and faults.rows == 400


def test_state_and_marks_in_one_commit(spark, tmp_path):
    path = str(tmp_path / "ds")
    sinks.write_epochs(frame(spark, [(1, 1, "a"), (2, 2, "b")]), path, computed=[1, 2, 3], unsettled=[2], state={"a": 1})
    sinks.write_epochs(frame(spark, [(2, 2, "c")]), path, computed=[2], state={"b": 2})
    m = snapshots.current(spark, path)
    assert m["unsettled"] == [] and m["state"]["a"] == 1 and m["state"]["b"] == 2 and m["state"]["processed"] == [1, 2, 3]
    assert snapshots.read(spark, path).filter(F.col("v") == "c").count() == 1
