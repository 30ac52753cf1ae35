"""The message log: positions, resume, row batches, late files, replays."""

import os

import pytest

from ledgerspark import api
from ledgerspark.session import local_path, scratch_path
from ledgerspark.streaming import land, positions
from tests.test_streaming import _files, _msg


def _steps(spark, out):
    return sorted(r.step for r in land.read_landing(spark, out).collect())


def _add(folder, name, lines):
    with open(os.path.join(local_path(folder), name), "w") as fh:
        fh.write("".join(x + "\n" for x in lines))


@pytest.fixture
def log(spark):
    src = _files(spark, [[_msg(step=k) for k in range(7)], [], [_msg(step=k) for k in range(7, 10)]])
    return positions.MessageLog(spark, src, scratch_path(spark, "log"))


def test_bounded_calls_go_on(spark, log):
    out = scratch_path(spark, "landing")
    assert [positions.land_next(log, out, "t", max_rows=4).landed for _ in range(4)] == [4, 4, 2, 0]
    assert _steps(spark, out) == list(range(10))
    assert sorted({r.batch_id - positions.FIRST_BATCH for r in land.read_landing(spark, out).collect()}) == [0, 4, 8]


def test_a_late_file_comes_last_whatever_its_name(spark, log):
    out = scratch_path(spark, "landing")
    positions.land_next(log, out, "t", max_rows=9)
    _add(log.folder, "a-first-by-name.json", [_msg(step=20), _msg(step=21)])
    positions.land_next(log, out, "t", max_rows=2)
    assert _steps(spark, out) == [*range(10), 20]


def test_a_run_that_died_before_its_commit_is_replaced(spark, log, monkeypatch):
    out = scratch_path(spark, "landing")
    monkeypatch.setattr(positions.MessageLog, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        positions.land_next(log, out, "t", max_rows=4)
    monkeypatch.undo()
    assert positions.land_next(log, out, "t", max_rows=4).landed == 4
    assert _steps(spark, out) == [0, 1, 2, 3]


def test_batches_of_rows_with_bad_messages(spark):
    src = _files(spark, [[_msg(step=1), "{", _msg(step=2)], ["nonsense", _msg(step=3)]])
    out = scratch_path(spark, "landing")
    log = positions.MessageLog(spark, src, scratch_path(spark, "log"))
    run = positions.land_next(log, out, "t", batch_rows=2)
    assert (run.landed, run.quarantined, run.batches) == (3, 2, 3)
    got = {r.step: r.batch_id - positions.FIRST_BATCH for r in land.read_landing(spark, out).collect()}
    assert got == {1: 0, 2: 2, 3: 4}


def test_small_batches_share_folders(spark, monkeypatch):
    monkeypatch.setattr(positions, "FOLDER_ROWS", 40)
    src = _files(spark, [[_msg(step=k) if k % 7 else "{" for k in range(60)], [_msg(step=k) for k in range(60, 100)]])
    out, bad = scratch_path(spark, "landing"), scratch_path(spark, "bad")
    log = positions.MessageLog(spark, src, scratch_path(spark, "log"))
    positions.land_next(log, out, "t", max_rows=50, batch_rows=3, quarantine_path=bad)
    positions.land_next(log, out, "t", batch_rows=3, quarantine_path=bad)
    want = {k: k // 3 * 3 if k < 50 else 50 + (k - 50) // 3 * 3 for k in range(100)}
    got = {r.step: r.batch_id - positions.FIRST_BATCH for r in land.read_landing(spark, out).collect()}
    assert got == {k: b for k, b in want.items() if k >= 60 or k % 7}
    lost = sorted(r.batch_id - positions.FIRST_BATCH for r in land.read_quarantine(spark, bad).collect())
    assert lost == sorted(want[k] for k in range(0, 60, 7))
    for zone in (out, bad):
        folders = {int(f[len("batch_id="):]) - positions.FIRST_BATCH for f in os.listdir(local_path(zone)) if f.startswith("batch_id=")}
        assert folders <= {0, 40, 50, 80}


def test_lines_keep_their_place_in_a_file_read_in_blocks(spark):
    src = _files(spark, [["x" * 50 + str(k) for k in range(400)], ["y"]])
    log = positions.MessageLog(spark, src, scratch_path(spark, "log"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    try:
        assert log.refresh() == 401
        got = sorted((r.row, r.value) for r in log.rows(37, 401).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(k, "x" * 50 + str(k)) for k in range(37, 400)] + [(400, "y")]


def test_an_empty_folder_and_an_empty_zone(spark):
    log = positions.MessageLog(spark, _files(spark, []), scratch_path(spark, "log"))
    out = scratch_path(spark, "landing")
    assert positions.land_next(log, out, "t").landed == 0
    assert land.read_landing(spark, out).count() == 0


def test_an_all_bad_batch_leaves_a_readable_zone(spark):
    out = scratch_path(spark, "landing")
    r = land.land_stream(land.file_source(spark, _files(spark, [["{", "?"]])), out, scratch_path(spark, "ckpt"), "t")
    assert (r.landed, r.quarantined) == (0, 2)
    assert land.read_landing(spark, out).count() == 0


def test_consume_by_rows(spark, log):
    out, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    take = lambda **k: api.consume(spark, out, ckpt, "t", source_path=log.folder, **k)
    assert (take(max_messages=3), take(max_messages=3)) == (3, 3)
    assert take(batch_size=2, batch_timeout=0) == 4
    assert _steps(spark, out) == list(range(10))
