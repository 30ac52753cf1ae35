import json
import os

from ledgerspark.session import local_path, scratch_path
from ledgerspark.sources.files import read_table
from ledgerspark.spec import RAW_COLUMNS, RAW_SCHEMA
from ledgerspark.streaming import land, messages

ROW = (1, "TRANSFER", 100.5, "C1", 200.0, 99.5, "C2", 0.0, 100.5, 1, 0)


def _msg(**over):
    d = dict(zip(RAW_COLUMNS, ROW))
    d.update(over)
    return json.dumps(d)


def _files(spark, batches):
    path = scratch_path(spark, "topic")
    os.makedirs(local_path(path), exist_ok=True)
    for i, lines in enumerate(batches):
        with open(os.path.join(local_path(path), f"batch-{i:03d}.json"), "w") as fh:
            fh.write("".join(line + "\n" for line in lines))
    return path


def _run(spark, src, out=None, ckpt=None, quarantine=None):
    out = out or scratch_path(spark, "landing")
    ckpt = ckpt or scratch_path(spark, "ckpt")
    r = land.land_stream(land.file_source(spark, src), out, ckpt, "kafka:payments", quarantine_path=quarantine)
    return r, out


def test_message_types(spark):
    df = spark.createDataFrame([ROW], RAW_SCHEMA)
    text = messages.to_messages(df).first().value
    d = json.loads(text)
    assert isinstance(d["step"], int) and isinstance(d["isFraud"], int)
    assert isinstance(d["amount"], float) and d["amount"] == 100.5
    back = messages.parse_messages(messages.to_messages(df)).select(*RAW_COLUMNS).first()
    assert tuple(back) == ROW


def test_partitioned_landing(spark):
    src = _files(spark, [[_msg(type="CASH_OUT", amount=10.0), _msg(type="TRANSFER", amount=30.0)]])
    r, out = _run(spark, src)
    assert r.landed == 2
    batches = [b for b in os.listdir(local_path(out)) if b.startswith("batch_id=")]
    assert len(batches) == 1
    batch_dir = os.path.join(local_path(out), batches[0])
    dirs = sorted(d for d in os.listdir(batch_dir) if d.startswith("type="))
    assert dirs == ["type=CASH_OUT", "type=TRANSFER"]
    rows = read_table(spark, out).collect()
    assert {x.source_file for x in rows} == {"kafka:payments"}
    assert all(x.ingestion_timestamp is not None for x in rows)
    # the partition value lives in the path, not in the data files
    part = [f for f in os.listdir(os.path.join(batch_dir, "type=CASH_OUT")) if f.endswith(".parquet")][0]
    raw = spark.read.parquet(os.path.join(batch_dir, "type=CASH_OUT", part))
    assert "type" not in raw.columns


def test_empty_input_writes_nothing(spark):
    src = _files(spark, [])
    r, out = _run(spark, src)
    assert r.landed == 0
    assert not os.path.exists(local_path(out)) or not os.listdir(local_path(out))


def test_same_row_in_two_batches_is_kept_twice(spark):
    row = _msg(type="DEBIT", amount=5.0)
    src = _files(spark, [[row], [row]])
    r, out = _run(spark, src)
    assert r.landed == 2 and r.batches >= 2
    assert read_table(spark, out).count() == 2


def test_rerun_over_same_input_adds_nothing(spark):
    src = _files(spark, [[_msg()], [_msg(step=2)]])
    out, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    first, _ = _run(spark, src, out, ckpt)
    second, _ = _run(spark, src, out, ckpt)
    assert (first.landed, second.landed) == (2, 0)
    assert read_table(spark, out).count() == 2


def test_bad_messages_are_quarantined(spark):
    bad_text = '{"step": 1, "type": "TRANS'
    wrong_type = _msg(step="one")
    missing = json.dumps({k: v for k, v in json.loads(_msg()).items() if k != "amount"})
    src = _files(spark, [[_msg(), bad_text, wrong_type, missing]])
    q = scratch_path(spark, "quarantine")
    r, out = _run(spark, src, quarantine=q)
    assert (r.landed, r.quarantined) == (1, 3)
    assert read_table(spark, q).count() == 3


def test_bounded_landing_takes_first_messages_by_offset(spark):
    rows = [tuple([i] + list(ROW[1:])) for i in range(10)]
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    msgs = messages.to_messages(df, key="step").withColumn("offset", messages.F.col("key").cast("long"))
    out = scratch_path(spark, "landing")
    r = land.land_bounded(msgs, out, "kafka:payments", max_rows=4, order_by=("offset",))
    assert r.landed == 4
    assert sorted(x.step for x in read_table(spark, out).collect()) == [0, 1, 2, 3]


def test_periodic_trigger_stops_when_idle(spark):
    src = _files(spark, [[_msg()], [_msg(step=2)]])
    out, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    r = land.land_stream(
        land.file_source(spark, src), out, ckpt, "kafka:payments",
        available_now=False, processing_time="200 milliseconds", idle_timeout_s=2.0, timeout_s=60,
    )
    assert r.landed == 2
    assert read_table(spark, out).count() == 2


def test_stream_and_batch_give_the_same_rows(spark):
    from ledgerspark.sources.sinks import write_table

    rows = [tuple([i, t] + list(ROW[2:])) for i, t in enumerate(["TRANSFER", "CASH_OUT", "DEBIT", "PAYMENT"])]
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    batch_dir = scratch_path(spark, "bronze")
    write_table(df, batch_dir, partition_by=["type"])
    src = _files(spark, [[json.dumps(dict(zip(RAW_COLUMNS, r))) for r in rows]])
    _, out = _run(spark, src)
    batch = sorted(tuple(r) for r in read_table(spark, batch_dir).select(*RAW_COLUMNS).collect())
    stream = sorted(tuple(r) for r in read_table(spark, out).select(*RAW_COLUMNS).collect())
    assert batch == stream == sorted(rows)
    assert dict(read_table(spark, batch_dir).select(*RAW_COLUMNS).dtypes) == dict(
        read_table(spark, out).select(*RAW_COLUMNS).dtypes
    )
