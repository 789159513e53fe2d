"""Stream forms equal their batch forms; the foreachBatch upsert is idempotent."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tempora.sinks import writers as W
from tempora.streaming import streams as S
from tempora.streaming.epochs import EpochLedger

SCHEMA = "id long, location_id long, observed_at timestamp_ntz, temperature_c double, created_at timestamp_ntz"


def test_dedupe_and_cutoff_stream(spark, tmp_dir):
    rows = [(1, 1, datetime(2024, 1, 1), 1.0, None), (1, 1, datetime(2024, 1, 1), 1.0, None),
            (2, 1, datetime(2024, 1, 2), 2.0, None), (3, 1, datetime(2030, 1, 1), 3.0, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_dir}/in")
    s = S.event_time(S.read_parquet_stream(spark, f"{tmp_dir}/in", SCHEMA), "observed_at")
    s = S.future_cutoff(s, "observed_at", as_of="2024-06-01 00:00:00")
    out = S.run_to_parquet(spark, S.dedupe_stream(s, ["id"], "observed_at"), "t")
    assert sorted(r.id for r in out.collect()) == [1, 2]


def test_event_queries_read_a_table_of_several_files(spark, tmp_dir):
    from tempora.plans import streams as Q
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_dir}/sf/events.parquet")
    assert Q.events_dedupe_stream(spark, f"{tmp_dir}/sf").count() == events.select("event_id").distinct().count()
    daily = Q.events_daily_stream(spark, f"{tmp_dir}/sf")
    assert daily.agg(F.sum("n")).first()[0] == events.count()
    assert {r.closed for r in daily.select("closed").distinct().collect()} == {True, False}


def test_backlog_in_many_micro_batches_loses_nothing(spark, tmp_dir):
    """Files in no order of time, several micro-batches: every event is counted, and kept once."""
    from tempora.plans import streams as Q
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_dir}/sf/events.parquet")
    n, rows = events.count(), events.count() // 5
    assert Q.events_dedupe_stream(spark, f"{tmp_dir}/sf", rows).count() == n
    assert Q.events_redelivered_stream(spark, f"{tmp_dir}/sf", rows).count() == n
    daily = Q.events_daily_stream(spark, f"{tmp_dir}/sf", rows)
    whole = events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d"), "event_type").count()
    assert {(r.day_start, r.event_type, r.n) for r in daily.collect()} == {tuple(r) for r in whole.collect()}


def test_late_rows_are_kept_aside_and_an_ended_delivery_goes_on(spark, tmp_dir, monkeypatch):
    import pytest

    from tempora.streaming.replay import Replay, day_chunks
    assert day_chunks([("b", 5), ("a", 3), ("c", 9), ("d", 1)], 8) == [("a", "b"), ("c", "c"), ("d", "d")]
    schema = "id long, observed_at timestamp_ntz, temperature_c double"

    def rows(*made):
        return spark.createDataFrame([(i, t, 1.0) for i, t in made], schema)

    def make():
        return Replay(spark, f"{tmp_dir}/r", schema, "observed_at", "1 hour",
                      lambda s: S.daily_rollup_stream(s.withColumn("k", F.lit(1)), "k", "observed_at", "temperature_c", "1 hour"),
                      windowed=True, chunk_rows=2)

    days = [datetime(2024, 1, d, h) for d in (3, 1, 2, 4) for h in (1, 2)]
    runs, plain = [], Replay._run

    def fails_third(self):
        runs.append(1)
        if len(runs) == 3:
            raise RuntimeError("executor lost")
        plain(self)

    monkeypatch.setattr(Replay, "_run", fails_third)
    with pytest.raises(RuntimeError):
        make().deliver(rows(*enumerate(days)), "one")
    monkeypatch.setattr(Replay, "_run", plain)
    replay = make()
    replay.deliver(rows(*enumerate(days)), "one")
    assert {r.day_start.day: r.n for r in replay.written().collect()} == {1: 2, 2: 2, 3: 2}
    replay.deliver(rows((20, datetime(2024, 1, 2, 5)), (21, datetime(2024, 1, 4, 0)), (22, None), (23, datetime(2024, 1, 6))), "two")
    assert {(r.id, r.delivery, r.reason) for r in replay.late().collect()} == {
        (20, "two", "behind the watermark"), (22, "two", "no time")}
    assert replay.taken().count() + replay.late().count() == len(days) + 4
    assert {r.day_start.day: r.n for r in replay.written().collect()} == {1: 2, 2: 2, 3: 2, 4: 3}


def test_upsert_stream_matches_batch(spark, tmp_dir):
    table = f"{tmp_dir}/table"
    W.write_table(spark.createDataFrame([(1, 1, datetime(2024, 1, 1), 1.0, datetime(2024, 1, 1))], SCHEMA), table)
    spark.createDataFrame([(5, 1, datetime(2024, 1, 1), 9.0, datetime(2024, 2, 1)),
                           (6, 2, datetime(2024, 1, 1), 4.0, datetime(2024, 2, 1))], SCHEMA) \
        .write.parquet(f"{tmp_dir}/in")
    stream = S.read_parquet_stream(spark, f"{tmp_dir}/in", SCHEMA)
    S.upsert_stream(stream, table, f"{tmp_dir}/ckpt", ["location_id", "observed_at"], ["temperature_c"])
    S.upsert_stream(S.read_parquet_stream(spark, f"{tmp_dir}/in", SCHEMA), table, f"{tmp_dir}/ckpt2",
                    ["location_id", "observed_at"], ["temperature_c"])    # replay: same table
    out = {r.location_id: (r.temperature_c, r.id) for r in spark.read.parquet(table).collect()}
    assert out == {1: (9.0, 1), 2: (4.0, 6)}


def _epoch(spark, table, query="q"):
    return EpochLedger(spark, table, query)


MERGE = dict(mode="insert_only", ts_col="observed_at")  # not idempotent: rows of one batch may share a key


def test_an_epoch_counts_once(spark, tmp_dir):
    table, t = f"{tmp_dir}/table", datetime(2024, 1, 1)
    W.write_table(spark.createDataFrame([(1, 1, t, 1.0, t)], SCHEMA), table)
    batch = spark.createDataFrame([(5, 2, t, 9.0, t), (6, 2, t, 4.0, t), (7, 3, datetime(2024, 3, 1), 4.0, t)], SCHEMA)
    for _ in range(2):
        _epoch(spark, table).apply(batch, 0, ["location_id"], **MERGE)
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == [1, 5, 6, 7]
    assert _epoch(spark, table).apply(spark.createDataFrame([], SCHEMA), 1, ["location_id"], **MERGE) is False
    made = {(r.query, r.epoch, r.rows, tuple(r.periods)) for r in EpochLedger.entries(spark, table).collect()}
    assert made == {("q", 0, 3, ("2024-01", "2024-03")), ("q", 1, 0, ())}


@pytest.mark.parametrize("when", ["staging", "copying", "after the copy"])
def test_an_ended_epoch_is_finished(spark, tmp_dir, monkeypatch, when):
    table, t = f"{tmp_dir}/table", datetime(2024, 1, 1)
    W.write_table(spark.createDataFrame([(1, 1, t, 1.0, t), (2, 9, datetime(2024, 2, 1), 2.0, t)], SCHEMA), table)
    batch = spark.createDataFrame([(5, 2, t, 9.0, t), (6, 2, t, 4.0, t), (7, 3, datetime(2024, 2, 1), 4.0, t)], SCHEMA)
    name = "write_table" if when == "staging" else "copy_partitions"
    plain = getattr(W, name)

    def ends(*args, **named):
        if when == "copying":  # one of the two months only
            staged = spark.read.parquet(f"{args[1]}/merged").filter("obs_period = '2024-01'")
            staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("obs_period").parquet(args[2])
        else:
            plain(*args, **named)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(W, name, ends)
    with pytest.raises(RuntimeError):
        _epoch(spark, table).apply(batch, 0, ["location_id"], **MERGE)
    monkeypatch.setattr(W, name, plain)
    assert _epoch(spark, table).apply(batch, 0, ["location_id"], **MERGE)
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == [1, 2, 5, 6, 7]
    assert not _epoch(spark, table).apply(batch, 0, ["location_id"], **MERGE)


def test_a_stream_restarted_within_a_batch(spark, tmp_dir, monkeypatch):
    table, t = f"{tmp_dir}/table", datetime(2024, 1, 1)
    W.write_table(spark.createDataFrame([(1, 1, t, 1.0, t)], SCHEMA), table)
    spark.createDataFrame([(5, 1, t, 9.0, t), (6, 2, t, 4.0, t)], SCHEMA).write.parquet(f"{tmp_dir}/in")
    plain, done = W.copy_partitions, []

    def ends(*args):
        plain(*args)
        if not done.append(1) and len(done) == 1:
            raise RuntimeError("executor lost")

    monkeypatch.setattr(W, "copy_partitions", ends)

    def run():
        S.upsert_stream(S.read_parquet_stream(spark, f"{tmp_dir}/in", SCHEMA), table, f"{tmp_dir}/ckpt", ["location_id", "observed_at"], ["temperature_c"])

    with pytest.raises(Exception, match="executor lost"):
        run()
    run()
    run()  # nothing new
    assert {r.location_id: (r.temperature_c, r.id) for r in spark.read.parquet(table).collect()} == {1: (9.0, 1), 2: (4.0, 6)}
    assert [(r.epoch, r.rows) for r in EpochLedger.entries(spark, table).collect()] == [(0, 2)] and len(done) == 2


def test_daily_rollup_stream_emits_closed_days(spark, tmp_dir):
    rows = [(i, 1, datetime(2024, 1, 1 + i // 4, (i % 4) * 6), float(i), None) for i in range(12)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_dir}/in")
    s = S.event_time(S.read_parquet_stream(spark, f"{tmp_dir}/in", SCHEMA), "observed_at")
    out = S.run_to_parquet(spark, S.daily_rollup_stream(s, "location_id", "observed_at", "temperature_c"), "r")
    got = {r.day_start.day: (r.n, r.sum_temperature_c) for r in out.collect()}
    assert got == {1: (4, 6.0), 2: (4, 22.0)}          # day 3 is still open under the watermark
    assert out.agg(F.sum("n")).first()[0] == 8
