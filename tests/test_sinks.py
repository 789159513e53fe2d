"""Writers: partition-limited merge rewrite, versioned replace, multi-sink isolation."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tempora.sinks import writers as W
from tempora.sinks.evolving import EvolvingTable
from tempora.sinks.migration import Migration
from tempora.sinks.outbox import Outbox
from tempora.sources import paths

SCHEMA = "id long, location_id long, observed_at timestamp_ntz, temperature_c double, created_at timestamp_ntz"


def test_rewrite_only_touched_months(spark, tmp_dir):
    path = f"{tmp_dir}/weather"
    rows = [(1, 1, datetime(2024, 1, 5), 1.0, datetime(2024, 1, 5)), (2, 1, datetime(2024, 2, 5), 2.0,
                                                                       datetime(2024, 2, 5))]
    W.write_table(spark.createDataFrame(rows, SCHEMA), path, cluster_col="location_id")
    import glob
    import os
    jan_files = sorted(glob.glob(f"{path}/obs_period=2024-01/*.parquet"))
    jan_mtime = [os.path.getmtime(f) for f in jan_files]
    batch = spark.createDataFrame([(9, 1, datetime(2024, 2, 5), 20.0, datetime(2024, 3, 1)),
                                   (10, 1, datetime(2024, 2, 6), 3.0, datetime(2024, 3, 1))], SCHEMA)
    months = W.rewrite_partitions(spark, path, batch, ["location_id", "observed_at"], "upsert", ["temperature_c"])
    assert months == ["2024-02"]
    out = {r.observed_at: (r.temperature_c, r.id) for r in spark.read.parquet(path).collect()}
    assert out == {datetime(2024, 1, 5): (1.0, 1), datetime(2024, 2, 5): (20.0, 2), datetime(2024, 2, 6): (3.0, 10)}
    assert [os.path.getmtime(f) for f in sorted(glob.glob(f"{path}/obs_period=2024-01/*.parquet"))] == jan_mtime


def test_stage_is_cleared_after_merge(spark, tmp_dir):
    path, stage = f"{tmp_dir}/t", f"{tmp_dir}/stage"
    W.write_table(spark.createDataFrame([(1, 1, datetime(2024, 1, 5), 1.0, None)], SCHEMA), path)
    batch = spark.createDataFrame([(2, 1, datetime(2024, 1, 5), 5.0, None), (3, 2, datetime(2024, 1, 5), 6.0, None)],
                                  SCHEMA)
    W.stage_merge_clear(spark, path, batch, ["location_id", "observed_at"], stage)
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(stage).count() == 0


def test_versioned_table_rebuilds_from_itself(spark, tmp_dir):
    t = W.VersionedTable(spark, f"{tmp_dir}/v")
    assert t.current() is None
    t.replace(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string"))
    t.replace(t.read().dropDuplicates())
    assert t.read().count() == 2


def test_write_all_isolates_failures(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "x long")

    def bad(_df):
        raise RuntimeError("sink down")

    status = {r.sink: r.status for r in W.write_all(df, {
        "first": bad, "second": lambda d: W.append(d, f"{tmp_dir}/ok")}).collect()}
    assert status == {"first": "failed", "second": "ok"}
    assert spark.read.parquet(f"{tmp_dir}/ok").count() == 1


def test_land_raw_partitions(spark, tmp_dir):
    p = spark.createDataFrame([("economic", "GDP", datetime(2024, 1, 1), '{"observations": []}')],
                              "source string, identifier string, fetched_at timestamp, raw_response string")
    W.land_raw(p, f"{tmp_dir}/raw")
    back = spark.read.json(f"{tmp_dir}/raw")
    assert back.filter(F.col("identifier") == "GDP").count() == 1


def test_day_grain_rewrites_only_touched_days(spark, tmp_dir):
    path = f"{tmp_dir}/daily"
    rows = [(1, 1, datetime(2024, 1, 5), 1.0, None), (2, 1, datetime(2024, 1, 6), 2.0, None)]
    W.write_table(spark.createDataFrame(rows, SCHEMA), path, grain="day")
    batch = spark.createDataFrame([(3, 1, datetime(2024, 1, 6), 9.0, datetime(2024, 2, 1))], SCHEMA)
    assert W.rewrite_partitions(spark, path, batch, ["location_id", "observed_at"], "upsert", ["temperature_c"],
                                grain="day") == ["2024-01-06"]
    assert sorted(r.temperature_c for r in spark.read.parquet(path).collect()) == [1.0, 9.0]


def test_truncate_load_removes_old_partitions(spark, tmp_dir):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")   # even if a session says so
    try:
        W.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "k long, p string"), f"{tmp_dir}/t", partition_by="p")
        W.overwrite(spark.createDataFrame([(3, "b")], "k long, p string"), f"{tmp_dir}/t", partition_by="p")
        assert [r.k for r in spark.read.parquet(f"{tmp_dir}/t").collect()] == [3]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def _moved(spark, root, rows, ranges=4):
    source = spark.createDataFrame(rows, "id long, x double")
    return Migration(spark, root, source, "id", lambda df: df.select("id", (F.col("x") * 2).alias("y")),
                     F.when(F.col("y").isNull(), "no value").when(F.col("id").isNull(), "no key"), ranges)


ROWS = [(i, None if i % 7 == 0 else float(i)) for i in range(1, 40)] + [(None, 1.0), (39, 5.0)]


def _seen(m):
    return (sorted((r.id, r.y) for r in m.migrated().collect()), sorted((r.id or 0, r.reason) for r in m.errors().collect()))


def test_an_ended_migration_resumes_to_the_result_of_one_run(spark, tmp_dir, monkeypatch):
    whole = _moved(spark, f"{tmp_dir}/a", ROWS)
    assert whole.run() == 0
    good, bad = _seen(whole)
    assert good == sorted((i, x * 2) for i, x in ROWS if i and x) and bad == [(0, "no key")] + [(i, "no value") for i in range(7, 40, 7)]
    ended, wrote, plain = _moved(spark, f"{tmp_dir}/b", ROWS), [], Migration._migrate
    assert ended.run(most=1) > 0

    def fails(self, number, *bounds):
        plain(self, number, *bounds)
        wrote.append(number)
        if len(wrote) == 2:  # written, but not entered
            W.overwrite(spark.createDataFrame([], "x int"), f"{self.root}/cursor/{number:08d}")
            paths.rename(spark, f"{self.root}/cursor/{number:08d}/_SUCCESS", f"{self.root}/lost")
            raise RuntimeError("executor lost")

    monkeypatch.setattr(Migration, "_migrate", fails)
    with pytest.raises(RuntimeError):
        _moved(spark, f"{tmp_dir}/b", ROWS).run()
    assert _moved(spark, f"{tmp_dir}/b", ROWS).run() == 0
    assert wrote[0] not in wrote[1:] and wrote.count(wrote[1]) == 2 and 0 not in wrote  # finished ranges are skipped
    assert _seen(_moved(spark, f"{tmp_dir}/b", ROWS)) == (good, bad)
    cursor = whole.cursor().agg(F.sum("rows").alias("n"), F.sum("errors").alias("e")).first()
    assert (cursor.n, cursor.e) == (len(good), len(bad))


def test_a_migration_takes_rows_that_came_later_and_empty_sources(spark, tmp_dir):
    first = _moved(spark, f"{tmp_dir}/a", ROWS)
    first.run()
    more = _moved(spark, f"{tmp_dir}/a", ROWS + [(50, 1.0), (60, None)])
    assert more.run() == 0 and more.run() == 0
    assert _seen(more)[0][-1] == (50, 2.0) and (60, "no value") in _seen(more)[1] and len(_seen(more)[0]) == len(_seen(first)[0])
    none = _moved(spark, f"{tmp_dir}/none", [])
    assert none.run() == 0 and _seen(none) == ([], [])
    keyless = _moved(spark, f"{tmp_dir}/keyless", [(None, 1.0)])
    assert keyless.run() == 0 and _seen(keyless) == ([], [(0, "no key")])


def test_an_outbox_retries_the_failed_sink_alone(spark, tmp_dir):
    sent, down = [], ["b"]

    def sink(name):
        def send(df):
            if name in down:
                raise RuntimeError("sink down")
            sent.append((name, sorted(r.x for r in df.collect())))
        return send

    sinks, batch = {n: sink(n) for n in "abc"}, spark.createDataFrame([(1,), (2,)], "x long")
    assert Outbox(spark, f"{tmp_dir}/box").deliver("one", batch, sinks) == ["b"]
    assert Outbox(spark, f"{tmp_dir}/box").deliver("one", batch.limit(0), sinks) == ["b"]  # the rows are those first staged
    down.clear()
    box = Outbox(spark, f"{tmp_dir}/box")
    assert box.deliver("one", batch, sinks) == [] and box.deliver("one", batch, sinks) == []
    assert sent == [("a", [1, 2]), ("c", [1, 2]), ("b", [1, 2])]
    assert {(r.sink, r.attempts, r.status) for r in box.status("one").collect()} == {("a", 1, "ok"), ("b", 3, "ok"), ("c", 1, "ok")}
    assert "sink down" in box.attempts("one").filter("status = 'failed'").first().error
    assert box.attempts("two").count() == 0 and box.deliver("two", batch.limit(0), {"a": sink("a")}) == []


def test_a_table_grows_a_column_without_a_rewrite(spark, tmp_dir):
    import glob
    import os
    root, t = f"{tmp_dir}/t", datetime(2024, 1, 5)
    first = [{"id": ("bigint", None), "observed_at": ("timestamp_ntz", None)}]
    later = first + [{"rain": ("double", 0.5)}, {"kind": ("string", "old"), "n": ("int", None)}]
    assert EvolvingTable(spark, root, later).read().count() == 0
    EvolvingTable(spark, root, first).append(spark.createDataFrame([(1, t)], "id long, observed_at timestamp_ntz"))
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}
    table = EvolvingTable(spark, root, later)
    table.append(spark.createDataFrame([(2, t, None), (3, t, 2.0)], "id long, observed_at timestamp_ntz, rain double"), version=2)
    table.append(spark.createDataFrame([(4, datetime(2024, 2, 1), 3.0, None, 7)], "id long, observed_at timestamp_ntz, rain float, kind string, n long"))
    assert sorted((r.id, r.rain, r.kind, r.n) for r in table.read().collect()) == [
        (1, 0.5, "old", None), (2, None, "old", None), (3, 2.0, "old", None), (4, 3.0, None, 7)]
    assert table.read().columns == ["id", "observed_at", "rain", "kind", "n"]
    assert before.items() <= {f: os.path.getmtime(f) for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}.items()
    with pytest.raises(ValueError):
        EvolvingTable(spark, root, first + first)
