"""Merge, insert-ignore, MERGE-insert and incremental policies on literal rows."""

from datetime import datetime

from pyspark.sql import functions as F

from tempora.operators import merge as M

SCHEMA = "id long, location_id long, observed_at timestamp_ntz, temperature_c double, created_at timestamp_ntz"
KEY = ["location_id", "observed_at"]
T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def test_upsert_last_write_wins_keeps_created_at(spark):
    target = spark.createDataFrame([(1, 1, T0, 10.0, T0), (2, 1, T1, 11.0, T1)], SCHEMA)
    batch = spark.createDataFrame([(7, 1, T1, 20.0, T2), (8, 1, T1, 21.0, datetime(2024, 1, 4)),
                                   (9, 2, T0, 5.0, T2)], SCHEMA)
    out = {(r.location_id, r.observed_at): r for r in
           M.upsert_last_wins(target, batch, KEY, ["temperature_c"]).collect()}
    assert len(out) == 3
    assert out[(1, T1)].temperature_c == 21.0          # newest batch row wins
    assert out[(1, T1)].created_at == T1 and out[(1, T1)].id == 2   # identity and creation kept
    assert out[(1, T0)].temperature_c == 10.0
    assert out[(2, T0)].id == 9


def test_insert_ignore_first_wins_and_skips_existing(spark):
    target = spark.createDataFrame([(1, 1, T0, 10.0, T0)], SCHEMA)
    batch = spark.createDataFrame([(5, 1, T0, 99.0, T0), (6, 1, T1, 1.0, T2), (7, 1, T1, 2.0, T1)], SCHEMA)
    out = {(r.location_id, r.observed_at): r.temperature_c for r in M.insert_ignore(target, batch, KEY).collect()}
    assert out == {(1, T0): 10.0, (1, T1): 2.0}
    assert M.inserted_rows(target, batch, KEY).count() == 2


def test_merge_insert_only_keeps_batch_duplicates(spark):
    target = spark.createDataFrame([(1, 1, T0, 10.0, T0)], SCHEMA)
    batch = spark.createDataFrame([(5, 1, T0, 99.0, T0), (6, 1, T1, 1.0, T2), (7, 1, T1, 2.0, T1)], SCHEMA)
    assert M.merge_insert_only(target, batch, KEY).count() == 3


def test_incremental_policies(spark):
    target = spark.createDataFrame([(1, 1, T1, 10.0, T1), (2, 2, T0, 1.0, T0)], SCHEMA)
    src = spark.createDataFrame([(3, 1, T0, 0.0, T2), (4, 1, T1, 0.0, T2), (5, 1, T2, 0.0, T2),
                                 (6, 2, T1, 0.0, T2)], SCHEMA)
    glob = sorted(r.id for r in M.incremental_source(target, src, "observed_at").collect())
    assert glob == [5]                                   # equal and older rows dropped for every key
    per_key = sorted(r.id for r in M.incremental_source(target, src, "observed_at", "per_key_hwm",
                                                          entity="location_id").collect())
    assert per_key == [5, 6]
    wm = sorted(r.id for r in M.incremental_source(target, src, "observed_at", "watermark", delay="1 day").collect())
    assert wm == [4, 5, 6]
    empty = spark.createDataFrame([], SCHEMA)
    assert M.incremental_source(empty, src, "observed_at").count() == 4   # empty target -> full load


def test_get_or_create_assigns_new_ids(spark):
    dim = spark.createDataFrame([(3, "A", 1.0, 2.0)], "id long, name string, latitude double, longitude double")
    cand = spark.createDataFrame([(0, "A", 1.0, 2.0), (0, "B", 5.0, 6.0), (0, "C", 0.5, 9.0), (0, "B2", 5.0, 6.0)],
                                 "id long, name string, latitude double, longitude double")
    out = {(r.latitude, r.longitude): r.id for r in M.get_or_create(dim, cand, ["latitude", "longitude"]).collect()}
    assert out == {(0.5, 9.0): 4, (5.0, 6.0): 5}


def test_normalise_and_add_columns(spark):
    df = spark.createDataFrame([("X", None, 1.5, T0)], "series_id string, series_name string, value double, "
                                                        "observed_at timestamp_ntz")
    r = M.normalise_economic(df).first()
    assert r.series_name == "" and r.observed_at == "2024-01-01T00:00:00"
    assert M.add_missing_columns(df, {"precipitation": "double"}).schema["precipitation"].dataType.simpleString() \
        == "double"
    assert M.add_missing_columns(df, {"value": "string"}).select(F.col("value")).first()[0] == 1.5
