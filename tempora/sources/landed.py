"""Readers for landed API payloads and CSV files (SRC-1..SRC-6, SRC-10, FN-17).

Every reader takes a path (file, folder or glob) and declares its schema; nothing is
inferred. Parallel arrays become rows with ``arrays_zip`` + ``inline`` on executors.
Payloads are read one file per record, the unit the source API returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.functions.constants import RETAIL_DATA_TYPE, TARGET_NAICS

# ---------------------------------------------------------------- schemas

ECONOMIC_PAYLOAD = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("observations", T.ArrayType(T.StructType([
        T.StructField("realtime_start", T.StringType()),
        T.StructField("realtime_end", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
])

HOURLY_FIELDS = ["time", "temperature_2m", "windspeed_10m", "pressure_msl", "relative_humidity_2m", "precipitation"]
HOURLY_PAYLOAD = T.StructType([
    T.StructField("location_id", T.LongType()),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(f, T.ArrayType(T.DoubleType())) for f in HOURLY_FIELDS[1:]])),
])
RENAMES = {"temperature_2m": "temperature_c", "windspeed_10m": "wind_speed", "pressure_msl": "pressure",
           "relative_humidity_2m": "humidity", "precipitation": "precipitation"}

LOCATION_CSV = "id long, name string, country string, region string, latitude double, longitude double"
SERIES_CSV = "series_id string, series_name string"


def _json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


# ---------------------------------------------------------------- economic (SRC-1)

def read_economic_json(spark: SparkSession, path: str, series_id: str | None = None,
                       start: str | None = None, end: str | None = None) -> DataFrame:
    """FRED-style payloads -> (series_id, value, observed_at). Rows whose value is the
    missing-value sentinel '.' are skipped; the optional date window is inclusive.
    ``series_id`` fills payloads that do not carry one."""
    raw = _json(spark, path, ECONOMIC_PAYLOAD)
    sid = F.coalesce(F.col("series_id"), F.lit(series_id))
    rows = raw.select(sid.alias("series_id"), F.inline("observations"))
    rows = rows.filter(F.col("value") != ".")
    out = rows.select("series_id", F.col("value").try_cast("double").alias("value"),
                      F.col("date").try_cast("timestamp_ntz").alias("observed_at"))
    out = out.filter(F.col("value").isNotNull() & F.col("observed_at").isNotNull())  # see rejected_economic_rows
    if start:
        out = out.filter(F.col("observed_at") >= F.to_timestamp_ntz(F.lit(start)))
    if end:
        out = out.filter(F.col("observed_at") <= F.to_timestamp_ntz(F.lit(end)))
    return out


def rejected_economic_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that ``read_economic_json`` cannot take, as landed, with their file and the reason."""
    raw = _json(spark, path, ECONOMIC_PAYLOAD).withColumn("file", F.input_file_name())
    rows = raw.select("file", "series_id", F.inline("observations"))
    bad_time = F.col("date").try_cast("timestamp_ntz").isNull()
    bad_value = F.col("value").try_cast("double").isNull()
    return rows.filter(F.coalesce(F.col("value") != ".", F.lit(True)) & (bad_time | bad_value)).select(
        "file", "series_id", "date", "value", F.when(bad_time, "time").otherwise("value").alias("reason"))


def empty_economic_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payloads with no observations (the source raises for them): a quarantine list."""
    raw = _json(spark, path, ECONOMIC_PAYLOAD).withColumn("file", F.input_file_name())
    return raw.filter(F.coalesce(F.size("observations"), F.lit(-1)) <= 0).select("series_id", "file")


# ---------------------------------------------------------------- weather (SRC-2, SRC-3)

def _hourly_rows(raw: DataFrame) -> DataFrame:
    """Zip the parallel arrays; an absent array counts as empty (its values pad as NULL),
    since arrays_zip of a NULL array would drop the whole payload."""
    def arr(f):
        typ = "array<string>" if f == "time" else "array<double>"
        return F.coalesce(F.col(f"hourly.{f}"), F.array().cast(typ)).alias(f)
    zipped = F.arrays_zip(*[arr(f) for f in HOURLY_FIELDS])
    return raw.select("location_id", F.inline(zipped))


def _complete() -> F.Column:
    """A forecast payload with a readable time array that no required array falls short of; never NULL,
    so every payload is either read or quarantined."""
    ok = F.size("hourly.time") >= 0
    for f in HOURLY_FIELDS[1:5]:
        ok = ok & (F.coalesce(F.size(f"hourly.{f}"), F.lit(-1)) >= F.size("hourly.time"))
    times = F.forall("hourly.time", lambda t: t.try_cast("timestamp_ntz").isNotNull())
    return F.coalesce(ok & times, F.lit(False))


def read_weather_forecast_json(spark: SparkSession, path: str) -> DataFrame:
    """Forecast payloads -> one row per hour. Missing or NULL precipitation -> 0.0.
    The four other arrays are index-strict: payloads where one is shorter than ``time``
    are returned by ``short_hourly_payloads`` and left out here."""
    raw = _json(spark, path, HOURLY_PAYLOAD)
    rows = _hourly_rows(raw.filter(_complete()))
    return rows.select(
        "location_id",
        *[F.col(src).alias(dst) for src, dst in RENAMES.items() if src != "precipitation"],
        F.coalesce(F.col("precipitation"), F.lit(0.0)).alias("precipitation"),
        F.to_timestamp_ntz(F.col("time")).alias("observed_at"))


def short_hourly_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The payloads that ``read_weather_forecast_json`` leaves out: short, truncated or without hours,
    or with a time that does not parse."""
    raw = _json(spark, path, HOURLY_PAYLOAD).withColumn("file", F.input_file_name())
    return raw.filter(~_complete()).select("location_id", F.coalesce(F.size("hourly.time"), F.lit(-1)).alias("hours"), "file")


def read_weather_archive_json(spark: SparkSession, path: str) -> DataFrame:
    """Archive payloads -> one row per hour; every measure NULL-padded when its array is
    short, NULL precipitation stays NULL, payloads without ``hourly`` give no rows.
    Local wall-clock times are kept as TIMESTAMP_NTZ. What is left out is in ``empty_archive_payloads`` or
    ``rejected_archive_rows``."""
    raw = _json(spark, path, HOURLY_PAYLOAD).filter(F.col("hourly").isNotNull())
    rows = _hourly_rows(raw).filter(F.col("time").try_cast("timestamp_ntz").isNotNull())
    return rows.select(
        "location_id",
        *[F.col(src).alias(dst) for src, dst in RENAMES.items()],
        F.to_timestamp_ntz(F.col("time")).alias("observed_at"))


def _has_hours() -> F.Column:
    return F.coalesce(F.size("hourly.time"), F.lit(-1)) > 0


def empty_archive_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Archive payloads without hours: no ``hourly``, no or empty ``time``, or no JSON at all."""
    raw = _json(spark, path, HOURLY_PAYLOAD).withColumn("file", F.input_file_name())
    return raw.filter(~_has_hours()).select("location_id", "file")


def rejected_archive_rows(spark: SparkSession, path: str) -> DataFrame:
    """Hours of the other archive payloads that ``read_weather_archive_json`` cannot take: their time does not parse."""
    raw = _json(spark, path, HOURLY_PAYLOAD).withColumn("file", F.input_file_name()).filter(_has_hours())
    rows = raw.select("file", "location_id", F.inline(F.arrays_zip(*[
        F.coalesce(F.col(f"hourly.{f}"), F.array().cast("array<string>" if f == "time" else "array<double>")).alias(f)
        for f in HOURLY_FIELDS])))
    return rows.filter(F.col("time").try_cast("timestamp_ntz").isNull()).withColumn("reason", F.lit("time"))


# ---------------------------------------------------------------- retail (SRC-4)

def _retail_rows(spark: SparkSession, path: str) -> DataFrame:
    """The monthly sales rows of the target codes as landed, with their file and what parses of value and month."""
    text = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    rows = text.select("file", F.posexplode(F.from_json("value", "array<array<string>>")).alias("pos", "r"))
    body = rows.filter(F.col("pos") > 0).select(
        "file", F.col("r")[0].alias("cell_value"), F.col("r")[1].alias("data_type_code"),
        F.col("r")[2].alias("category_code"), F.col("r")[3].alias("time"))
    kept = body.filter((F.col("data_type_code") == RETAIL_DATA_TYPE) &
                       F.col("category_code").isin(list(TARGET_NAICS)))
    ts = F.try_to_timestamp(F.col("time"), F.lit("yyyy-MM")).cast("timestamp_ntz")
    val = F.when(F.col("cell_value").isNull(), F.lit(0.0)).otherwise(F.col("cell_value").try_cast("double"))
    return kept.withColumn("value", val).withColumn("observed_at", ts)


def rejected_retail_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that ``read_retail_json`` skips because month or value does not parse, as landed, with file and reason."""
    rows = _retail_rows(spark, path).filter(F.col("observed_at").isNull() | F.col("value").isNull())
    return rows.select("file", "category_code", "time", "cell_value",
                       F.when(F.col("observed_at").isNull(), "time").otherwise("value").alias("reason"))


def unparsed_retail_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Files that are no array of arrays, or hold nothing."""
    text = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    return text.filter(F.coalesce(F.size(F.from_json("value", "array<array<string>>")), F.lit(-1)) <= 0).select("file")


def read_retail_json(spark: SparkSession, path: str) -> DataFrame:
    """Census-style payloads: an array of string arrays whose first row is the header
    (cell_value, data_type_code, category_code, time, ...). Keeps monthly sales ('SM') of
    the target NAICS codes; NULL value -> 0.0; rows whose month or value does not parse
    are skipped (see ``rejected_retail_rows``)."""
    labels = spark.createDataFrame(list(TARGET_NAICS.items()), "naics_code string, category_name string")
    parsed = _retail_rows(spark, path).select(F.col("category_code").alias("naics_code"), "value", "observed_at")
    parsed = parsed.filter(F.col("observed_at").isNotNull() & F.col("value").isNotNull())
    return parsed.join(F.broadcast(labels), "naics_code", "inner") \
        .select("naics_code", "category_name", "value", "observed_at")


# ---------------------------------------------------------------- CSV (SRC-5, SRC-6)

def read_locations_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOCATION_CSV).option("header", True).csv(path)


def read_series_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SERIES_CSV).option("header", False).csv(path)


def load_if_empty(target: DataFrame, seed: DataFrame) -> DataFrame:
    """SRC-5 guard: the seed is loaded only into an empty target."""
    return seed if target.isEmpty() else target


# ---------------------------------------------------------------- lookups (SRC-10, SRC-12)

def code_labels(spark: SparkSession, mapping: dict, key: str, label: str) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {label} string")


def locate(locs: DataFrame, points: DataFrame) -> DataFrame:
    """SRC-10 batch form: exact (latitude, longitude) lookup; unknown points find nothing."""
    return locs.join(points.select("latitude", "longitude"), ["latitude", "longitude"], "left_semi")


# ---------------------------------------------------------------- scans and seeds (SRC-8, SRC-11, SRC-16, SRC-17)

def keyset_page(df: DataFrame, key: str, after, n: int) -> DataFrame:
    """SRC-8 resumable form: the next ``n`` rows with ``key`` > ``after`` (pushed down as a
    range filter; a distributed top-n). A plain Parquet scan needs no paging at all."""
    return df.filter(F.col(key) > F.lit(after)).orderBy(key).limit(n)


def seed_locations(spark: SparkSession, rows) -> DataFrame:
    """SRC-11: a static dimension seed from literal rows, typed like the location CSV."""
    return spark.createDataFrame(rows, LOCATION_CSV)


def peek_latest(df: DataFrame, ts: str = "observed_at", n: int = 5) -> DataFrame:
    """SRC-16 / SRC-17: newest ``n`` rows (distributed top-n)."""
    return df.orderBy(F.col(ts).desc()).limit(n)


def peek(df: DataFrame, n: int = 5) -> DataFrame:
    """SRT-6: any ``n`` rows, in no order (a look at a table or at its duplicate groups)."""
    return df.limit(n)


def validate_coordinates(lat: float, lon: float) -> None:
    """FLT-14: latitude in [-90, 90], longitude in [-180, 180]."""
    if not -90.0 <= lat <= 90.0:
        raise ValueError("latitude must be within [-90, 90]")
    if not -180.0 <= lon <= 180.0:
        raise ValueError("longitude must be within [-180, 180]")
