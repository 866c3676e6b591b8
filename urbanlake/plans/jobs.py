"""Incremental jobs of the four domains.

Each job reads its source above the watermark, merges into its table and
returns a ``Result``; nothing new gives zero rows and the old watermark. Row
counts are observed on the write itself, so no frame is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from urbanlake.functions.dates import month_bounds, next_chunk, parse_ts
from urbanlake.operators import export, facts, merge, quality, timeseries
from urbanlake.operators.clean import (
    POLLUTANTS,
    TRIP_TYPES,
    Rule,
    active_in,
    archive_rules,
    daily_rules,
    filter_in_set,
    fx_rules,
    gdp_rules,
    hourly_rules,
    incremental,
    normalize_schema,
    split_rejects,
    trip_rules,
    union_drift,
)
from urbanlake.operators.joins import semi_filter, weather_join
from urbanlake.operators.spatial import sensor_zones
from urbanlake.plans.fact_states import log_months, mark_of
from urbanlake.session import delete_folder, scratch_path, stage, unstage
from urbanlake.sources import archive_index, documents, files, tables

START = datetime(1900, 1, 1)
SENSOR_COLUMNS = ("sensor_id", "location_id", "p_name", "first_datetime_utc", "last_datetime_utc", "loaded_at")
RESULT_SCHEMA = "source_name string, partition_key string, rows_written bigint, new_status string, message string"


class Result(NamedTuple):
    rows: int
    watermark: datetime | None


def _written(df: DataFrame, write: Callable[[DataFrame], None], col: str = "loaded_at") -> Result:
    """Run ``write`` and observe rows and the newest load time on the way."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(col).alias("newest")))
    return Result(seen.get["rows"], seen.get["newest"])


def load_trip_months(
    spark: SparkSession,
    root: str,
    target: str,
    keys: list[str],
    source: str,
    load_ts: datetime,
    rejects: str | None = None,
    changes: str | None = None,
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Clean the month files ``keys`` into the trip table, replacing those months.

    A month that cannot be read is reported and skipped. Returns results for
    the ledger (rows per month) and the failed (key, message) pairs. Rejected
    rows of these months replace those in the table ``rejects``, if it is given,
    and ``changes`` names a log of rows that go and come, from which
    ``refresh_trip_states`` keeps the fact.
    """
    frames: dict[str, DataFrame] = {}
    failed: list[tuple[str, str]] = []
    for key in keys:
        year, month = key.split("-")
        try:
            raw = _month_folder(spark, root, int(year), int(month))
            trips = normalize_schema(raw, TRIP_TYPES)
            frames[key] = trips.withColumns({"year": F.lit(int(year)), "month": F.lit(int(month))})
        except Exception as error:
            failed.append((key, str(error)))
    try:
        done = _store_months(spark, frames, target, source, load_ts, rejects, changes)
    except Exception:
        # Which months cannot be read to the end? The others are loaded without them.
        bad = archive_index.unreadable(lambda some: union_drift([frames[k] for k in some]), list(frames))
        if not bad:
            raise
        failed += bad
        done = _store_months(spark, {k: f for k, f in frames.items() if k not in dict(bad)}, target, source, load_ts, rejects, changes)
    rows = [(source, key, n, "succeeded", None) for key, n in done.items()]
    rows += [(source, key, 0, "failed", message) for key, message in failed]
    return spark.createDataFrame(rows, RESULT_SCHEMA), failed


def _store_months(
    spark: SparkSession,
    frames: dict[str, DataFrame],
    target: str,
    source: str,
    load_ts: datetime,
    rejects: str | None,
    changes: str | None,
) -> dict[str, int]:
    """Rows written by month; a month without passing rows succeeded with none and holds none."""
    if not frames:
        return {}
    raw = union_drift(list(frames.values()))
    months = {key: tuple(map(int, key.split("-"))) for key in frames}
    staged = stage(facts.silver_trips(raw, source, load_ts), "trips")
    if rejects:
        bad = split_rejects(raw, trip_rules())[1]
        bad = stage(bad.withColumns({"loaded_at": F.lit(load_ts), "source_system": F.lit(source)}), "trip-rejects")
        tables.overwrite_partitions(bad, rejects, ["year", "month"], clustered=True)
        full = {(r.year, r.month) for r in bad.select("year", "month").distinct().collect()}
        tables.clear_partitions(spark, rejects, ["year", "month"], [m for m in months.values() if m not in full])
        unstage(bad)
    if changes:
        log_months(spark, staged, target, list(months.values()), changes, load_ts)
    tables.overwrite_partitions(staged, target, ["year", "month"], clustered=True)
    # At most one row per month asked for.
    written = {(r.year, r.month): r["count"] for r in staged.groupBy("year", "month").count().collect()}
    tables.clear_partitions(spark, target, ["year", "month"], [m for m in months.values() if m not in written])
    unstage(staged)
    return {key: written.get(month, 0) for key, month in months.items()}


def _month_folder(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """The files of a month, whose folder may be spelled with or without the leading zero."""
    found = [p for m in dict.fromkeys((f"{month:02d}", str(month))) if tables.exists(spark, p := f"{root}/year={year}/month={m}")]
    return spark.read.option("mergeSchema", True).parquet(*(found or [f"{root}/year={year}/month={month:02d}"]))


def load_archive_month(
    spark: SparkSession,
    root: str,
    sensors: DataFrame,
    key: str,
    target: str,
    load_ts: datetime,
    grain: str = "hour",
    source: str = "s3_archive",
) -> Result:
    """Roll one archive month of the active target sensors up and append it."""
    locations, wanted, first, last = _archive_sensors(sensors, key)
    raw = files.scan_archive_folders(spark, root, [key], locations)
    out = _archive_rollup(raw, wanted, first, last, grain, source, load_ts)
    return _written(out, lambda df: tables.append(df, target, ["load_date"]))


def _archive_sensors(sensors: DataFrame, key: str) -> tuple[DataFrame, DataFrame, Column, Column]:
    """The active locations of a month, their target sensors, and the month's bounds."""
    first, last = month_bounds(F.lit(key))
    end = last.cast("timestamp_ntz") + F.expr("interval 1 day - interval 1 microsecond")
    ours = target_sensors(sensors)
    active = active_in(ours, "first_datetime_utc", "last_datetime_utc", first, end)
    locations = active.select("location_id").distinct()
    # All target sensors of an active location are read, as the folder holds them together.
    return locations, ours.join(locations, "location_id", "left_semi"), first, last


def target_sensors(sensors: DataFrame) -> DataFrame:
    """The latest row of every sensor that measures a pollutant."""
    return merge.dedupe_latest(filter_in_set(sensors, "p_name", POLLUTANTS), ["sensor_id"], ["loaded_at"])


def _archive_rollup(
    raw: DataFrame, wanted: DataFrame, first: Column, last: Column, grain: str, source: str, load_ts: datetime
) -> DataFrame:
    out = facts.rollup_readings(semi_filter(raw, wanted, {"sensors_id": "sensor_id"}), grain)
    out = files.with_audit(files.between_dates(out, "date_utc", first, last), source, load_ts)
    return out.withColumns({"year": F.year("date_utc"), "month": F.month("date_utc")})


class UnreadableFiles(RuntimeError):
    """Some files of a load cannot be read to the end; ``files`` holds ``(path, reason)``."""

    def __init__(self, found: list[tuple[str, str]]):
        self.files = found
        more = f" and {len(found) - 10} more" if len(found) > 10 else ""
        super().__init__(f"{len(found)} unreadable: " + "; ".join(path for path, _ in found[:10]) + more)


def load_archive_months(
    spark: SparkSession,
    root: str,
    sensors: DataFrame,
    keys: list[str],
    target: str,
    load_ts: datetime,
    grain: str = "hour",
    source: str = "s3_archive",
    store: str | None = None,
    bad_files: str = "fail",
    rejects: str | None = None,
    slice_size: int = archive_index.SLICE,
) -> DataFrame:
    """Load archive months one by one; what goes wrong in a month stays in it.

    Returns a ledger result per month: its rows and 'succeeded', also where it has no folders, or 'failed' with the reason.
    A month is appended whole or not at all. Its files come from the index in ``store`` (one of this run, if not given),
    which is renewed for the months, and are rolled up ``slice_size`` at a time, a location never being cut. With
    ``bad_files='skip'`` a month is loaded without the files that cannot be read, and the message names them; 'fail' fails
    it. Readings without a time replace those of these months in the table ``rejects``, if it is given.
    """
    if bad_files not in ("fail", "skip"):
        raise ValueError(f"bad_files must be fail or skip, not {bad_files!r}")
    store = store or scratch_path(spark, "archive-index")
    done: list[tuple[str, str, int, str, str | None]] = []
    try:
        # Every month asks for them several times.
        ours = stage(target_sensors(sensors.select(*SENSOR_COLUMNS)), "archive-sensors")
    except Exception as error:
        return spark.createDataFrame([(source, key, 0, "failed", archive_index.reason(error)) for key in keys], RESULT_SCHEMA)
    for key in keys:
        try:
            rows, note = _load_archive_month(spark, root, ours, key, target, load_ts, grain, source, store, bad_files, rejects, slice_size)
            done.append((source, key, rows, "succeeded", note))
        except Exception as error:
            done.append((source, key, 0, "failed", archive_index.reason(error)))
    unstage(ours)
    return spark.createDataFrame(done, RESULT_SCHEMA)


def _load_archive_month(
    spark: SparkSession,
    root: str,
    sensors: DataFrame,
    key: str,
    target: str,
    load_ts: datetime,
    grain: str,
    source: str,
    store: str,
    bad_files: str,
    rejects: str | None,
    slice_size: int,
) -> tuple[int, str | None]:
    locations, wanted, first, last = _archive_sensors(sensors, key)
    archive_index.register(spark, root, store, locations, [key])
    months = archive_index.month_frame(spark.range(1).select(F.lit(key).alias("partition_key")))
    found = archive_index.wanted_files(archive_index.read_index(spark, store), months, locations)
    path, bad_path = scratch_path(spark, "archive-month"), scratch_path(spark, "archive-rejects")
    bad: list[tuple[str, str]] = []

    def read(paths: list[str]) -> DataFrame:
        return archive_index.read_files(spark, root, paths)

    def roll(paths: list[str]) -> None:
        raw = read(paths)
        _archive_rollup(raw, wanted, first, last, grain, source, load_ts).write.mode("append").parquet(path)
        if rejects:
            timed = semi_filter(raw, wanted, {"sensors_id": "sensor_id"}).withColumn("ts_utc", parse_ts("datetime"))
            lost = split_rejects(timed, archive_rules())[1].drop("ts_utc")
            lost.withColumns({"loaded_at": F.lit(load_ts), "source_system": F.lit(source)}).write.mode("append").parquet(bad_path)

    some = False
    try:
        for paths in archive_index.slices(found, slice_size):
            some = True
            try:
                roll(paths)
            except Exception:
                lost = archive_index.unreadable(read, paths)
                if not lost:
                    raise
                bad += lost
                good = [p for p in paths if p not in dict(lost)]
                if bad_files == "skip" and good:
                    roll(good)
        if bad and bad_files == "fail":
            raise UnreadableFiles(bad)
        if rejects:
            _replace_month(spark, bad_path, rejects, tuple(map(int, key.split("-"))))
        if not some or not tables.exists(spark, path):
            return 0, str(UnreadableFiles(bad)) if bad else "no folders of this month"
        rows = _written(spark.read.parquet(path), lambda df: tables.append(df, target, ["load_date"])).rows
        return rows, str(UnreadableFiles(bad)) if bad else None
    finally:
        for staged in (path, bad_path):
            delete_folder(spark, staged)


def _replace_month(spark: SparkSession, staged: str, target: str, month: tuple[int, int]) -> None:
    """The staged rows of a month instead of those in ``target``."""
    rows = spark.read.parquet(staged) if tables.exists(spark, staged) else None
    if rows is None or rows.isEmpty():
        tables.clear_partitions(spark, target, ["year", "month"], [month])
    else:
        tables.overwrite_partitions(rows, target, ["year", "month"])


def load_sensor_days(pages: DataFrame, target: str, load_ts: datetime, source: str = "api") -> Result:
    """Append the daily readings of API pages; ``pages`` holds the sensor columns and a payload."""
    out = files.with_audit(documents.flatten_sensor_days(pages), source, load_ts)
    out = out.withColumns({"year": F.year("date_utc"), "month": F.month("date_utc")})
    return _written(out, lambda df: tables.append(df, target, ["load_date"]))


def load_locations(pages: DataFrame, target: str, load_ts: datetime) -> Result:
    return _written(documents.flatten_locations(pages, load_ts), lambda df: tables.append(df, target))


def load_indicators(pages: DataFrame, target: str, load_ts: datetime) -> Result:
    return _written(documents.flatten_indicators(pages, load_ts), lambda df: tables.append(df, target))


def load_rates(spark: SparkSession, path: str, target: str, load_ts: datetime) -> Result:
    return _written(files.scan_rate_series(spark, path, load_ts), lambda df: tables.append(df, target))


def export_weather_chunk(
    fact: DataFrame,
    pages: DataFrame,
    target: str,
    watermark: datetime | None,
    start: datetime,
    end: datetime,
    now: datetime,
    run_id: str,
) -> Result:
    """Stage the next weekly chunk of weather and trips; the new mark is the chunk's end."""
    chunk = next_chunk(watermark, start, end)
    if chunk is None:
        return Result(0, watermark)
    low, high = chunk
    first, last = [int(t.strftime("%Y%m%d")) for t in chunk]
    weather = documents.flatten_weather(pages, low, high)
    rows = export.export_rows(weather_join(weather, facts.city_hourly(fact, first, last)), run_id, chunk, start, now)
    written = _written(rows, lambda df: tables.replace(df, target), "written_at_utc")
    # A chunk without weather is tried again, not skipped.
    return Result(written.rows, high if written.rows else watermark)


def check_tables(spark: SparkSession, targets: dict[str, str]) -> DataFrame:
    """Results of the standard checks; ``targets`` maps a checked table to where it is stored."""
    checks = quality.standard_checks()
    return quality.dq_run_all({name: tables.read(spark, place) for name, place in targets.items()}, checks)


def _merge_new(
    spark: SparkSession,
    source: str,
    target: str,
    watermark: datetime | None,
    build: Callable[[DataFrame], DataFrame],
    keys: list[str],
    partition_by: list[str],
    rules: list[Rule] | None = None,
    rejects: str | None = None,
    rows: Callable[[DataFrame], DataFrame] = lambda new: new,
) -> Result:
    """Merge the rows above the watermark; the new mark is the newest load time read.

    Rows that break a rule are stored in the table ``rejects``, if it is given,
    with their reasons, under the mark of the run. ``rows`` gives the rows that
    the rules judge. What earlier runs stored above the watermark goes first:
    they failed after it, and their rows are read again.
    """
    low = watermark or START
    # Loads may have brought new columns.
    new = incremental(tables.read(spark, source, merge_schema=True), "loaded_at", low)
    newest = merge.high_watermark(new)
    if newest is None:
        return Result(0, low)
    # A fixed upper bound keeps rows that land during the run for the next one.
    new = incremental(new, "loaded_at", None, newest)
    batch = build(new)
    if rejects:
        _store_rejects(split_rejects(rows(new), rules or [])[1], rejects, low, newest)
    result = _written(batch, lambda df: tables.upsert_table(df, target, keys, partition_by))
    return Result(result.rows, newest)


def _store_rejects(bad: DataFrame, target: str, low: datetime, newest: datetime) -> None:
    spark, mark = bad.sparkSession, "rejected_up_to"
    if tables.exists(spark, target):
        stale = tables.read(spark, target).where(F.col(mark) > mark_of(low)).select(mark).distinct().collect()
        tables.clear_partitions(spark, target, [mark], [tuple(row) for row in stale])
    tables.append(bad.withColumn(mark, F.lit(mark_of(newest))), target, [mark])


def merge_daily(
    spark: SparkSession,
    source: str,
    target: str,
    watermark: datetime | None,
    null_coverage: str = "drop",
    rejects: str | None = None,
) -> Result:
    keys = ["sensor_id", "measurement_date", "parameter"]
    build = partial(facts.silver_daily, null_coverage=null_coverage)
    rules = daily_rules(null_coverage)
    return _merge_new(spark, source, target, watermark, build, keys, ["year", "month"], rules, rejects)


def merge_hourly(
    spark: SparkSession, source: str, target: str, watermark: datetime | None, rejects: str | None = None
) -> Result:
    keys = ["sensor_id", "measurement_date", "hour_utc", "parameter"]
    build, rules = facts.silver_hourly, hourly_rules()
    return _merge_new(spark, source, target, watermark, build, keys, ["year", "month"], rules, rejects)


def merge_gdp(
    spark: SparkSession, source: str, target: str, watermark: datetime | None, rejects: str | None = None
) -> Result:
    keys = ["country_code", "indicator_id", "year"]
    return _merge_new(
        spark, source, target, watermark, facts.silver_gdp, keys, ["year"], gdp_rules(), rejects, facts.gdp_rows
    )


def merge_fx(
    spark: SparkSession, source: str, target: str, watermark: datetime | None, rejects: str | None = None
) -> Result:
    """Merge new rates and refill every day they change, across loads too."""
    pair = ["from_currency", "to_currency"]
    staged: list[DataFrame] = []

    def build(new: DataFrame) -> DataFrame:
        batch = facts.silver_fx(new)
        if not tables.exists(spark, target):
            filled = timeseries.fill_gaps(batch, pair, "rate_date")
        else:
            silver = tables.read(spark, target)
            staged.append(stage(batch, "fx-batch"))
            filled = timeseries.fill_increment(silver, staged[0], pair, "rate_date", "rate_year")
        # A filled day may repeat an old observation: stamp it with this load, so the fact sees it.
        stamp = F.when(F.col("is_filled"), new.agg(F.max("loaded_at")).scalar()).otherwise(F.col("loaded_at"))
        return filled.withColumns({"loaded_at": stamp, "rate_year": F.year("rate_date")})

    keys = ["rate_date", *pair]
    result = _merge_new(
        spark, source, target, watermark, build, keys, ["rate_year"], fx_rules(), rejects, facts.fx_rows
    )
    for part in staged:
        unstage(part)
    return result


def map_sensors(spark: SparkSession, locations: str, zones: str, target: str) -> Result:
    """Rebuild the sensor-to-zone table; an empty zone table is an error."""
    shapes = tables.read(spark, zones)
    if shapes.isEmpty():
        raise RuntimeError("the zone table is empty")
    placed = sensor_zones(tables.read(spark, locations), shapes)
    return _written(placed, lambda df: tables.replace(df, target))


def refresh_trips(
    spark: SparkSession, silver: str, target: str, watermark: datetime | None, grain: str = "day"
) -> Result:
    """Rebuild the trip groups touched since the watermark and merge them into the fact."""
    keys = ["date_key", "pickup_zone_id", "payment_id", *(["hour"] if grain == "hour" else [])]
    build = partial(facts.taxi_fact, grain=grain, newest="loaded_at")
    return _refresh(spark, tables.read(spark, silver), target, watermark, "trip_date", keys, build)


def refresh_air(
    spark: SparkSession,
    silver: str,
    zones: str,
    params: DataFrame,
    target: str,
    watermark: datetime | None,
    grain: str = "day",
) -> Result:
    keys = ["date_key", "zone_id", "parameter", *(["hour"] if grain == "hour" else [])]
    readings = facts.zoned_readings(tables.read(spark, silver), tables.read(spark, zones).select("sensor_id", "zone_id"))
    build = partial(facts.air_fact_of, params=params, grain=grain, named=True, newest="loaded_at")
    return _refresh(spark, readings, target, watermark, "measurement_date", keys, build, foldered=True)


def _refresh(
    spark: SparkSession,
    silver: DataFrame,
    target: str,
    watermark: datetime | None,
    day: str,
    keys: list[str],
    build: Callable[[DataFrame], DataFrame],
    foldered: bool = False,
) -> Result:
    """``foldered`` says that the ``year`` and ``month`` folders of ``silver`` follow from ``day``."""
    low = watermark or START
    new = incremental(silver, "loaded_at", low)
    # One row, whose list the calendar bounds.
    newest, months = new.agg(F.max("loaded_at"), F.collect_set(F.trunc(day, "month"))).first()
    if newest is None:
        return Result(0, low)
    span = silver.filter(touched_months(day, months, foldered))
    fact = merge.touched_groups(span, build, "loaded_at", low, newest)
    fact = fact.withColumn("month_key", _month_of(F.col("date_key")))
    seen = Observation()
    tables.upsert_table(
        fact.observe(seen, F.count(F.lit(1)).alias("rows")), target, keys, ["month_key"], null_safe=True
    )
    return Result(seen.get["rows"], newest)


def touched_months(day: str, months: list[date], foldered: bool = False) -> Column:
    """Literal predicate for the days of ``months``, one range per run of adjacent months.

    Ranges prune row groups, and folders too where these follow from the day;
    the groups are whole inside them. A late row from years ago rereads its own
    month, not all months since.
    """
    runs: list[list[int]] = []
    for n in sorted(m.year * 12 + m.month - 1 for m in months):
        if runs and n == runs[-1][1]:
            runs[-1][1] = n + 1
        else:
            runs.append([n, n + 1])
    ranges = [
        (F.col(day) >= F.lit(date(a // 12, a % 12 + 1, 1))) & (F.col(day) < F.lit(date(b // 12, b % 12 + 1, 1)))
        for a, b in runs
    ] or [F.lit(False)]
    while len(ranges) > 1:
        ranges = [a | b for a, b in zip(ranges[::2], ranges[1::2])] + ranges[len(ranges) // 2 * 2 :]
    if not foldered:
        return ranges[0]
    return ranges[0] & tables.any_of(["year", "month"], [(m.year, m.month) for m in months])


def _month_of(date_key: Column) -> Column:
    return F.floor(date_key / 100).cast("int")


def refresh_fx(spark: SparkSession, silver: str, currency: DataFrame, target: str, watermark: datetime | None) -> Result:
    def build(new: DataFrame) -> DataFrame:
        return facts.fx_fact(new, currency, named=True).withColumn("month_key", _month_of(F.col("date_key")))

    # Names, not ids: currencies that the dimension lacks all have a null id, but are not the same.
    keys = ["date_key", "from_currency", "to_currency"]
    return _refresh_rows(spark, silver, target, watermark, build, keys, ["month_key"])


def refresh_gdp(spark: SparkSession, silver: str, target: str, watermark: datetime | None) -> Result:
    return _refresh_rows(spark, silver, target, watermark, facts.gdp_fact, ["year", "country_code"], ["year"])


def _refresh_rows(
    spark: SparkSession,
    silver: str,
    target: str,
    watermark: datetime | None,
    build: Callable[[DataFrame], DataFrame],
    keys: list[str],
    partition_by: list[str],
) -> Result:
    low = watermark or START
    new = incremental(tables.read(spark, silver), "loaded_at", low)
    newest = merge.high_watermark(new)
    if newest is None:
        return Result(0, low)
    fact = build(incremental(new, "loaded_at", None, newest))
    seen = Observation()
    tables.upsert_table(
        fact.observe(seen, F.count(F.lit(1)).alias("rows")), target, keys, partition_by, null_safe=True
    )
    return Result(seen.get["rows"], newest)
