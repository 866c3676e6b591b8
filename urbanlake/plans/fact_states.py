"""Trip facts kept current from a change log: a late or corrected row costs its own group, not its month.

``log_months`` writes what a load takes out of the trip table and what it brings, before the months are swapped in.
``refresh_trip_states`` adds the signed sums of what was logged to the stored states. Both may be repeated after a failure:
a month that was swapped keeps its log, and a month of the states knows the newest load that it holds.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import states
from urbanlake.session import stage, unstage
from urbanlake.sources import tables

#: Load times as folder names that sort like the times.
MARK_FORMAT = "m%Y%m%dT%H%M%S.%f"
MARK, CHANGE, APPLIED = "load_mark", "change", "applied_mark"


def mark_of(load_ts: datetime) -> str:
    return load_ts.strftime(MARK_FORMAT)


def log_months(
    spark: SparkSession, staged: DataFrame, target: str, months: list[tuple[int, int]], changes: str, load_ts: datetime
) -> None:
    """Log the rows of ``months`` in ``target`` as gone and those of ``staged`` as come, under the load's time.

    ``staged`` carries ``loaded_at``. Repeated with the same load time, it logs only months that were not swapped yet: a
    swapped one holds no row of another load.
    """
    mark, open_months = mark_of(load_ts), set(months)
    known = tables.exists(spark, target)
    before = tables.read(spark, target).where(tables.any_of(["year", "month"], months)) if known else staged.limit(0)
    if tables.exists(spark, changes):
        logged = tables.read(spark, changes).where(F.col(MARK) == mark).select("year", "month").distinct().collect()
        older = before.where(~F.col("loaded_at").eqNullSafe(F.lit(load_ts).cast(before.schema["loaded_at"].dataType)))
        waiting = {tuple(r) for r in older.select("year", "month").distinct().collect()}
        open_months -= {tuple(r) for r in logged} - waiting
    if not open_months:
        return
    these = tables.any_of(["year", "month"], sorted(open_months))
    log = states.signed_changes(before.where(these), staged.where(these), CHANGE).withColumn(MARK, F.lit(mark))
    tables.overwrite_partitions(log, changes, [MARK, "year", "month"])


def refresh_trip_states(
    spark: SparkSession, changes: str, target: str, watermark: datetime | None, grain: str = "day"
) -> tuple[int, str | None]:
    """Add what was logged after ``watermark`` to the states; the rows added up and the newest mark.

    Reads the log and the months of the states that it touches. Months hold the newest mark they contain, so that a
    repeated refresh adds nothing twice.
    """
    keys = states.trip_keys(grain)
    new = tables.read(spark, changes).where(F.col(MARK) > mark_of(watermark or datetime(1900, 1, 1)))
    new = new.withColumn("month_key", (F.year("trip_date") * 100 + F.month("trip_date")).cast("int"))
    held = tables.read(spark, target) if tables.exists(spark, target) else None
    if held is not None:
        # One row per month of the fact.
        applied = held.groupBy("month_key").agg(F.max(APPLIED).alias(APPLIED))
        new = new.join(applied, "month_key", "left").where(F.col(APPLIED).isNull() | (F.col(MARK) > F.col(APPLIED))).drop(APPLIED)
    batch = stage(_by_month(states.trip_states(new, grain, CHANGE)), "state-changes")
    newest, rows, months = new.agg(F.max(MARK), F.count("*"), F.collect_set("month_key")).first()
    if not rows:
        return 0, None
    parts = [batch]
    if held is not None:
        parts.append(held.where(F.col("month_key").isin(months)))
    merged = _by_month(states.merge_states(parts, keys)).withColumn(APPLIED, F.lit(newest))
    merged = stage(merged, "states")
    full = {r.month_key for r in merged.select("month_key").distinct().collect()}
    tables.overwrite_partitions(merged, target, ["month_key"])
    tables.clear_partitions(spark, target, ["month_key"], [(m,) for m in months if m not in full])
    unstage(batch)
    unstage(merged)
    return rows, newest


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int"))


def read_fact(spark: SparkSession, target: str, grain: str = "day") -> DataFrame:
    """The fact that the stored states stand for."""
    return states.trip_fact(tables.read(spark, target), grain)
