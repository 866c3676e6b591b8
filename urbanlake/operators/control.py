"""Partition ledger, watermarks and run log as frames.

Every function takes the current table and returns the next one; ``now`` is
always given by the caller.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from urbanlake.functions.dates import month_rows
from urbanlake.operators.merge import insert_missing

LEDGER_SCHEMA = (
    "source_name string, partition_key string, source_url string, status string, started_at timestamp, "
    "ended_at timestamp, bronze_rows_written bigint, error_message string, silver_status string, "
    "silver_started_at timestamp, silver_ended_at timestamp, silver_rows_written bigint, "
    "silver_error_message string, created_at timestamp"
)
WATERMARK_SCHEMA = (
    "target_table string, source_table string, last_processed_ts timestamp, last_run_at timestamp, "
    "rows_merged bigint, pipeline_run_id string"
)
RUN_LOG_SCHEMA = (
    "run_id string, pipeline_name string, layer string, status string, started_at timestamp, "
    "ended_at timestamp, message string, logged_at timestamp"
)
KEY = ["source_name", "partition_key"]
# Column names per layer: status, start, end, rows, error.
LAYERS = {
    "bronze": ("status", "started_at", "ended_at", "bronze_rows_written", "error_message"),
    "silver": ("silver_status", "silver_started_at", "silver_ended_at", "silver_rows_written", "silver_error_message"),
}


def _layer(layer: str) -> tuple[str, str, str, str, str]:
    if layer not in LAYERS:
        raise ValueError(f"layer must be bronze or silver, not {layer!r}")
    return LAYERS[layer]


def _set(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns on the rows where the condition is true."""
    return df.withColumns({c: F.when(where, v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()})


def _flagged(df: DataFrame, keys: DataFrame) -> DataFrame:
    """``df`` with ``_hit`` true for the ledger keys in ``keys``."""
    return df.join(keys.select(*KEY, F.lit(True).alias("_hit")), KEY, "left")


def seed(ledger: DataFrame, spans: DataFrame, now: datetime, template: str | None = None) -> DataFrame:
    """A pending row per source and month; rows that exist stay as they are.

    ``spans`` has source_name, first_day and last_day.
    """
    kind = ledger.schema["created_at"].dataType
    rows = month_rows(spans, "first_day", "last_day", template).select(
        *KEY, "source_url", F.lit("pending").alias("status"), F.lit(now).cast(kind).alias("created_at")
    )
    return insert_missing(ledger, rows, KEY)


def _is_pending(source: str, layer: str) -> Column:
    status = _layer(layer)[0]
    ready = (F.col("source_name") == source) & (F.col(status) == "pending")
    return ready if layer == "bronze" else ready & (F.col("status") == "succeeded")


def pending(ledger: DataFrame, source: str, layer: str, limit: int | None = None) -> DataFrame:
    """Pending partitions in key order; silver also needs a finished bronze."""
    rows = ledger.filter(_is_pending(source, layer)).select(*KEY, "source_url").orderBy("partition_key")
    return rows if limit is None else rows.limit(limit)


def claim(ledger: DataFrame, source: str, layer: str, now: datetime, limit: int | None = None) -> DataFrame:
    """Set the first ``limit`` pending partitions running; None claims all."""
    status, started, ended, _, error = _layer(layer)
    null = F.lit(None)
    values = {status: F.lit("running"), started: F.lit(now), ended: null, error: null}
    if limit is None:
        return _set(ledger, _is_pending(source, layer), values)
    marked = _flagged(ledger, pending(ledger, source, layer, limit))
    return _set(marked, F.col("_hit"), values).select(*ledger.columns)


def update(ledger: DataFrame, results: DataFrame, layer: str, now: datetime, cascade: bool = False) -> DataFrame:
    """Apply results: source_name, partition_key, new_status, rows_written, message.

    Bronze stamps its start on 'running' and its end on 'succeeded' or
    'failed'; ``cascade`` then queues silver for succeeded rows. Silver always
    stamps its end.
    """
    status, started, ended, rows, error = _layer(layer)
    side = results.select(*KEY, "new_status", "rows_written", "message", F.lit(True).alias("_hit"))
    joined = ledger.join(side, KEY, "left")
    new, stamp = F.col("new_status"), F.lit(now)
    values = {status: new, rows: F.col("rows_written"), error: F.col("message")}
    if layer == "bronze":
        values[started] = F.when(new == "running", stamp).otherwise(F.col(started))
        values[ended] = F.when(new.isin("succeeded", "failed"), stamp).otherwise(F.col(ended))
        if cascade:
            values["silver_status"] = F.when(new == "succeeded", "pending").otherwise(F.col("silver_status"))
    else:
        values[ended] = stamp
    return _set(joined, F.col("_hit"), values).select(*ledger.columns)


def reset_running(
    ledger: DataFrame, source: str, layer: str, new_status: str, now: datetime, message: str | None = None
) -> DataFrame:
    """Give every running partition of a source another status."""
    status, _, ended, _, error = _layer(layer)
    running = (F.col("source_name") == source) & (F.col(status) == "running")
    return _set(ledger, running, {status: F.lit(new_status), ended: F.lit(now), error: F.lit(message)})


def stuck(ledger: DataFrame, now: datetime, hours: int = 1) -> DataFrame:
    """Partitions running for more than ``hours``."""
    limit = F.lit(now) - F.expr(f"interval {int(hours)} hours")
    return ledger.filter((F.col("status") == "running") & (F.col("started_at") < limit))


def replay(ledger: DataFrame, source: str, scope: str, partition_key: str | None = None) -> DataFrame:
    """Queue work again: one 'partition', all 'silver', or a silver 'rebuild'."""
    mine, again, null = F.col("source_name") == source, F.lit("pending"), F.lit(None)
    if scope == "partition":
        return _set(ledger, mine & (F.col("partition_key") == partition_key), {"status": again})
    if scope == "silver":
        return _set(ledger, mine & (F.col("status") == "succeeded"), {"silver_status": again})
    if scope != "rebuild":
        raise ValueError(f"unknown scope: {scope}")
    status, *rest = LAYERS["silver"]
    return _set(ledger, mine, {status: again, **{c: null for c in rest}})


def backfill_progress(ledger: DataFrame) -> DataFrame:
    """Partitions per source and status, in order."""
    counts = ledger.groupBy("source_name", "status").agg(F.count("*").alias("partitions"))
    return counts.orderBy("source_name", "status")


def get_watermark(marks: DataFrame, target: str) -> DataFrame:
    """One row: the last processed time of ``target``, 1900-01-01 when unknown."""
    kind = marks.schema["last_processed_ts"].dataType
    start = F.lit("1900-01-01").cast(kind)
    return marks.filter(F.col("target_table") == target).agg(
        F.coalesce(F.max("last_processed_ts"), start).alias("last_processed_ts")
    )


def log_watermark(marks: DataFrame, entries: DataFrame, now: datetime) -> DataFrame:
    """Set or add watermarks: target_table, source_table, ts, rows_merged, run_id.

    An update keeps the source_table that is already logged.
    """
    new = entries.select(
        "target_table",
        F.col("source_table").alias("_source"),
        F.col("ts").alias("_ts"),
        F.col("rows_merged").alias("_rows"),
        F.col("run_id").alias("_run"),
        F.lit(True).alias("_new"),
    )
    both = marks.withColumn("_old", F.lit(True)).join(new, "target_table", "full")
    pick = {
        "source_table": F.when(F.col("_old"), F.col("source_table")).otherwise(F.col("_source")),
        "last_processed_ts": F.when(F.col("_new"), F.col("_ts")).otherwise(F.col("last_processed_ts")),
        "last_run_at": F.when(F.col("_new"), F.lit(now)).otherwise(F.col("last_run_at")),
        "rows_merged": F.when(F.col("_new"), F.col("_rows")).otherwise(F.col("rows_merged")),
        "pipeline_run_id": F.when(F.col("_new"), F.col("_run")).otherwise(F.col("pipeline_run_id")),
    }
    return both.select("target_table", *[c.cast(marks.schema[n].dataType).alias(n) for n, c in pick.items()])


def reset_watermark(marks: DataFrame, target: str, ts: str = "1900-01-01") -> DataFrame:
    return _set(marks, F.col("target_table") == target, {"last_processed_ts": F.lit(ts)})


def start_runs(log: DataFrame, runs: DataFrame, now: datetime) -> DataFrame:
    """Append running entries for run_id, pipeline_name, layer."""
    kind = log.schema["started_at"].dataType
    new = runs.select(
        "run_id", "pipeline_name", "layer", F.lit("running").alias("status"), F.lit(now).cast(kind).alias("started_at")
    )
    return log.unionByName(new, allowMissingColumns=True)


def finish_runs(log: DataFrame, results: DataFrame, now: datetime) -> DataFrame:
    """Close runs: run_id, new_status, new_message."""
    side = results.select("run_id", "new_status", "new_message", F.lit(True).alias("_hit"))
    stamp = F.lit(now)
    values = {"status": F.col("new_status"), "message": F.col("new_message"), "ended_at": stamp, "logged_at": stamp}
    return _set(log.join(side, "run_id", "left"), F.col("_hit"), values).select(*log.columns)


def run_status(log: DataFrame) -> DataFrame:
    """Last start and greatest status per pipeline."""
    return log.groupBy("pipeline_name").agg(
        F.max("started_at").alias("last_run"), F.max("status").alias("last_status")
    )
