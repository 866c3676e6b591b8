"""Ledger, watermark and run-log operators over state derived from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import control
from urbanlake.queries import bindings as b
from urbanlake.queries.aggregates import LEDGER_SQL, NOW, RUN_LOG_SQL, ledger, run_log
from urbanlake.queries.registry import query

_NOW = "TIMESTAMP '2002-02-01 12:00:00'"
_COLUMNS = [
    "source_name",
    "partition_key",
    "status",
    "started_at",
    "ended_at",
    "bronze_rows_written",
    "error_message",
    "silver_status",
    "silver_started_at",
    "silver_ended_at",
    "silver_rows_written",
    "silver_error_message",
]
_ALL = ", ".join(_COLUMNS)


def _replaced(changes: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{changes[c]} AS {c}' if c in changes else c for c in _COLUMNS)} FROM ledger"


def _when(condition: str, values: dict[str, str]) -> dict[str, str]:
    return {c: f"CASE WHEN {condition} THEN {v} ELSE {c} END" for c, v in values.items()}


@query(
    "ledger_seed",
    """SELECT source_name, partition_key,
      CASE WHEN l.status IS NULL THEN 'url/' || replace(partition_key, '-', '/') ELSE l.source_url END AS source_url,
      coalesce(l.status, 'pending') AS status, CASE WHEN l.status IS NULL THEN """
    + _NOW
    + """ ELSE l.created_at END AS created_at
    FROM ledger l FULL JOIN (SELECT source_name, strftime(month, '%Y-%m') AS partition_key FROM (
        SELECT o_orderstatus AS source_name, unnest(generate_series(date_trunc('month', min(o_orderdate)) - INTERVAL 3 MONTH,
          date_trunc('month', max(o_orderdate)) + INTERVAL 3 MONTH, INTERVAL 1 MONTH)) AS month FROM orders GROUP BY 1)) s
    USING (source_name, partition_key)""",
    LEDGER_SQL,
)
def ledger_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three months before and after the known ones are added, the known ones kept."""
    day = F.to_date("o_orderdate")
    spans = (
        b.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("source_name"))
        .agg(F.add_months(F.min(day), -3).alias("first_day"), F.add_months(F.max(day), 3).alias("last_day"))
    )
    seeded = control.seed(ledger(spark, sf_dir), spans, NOW, "url/{yyyy}/{mm}")
    return seeded.select("source_name", "partition_key", "source_url", "status", "created_at")


@query(
    "ledger_pending",
    """SELECT source_name, partition_key, source_url FROM ledger
    WHERE source_name = 'F' AND status = 'succeeded' AND silver_status = 'pending'""",
    LEDGER_SQL,
)
def ledger_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.pending(ledger(spark, sf_dir), "F", "silver")


_CLAIMED = "(source_name, partition_key) IN (SELECT (source_name, partition_key) FROM picked)"


@query(
    "ledger_claim",
    _replaced(
        _when(_CLAIMED, {"status": "'running'", "started_at": _NOW, "ended_at": "NULL", "error_message": "NULL"})
    ),
    LEDGER_SQL,
    "picked AS (SELECT * FROM ledger WHERE source_name = 'O' AND status = 'pending' ORDER BY partition_key LIMIT 5)",
)
def ledger_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.claim(ledger(spark, sf_dir), "O", "bronze", NOW, 5).select(*_COLUMNS)


@query(
    "ledger_update",
    _replaced(
        {
            **_when(
                "status = 'running'",
                {
                    "status": "CASE WHEN source_name = 'O' THEN 'succeeded' ELSE 'failed' END",
                    "ended_at": _NOW,
                    "bronze_rows_written": "10",
                    "error_message": "'note'",
                },
            ),
            "silver_status": "CASE WHEN status = 'running' AND source_name = 'O' THEN 'pending' ELSE silver_status END",
        }
    ),
    LEDGER_SQL,
)
def ledger_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every running partition ends; a success queues silver."""
    now = ledger(spark, sf_dir)
    results = now.filter("status = 'running'").select(
        "source_name",
        "partition_key",
        F.when(F.col("source_name") == "O", "succeeded").otherwise("failed").alias("new_status"),
        F.lit(10).cast("bigint").alias("rows_written"),
        F.lit("note").alias("message"),
    )
    return control.update(now, results, "bronze", NOW, cascade=True).select(*_COLUMNS)


@query(
    "ledger_reset_running",
    _replaced(
        _when(
            "source_name = 'P' AND status = 'running'",
            {"status": "'pending'", "ended_at": _NOW, "error_message": "'aborted'"},
        )
    ),
    LEDGER_SQL,
)
def ledger_reset_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.reset_running(ledger(spark, sf_dir), "P", "bronze", "pending", NOW, "aborted").select(*_COLUMNS)


@query(
    "ledger_stuck",
    f"SELECT {_ALL} FROM ledger WHERE status = 'running' AND started_at < {_NOW} - INTERVAL 1 HOUR",
    LEDGER_SQL,
)
def ledger_stuck(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.stuck(ledger(spark, sf_dir), NOW).select(*_COLUMNS)


@query(
    "ledger_replay",
    _replaced(
        {
            **_when("source_name = 'F'", {c: "NULL" for c in _COLUMNS if c.startswith("silver_")}),
            "status": "CASE WHEN source_name = 'O' AND partition_key = '1998-12' THEN 'pending' ELSE status END",
            "silver_status": "CASE WHEN source_name = 'F' OR (source_name = 'P' AND status = 'succeeded') THEN 'pending' "
            "ELSE silver_status END",
        }
    ),
    LEDGER_SQL,
)
def ledger_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver rebuild of F, all silver of P, and one partition of O."""
    state = control.replay(ledger(spark, sf_dir), "F", "rebuild")
    state = control.replay(state, "P", "silver")
    return control.replay(state, "O", "partition", "1998-12").select(*_COLUMNS)


_MARKS_SQL = """marks AS (SELECT o_orderpriority AS target_table, 'orders' AS source_table,
  max(o_orderdate) AS last_processed_ts, max(o_orderdate) + INTERVAL 1 DAY AS last_run_at, count(*) AS rows_merged,
  'run-0' AS pipeline_run_id FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)"""


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A watermark per order priority, except the lowest."""
    newest = F.max("o_orderdate")
    return (
        b.table(spark, sf_dir, "orders")
        .filter("o_orderpriority <> '5-LOW'")
        .groupBy(F.col("o_orderpriority").alias("target_table"))
        .agg(
            F.lit("orders").alias("source_table"),
            newest.alias("last_processed_ts"),
            (newest + F.expr("interval 1 day")).alias("last_run_at"),
            F.count("*").alias("rows_merged"),
            F.lit("run-0").alias("pipeline_run_id"),
        )
    )


@query(
    "watermark_get",
    """SELECT coalesce((SELECT max(last_processed_ts) FROM marks WHERE target_table = '2-HIGH'), TIMESTAMP '1900-01-01')
      AS last_processed_ts
    UNION ALL SELECT coalesce((SELECT max(last_processed_ts) FROM marks WHERE target_table = '5-LOW'),
      TIMESTAMP '1900-01-01')""",
    _MARKS_SQL,
)
def watermark_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A known and an unknown target."""
    marks = _marks(spark, sf_dir)
    return control.get_watermark(marks, "2-HIGH").union(control.get_watermark(marks, "5-LOW"))


@query(
    "watermark_log",
    f"""SELECT coalesce(m.target_table, o.target_table) AS target_table, coalesce(m.source_table, 'files') AS source_table,
      coalesce(o.ts, m.last_processed_ts) AS last_processed_ts,
      CASE WHEN o.ts IS NULL THEN m.last_run_at ELSE {_NOW} END AS last_run_at, coalesce(o.n, m.rows_merged) AS rows_merged,
      CASE WHEN o.ts IS NULL THEN m.pipeline_run_id ELSE 'run-1' END AS pipeline_run_id
    FROM marks m FULL JOIN (SELECT o_orderpriority AS target_table, min(o_orderdate) AS ts, count(*) AS n FROM orders
      WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') GROUP BY 1) o ON m.target_table = o.target_table""",
    _MARKS_SQL,
)
def watermark_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One target is updated, one added, the others stay."""
    entries = (
        b.table(spark, sf_dir, "orders")
        .filter("o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')")
        .groupBy(F.col("o_orderpriority").alias("target_table"))
        .agg(
            F.lit("files").alias("source_table"),
            F.min("o_orderdate").alias("ts"),
            F.count("*").alias("rows_merged"),
            F.lit("run-1").alias("run_id"),
        )
    )
    return control.log_watermark(_marks(spark, sf_dir), entries, NOW)


@query(
    "watermark_reset",
    """SELECT target_table, CASE WHEN target_table = '1-URGENT' THEN TIMESTAMP '1900-01-01' ELSE last_processed_ts END
      AS last_processed_ts FROM marks""",
    _MARKS_SQL,
)
def watermark_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = control.reset_watermark(_marks(spark, sf_dir), "1-URGENT")
    return marks.select("target_table", "last_processed_ts")


@query(
    "run_log_start",
    f"""SELECT run_id, pipeline_name, layer, status, started_at, ended_at FROM run_log
    UNION ALL SELECT 'customer-' || c_custkey, c_mktsegment, 'gold', 'running', {_NOW}, NULL FROM customer""",
    RUN_LOG_SQL,
)
def run_log_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new run per customer."""
    runs = b.table(spark, sf_dir, "customer").selectExpr(
        "concat('customer-', c_custkey) AS run_id", "c_mktsegment AS pipeline_name", "'gold' AS layer"
    )
    return control.start_runs(run_log(spark, sf_dir), runs, NOW).select(
        "run_id", "pipeline_name", "layer", "status", "started_at", "ended_at"
    )


@query(
    "run_log_update",
    f"""SELECT run_id, CASE WHEN status = 'running' THEN 'succeeded' ELSE status END AS status,
      CASE WHEN status = 'running' THEN {_NOW} ELSE ended_at END AS ended_at,
      CASE WHEN status = 'running' THEN 'done ' || run_id END AS message,
      CASE WHEN status = 'running' THEN {_NOW} END AS logged_at FROM run_log""",
    RUN_LOG_SQL,
)
def run_log_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every running entry is closed."""
    log = run_log(spark, sf_dir)
    results = log.filter("status = 'running'").select(
        "run_id", F.lit("succeeded").alias("new_status"), F.concat(F.lit("done "), "run_id").alias("new_message")
    )
    return control.finish_runs(log, results, NOW).select("run_id", "status", "ended_at", "message", "logged_at")
