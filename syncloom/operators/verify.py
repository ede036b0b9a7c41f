"""Verification: count reconciliation, run reports, audit and error classes, topic statistics, lag and health."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .chunks import lag
from .keys import top_rows

#: Share of the source (percent) below which a mismatch is a warning; seconds of a slow run; lag and load that are expected.
MINOR_PERCENT, SLOW_SECONDS, MOST_LAG, DAILY_RECORDS, MOST_IMBALANCE = 0.1, 1200, 100_000, 5_000_000, 2.0
#: Alerts that a roll-up spells out.
MOST_ALERTS = 10
#: What transient connection errors say, and their SQL states.
TRANSIENT = "(?i)connection|timeout|communication link|tcp provider|login timeout|broken pipe"
TRANSIENT_STATES = "08S01|HYT00|HYT01|08001"


def reconciled(source: DataFrame, target: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of source and target (for each group), difference, percent of the source and status."""
    n = F.count(F.lit(1))
    if by:
        s, t = source.groupBy(*by).agg(n.alias("source_rows")), target.groupBy(*by).agg(n.alias("target_rows"))
        both = s.join(t, list(by), "full_outer").fillna(0, ["source_rows", "target_rows"])
    else:
        both = source.agg(n.alias("source_rows")).join(target.agg(n.alias("target_rows")))
    diff = F.abs(F.col("source_rows") - F.col("target_rows"))
    percent = F.when(F.col("source_rows") > 0, diff / F.col("source_rows") * 100).otherwise(F.lit(0.0))
    status = F.when(diff == 0, "success").when(percent < MINOR_PERCENT, "success_with_warning").otherwise("failed")
    return both.withColumn("diff", diff).withColumn("diff_percent", F.round(percent, 4)).withColumn("status", status)


def min_rows_check(df: DataFrame, least: int) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("rows"), (n >= least).alias("passed"))


def run_metrics(df: DataFrame, batch_rows: int, expected: int | None = None, started: Column | None = None, ended: Column | None = None, failed: int = 0) -> DataFrame:
    """One run row: records, failed, batches, progress in percent of what was expected, seconds and records a second (NULL without a start or any time passed)."""
    return _run_row(df.agg(F.count(F.lit(1)).alias("records")), batch_rows, expected, started, ended, failed)


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict[str, Any]:
    """Write df and tell records and other aggregates of what was written, counted in that same job; nothing is read a second time."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("records"), *[c.alias(name) for name, c in metrics.items()]))
    return dict(seen.get)


def run_row(spark: SparkSession, records: int, batch_rows: int, expected: int | None = None, started: Column | None = None, ended: Column | None = None, failed: int = 0) -> DataFrame:
    """The run row of `run_metrics` for a number of records that an observed write has told."""
    return _run_row(spark.createDataFrame([(records,)], "records bigint"), batch_rows, expected, started, ended, failed)


def _run_row(counted: DataFrame, batch_rows: int, expected: int | None, started: Column | None, ended: Column | None, failed: int) -> DataFrame:
    n = F.col("records")
    ended = F.current_timestamp() if ended is None else ended
    seconds = F.lit(None).cast("double") if started is None else (ended.cast("timestamp").cast("double") - started.cast("timestamp").cast("double"))
    progress = F.lit(100.0) if expected is None else F.lit(0.0) if expected == 0 else F.round(n / F.lit(expected) * 100, 2)
    done = counted.select("records", F.lit(failed).cast("bigint").alias("failed"), F.ceil(n / batch_rows).alias("batches"), progress.alias("progress_percent"))
    rate = F.when(F.col("duration_seconds") > 0, F.round(F.col("records") / F.col("duration_seconds"), 4))
    return done.withColumn("ended", ended).withColumn("duration_seconds", seconds).withColumn("records_per_second", rate)


def run_report(runs: DataFrame, by: str = "store") -> DataFrame:
    """Sums over successful runs for each group and in all (NULL group); a run longer than SLOW_SECONDS makes its group slow."""
    sums = [F.sum(c).alias(c) for c in ("inserted", "updated", "deleted", "duration_seconds")]
    good = runs.filter("status = 'success'")
    return good.rollup(by).agg(F.count(F.lit(1)).alias("runs"), *sums, F.sum(F.col("inserted") + F.col("updated")).alias("records"), (F.max("duration_seconds") > SLOW_SECONDS).alias("slow"))


def audit_events(events: DataFrame, event_type: Column, task: Column, status: Column, details: Sequence[str], error: Column | None = None, at: Column | None = None, **run: str) -> DataFrame:
    """Audit rows: event_at, one column for each of `run` (such as its name and id), task, event_type, status, details as JSON (NULL fields left out), error.

    An error stands only with the status failed.
    """
    at = F.current_timestamp() if at is None else at
    said = F.to_json(F.struct(*details)) if details else F.lit("{}")
    why = F.lit(None).cast("string") if error is None else F.when(status == "failed", error)
    return events.select(at.alias("event_at"), *[F.lit(v).alias(k) for k, v in run.items()], task.alias("task"), event_type.alias("event_type"), status.alias("status"), said.alias("details"), why.alias("error"))


def audit_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", "status").agg(F.count(F.lit(1)).alias("events"))


def error_class(message: Column, state: Column | None = None) -> Column:
    """transient, deadlock, permanent, or NULL without a message."""
    deadlock = message.contains("1205") & F.lower(message).contains("deadlock")
    by_state = F.lit(False)
    if state is not None:
        deadlock, by_state = deadlock | (state == "40001"), state.rlike(f"^({TRANSIENT_STATES})$")
    transient = message.rlike(TRANSIENT) | message.rlike(TRANSIENT_STATES) | by_state
    return F.when(message.isNull() & (F.lit(True) if state is None else state.isNull()), F.lit(None).cast("string")).when(deadlock, "deadlock").when(transient, "transient").otherwise("permanent")


def topic_stats(messages: DataFrame) -> DataFrame:
    """topic, partition_id, low_offset, high_offset (the next to come), messages."""
    return messages.groupBy("topic", "partition_id").agg(F.min("msg_offset").alias("low_offset"), (F.max("msg_offset") + 1).alias("high_offset"), F.count(F.lit(1)).alias("messages"))


def consumer_lag(offsets: DataFrame, most: int = MOST_LAG) -> DataFrame:
    """Lag of each partition and, with a NULL partition, of the topic; status warning above `most`."""
    each = offsets.withColumn("lag", lag(F.col("high_offset"), F.col("low_offset"), F.col("committed_offset")))
    total = each.rollup("topic", "partition_id").agg(F.sum("lag").alias("lag")).filter("topic is not null")
    return total.withColumn("status", F.when(F.col("lag") > most, "warning").otherwise("healthy"))


def topic_health(offsets: DataFrame, daily: int = DAILY_RECORDS) -> DataFrame:
    """For each topic: total lag, status (no lag, below a tenth of a day's records, more), partition imbalance and whether it is too great."""
    n = F.col("high_offset") - F.col("low_offset")
    t = offsets.groupBy("topic").agg(F.sum(lag(F.col("high_offset"), F.col("low_offset"), F.col("committed_offset"))).alias("total_lag"), F.max(n).alias("most"), F.min(n).alias("least"))
    status = F.when(F.col("total_lag") == 0, "healthy").when(F.col("total_lag") < daily * 0.1, "warning").otherwise("critical")
    uneven = (F.col("least") <= 0) | (F.col("most") > F.col("least") * MOST_IMBALANCE)
    return t.select("topic", "total_lag", status.alias("status"), F.round(F.when(F.col("least") > 0, F.col("most") / F.col("least")), 4).alias("imbalance"), uneven.alias("uneven"))


def health_rollup(checks: DataFrame, by: str = "topic") -> DataFrame:
    """One status from many: any error, else any warning, else healthy if all are healthy, success or skipped, else unknown; and the alerts.

    alert_count counts all alerts; `alerts` tells the first MOST_ALERTS of them in order of their text, so that it is bounded.
    """
    rank = F.when(F.col("status") == "error", 3).when(F.col("status") == "warning", 2).when(F.col("status").isin("healthy", "success", "skipped"), 0).otherwise(1)
    worst = F.max("_rank")
    status = F.when(worst == 3, "error").when(worst == 2, "warning").when(worst == 0, "healthy").otherwise("unknown")
    ranked = checks.withColumn("_rank", rank).withColumn("_alert", F.concat_ws(": ", "check", "status"))
    whole = ranked.groupBy(by).agg(status.alias("status"), F.count(F.when(F.col("_rank") >= 2, 1)).alias("alert_count"))
    told = top_rows(ranked.filter("_rank >= 2").select(by, "_alert"), [by], [F.col("_alert")], MOST_ALERTS)
    told = told.groupBy(F.col(by).alias("_by")).agg(F.concat_ws("; ", F.sort_array(F.collect_list("_alert"))).alias("alerts"))
    joined = whole.join(told, F.col(by).eqNullSafe(F.col("_by")), "left")
    return joined.select(by, "status", F.coalesce("alerts", F.lit("")).alias("alerts"), "alert_count")
