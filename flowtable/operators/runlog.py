"""Reports over a run log: health per key, latest failure, failure alert texts.

A run log is any frame with a key, a status, a time and an error text.  Each report is
one aggregation (partial + final, so a very busy key is combined map-side) and, for the
health summary, an optional left join onto the list of registered keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtable.functions.columns import col, truncate

# Alert layout and truncation lengths kept equal to the original tool's output.
ALERT_TITLE = "*Pipeline Failed* ✗"
ALERT_TEMPLATE = "{title}\n*Pipeline:* `{name}`\n*Run ID:* `{run_id}`\n*Error:* {error}"
ALERT_ERROR_CHARS = 500
STATUS_ERROR_CHARS = 120


def _failed(status: str, failed_value: str) -> Column:
    return col(status) == F.lit(failed_value)


def run_health(
    runs: DataFrame,
    key: str = "pipeline_name",
    status: str = "status",
    ts: str = "run_timestamp",
    error: str = "error_message",
    failed_value: str = "FAILED",
    registered: DataFrame | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Per key: total runs, failures, last run time, last status, last failure's error (120 chars).

    "Last error" is the error of the latest *failed* run, even if a later run succeeded.
    With ``registered`` (one row per key), keys that never ran appear with zero runs.  ``tie`` orders
    runs of the same time; without it their order is undefined.
    """
    failed = _failed(status, failed_value)
    order = F.struct(col(ts), col(tie)) if tie else col(ts)
    stats = runs.groupBy(col(key)).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(failed).alias("failures"),
        F.max(col(ts)).alias("last_run_at"),
        F.max_by(col(status), order).alias("last_status"),
        F.max_by(truncate(error, STATUS_ERROR_CHARS), F.when(failed, order)).alias("last_error"),
    )
    if registered is None:
        return stats
    # the run log is the source of truth for run statistics: its columns win over same-named ones
    keep = [c for c in registered.columns if c == key or c not in stats.columns]
    joined = registered.select(*keep).join(stats, key, "left")
    return joined.withColumn("total_runs", F.coalesce("total_runs", F.lit(0).cast("long"))).withColumn(
        "failures", F.coalesce("failures", F.lit(0).cast("long"))
    )


def latest_failure(
    runs: DataFrame,
    key: str = "pipeline_name",
    status: str = "status",
    ts: str = "run_timestamp",
    error: str = "error_message",
    failed_value: str = "FAILED",
    chars: int = STATUS_ERROR_CHARS,
    tie: str | None = None,
) -> DataFrame:
    """Per key with at least one failure: time and (truncated) error of the latest failed run.
    ``tie`` orders failures of the same time."""
    fails = runs.where(_failed(status, failed_value))
    return fails.groupBy(col(key)).agg(
        F.max(col(ts)).alias("last_failure_at"),
        F.max_by(truncate(error, chars), F.struct(col(ts), col(tie)) if tie else col(ts)).alias("last_error"),
    )


def format_alert(name: str, run_id: str, error: str | None) -> str:
    """The alert message for a single run, formatted on the driver."""
    return ALERT_TEMPLATE.format(title=ALERT_TITLE, name=name, run_id=run_id, error=(error or "")[:ALERT_ERROR_CHARS])


def alert_text(name: Column, run_id: Column, error: Column) -> Column:
    """The failure alert message for one run."""
    head, rest = ALERT_TEMPLATE.split("{name}")
    mid, tail = rest.split("{run_id}")
    return F.concat(
        F.lit(head.replace("{title}", ALERT_TITLE)),
        name.cast("string"),
        F.lit(mid),
        run_id.cast("string"),
        F.lit(tail.replace("{error}", "")),
        F.coalesce(truncate(error, ALERT_ERROR_CHARS), F.lit("")),
    )


def failure_alerts(
    runs: DataFrame,
    name: str = "pipeline_name",
    run_id: str = "run_id",
    error: str = "error_message",
    status: str = "status",
    failed_value: str = "FAILED",
) -> DataFrame:
    """One alert message per failed run (delivery is left to the caller)."""
    return runs.where(_failed(status, failed_value)).select(
        col(run_id), col(name), alert_text(col(name), col(run_id), col(error)).alias("message")
    )
