"""Job-run, freshness and cost queries over operational tables.

Tables (see FIXTURES.md): jobs, job_run_timeline, job_runs, usage, list_prices,
maintenance_ops. Every look-back ends at `as_of`, an argument rather than the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.scalars import minutes_between, percent
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.intervals import validity_join

TOP = 20


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(days))


def current_jobs(jobs: DataFrame) -> DataFrame:
    """The newest definition of each job."""
    return latest_per_key(jobs, ["workspace_id", "job_id"], [F.col("change_time").desc(), F.col("name")])


def run_history(timeline: DataFrame, jobs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = timeline.where(F.col("period_start_time") > days_before(as_of, days))
    named = current_jobs(jobs).select("workspace_id", "job_id", F.col("name").alias("job_name"))
    return recent.join(named, ["workspace_id", "job_id"]).select(
        "workspace_id",
        "job_name",
        "job_id",
        "run_id",
        "result_state",
        F.col("period_start_time").alias("run_start"),
        F.col("period_end_time").alias("run_end"),
        F.round(F.timestamp_diff("SECOND", F.col("period_start_time"), F.col("period_end_time")) / 60.0, 2).alias(
            "duration_minutes"
        ),
    )


def one_job_history(runs: DataFrame, jobs: DataFrame, name: str, as_of: Column, days: int = 30) -> DataFrame:
    wanted = jobs.where(F.col("name") == name).select("job_id", F.col("name").alias("job_name")).distinct()
    return (
        runs.where(F.col("start_time") >= days_before(as_of, days))
        .join(wanted, "job_id")
        .select(
            "job_name",
            "run_id",
            "result_state",
            "start_time",
            "end_time",
            minutes_between("start_time", "end_time").alias("duration_minutes"),
            "trigger_type",
        )
        .orderBy(F.desc("start_time"), "run_id")
    )


def success_rate(timeline: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    done = timeline.where(
        F.col("result_state").isNotNull() & (F.col("period_start_time") > days_before(as_of, days))
    )
    return (
        done.groupBy("workspace_id", F.to_date("period_end_time").alias("run_date"))
        .agg(
            F.count(F.lit(1)).alias("total_completed_runs"),
            F.count_if(F.col("result_state") == "SUCCEEDED").alias("successful_runs"),
            F.count_if(F.col("result_state") != "SUCCEEDED").alias("failed_or_other_runs"),
        )
        .withColumn("success_rate_pct", percent(F.col("successful_runs"), F.col("total_completed_runs")))
        .orderBy(F.desc("run_date"), "workspace_id")
    )


def _job_key(runs: DataFrame, jobs: DataFrame) -> list[str]:
    """Ids of jobs count per workspace where both tables name it."""
    return [c for c in ("workspace_id", "job_id") if c in runs.columns and c in jobs.columns]


def _with_names(runs: DataFrame, jobs: DataFrame, key: list[str]) -> DataFrame:
    """`runs` with `job_name`: of a table with a row per change, the newest."""
    if "change_time" not in jobs.columns:
        return runs.join(jobs.select(*key, F.col("name").alias("job_name")), key)
    newest = F.max_by("name", F.struct("change_time", "name"))
    return runs.join(jobs.groupBy(*key).agg(newest.alias("job_name")), key)


def recent_failures(runs: DataFrame, jobs: DataFrame, as_of: Column, days: int = 7, top: int = TOP) -> DataFrame:
    failed = runs.where((F.col("result_state") == "FAILED") & (F.col("start_time") >= days_before(as_of, days)))
    return (
        _with_names(failed, jobs, _job_key(runs, jobs))
        .select("job_name", "run_id", "start_time", "end_time", "state_message")
        .orderBy(F.desc("start_time"), "run_id")
        .limit(top)
    )


def duration_trend(runs: DataFrame, jobs: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Runs are aggregated per (job, day) before the join with the job names."""
    minutes = (F.unix_timestamp("end_time") - F.unix_timestamp("start_time")) / 60
    key = _job_key(runs, jobs)
    per_job = (
        runs.where(F.col("start_time") >= days_before(as_of, days))
        .groupBy(*key, F.to_date("start_time").alias("run_date"))
        .agg(
            F.count(F.lit(1)).alias("run_count"),
            F.avg(minutes).alias("avg_duration_min"),
            F.max(minutes).alias("max_duration_min"),
            F.count_if(F.col("result_state") == "FAILED").alias("failure_count"),
        )
    )
    return (
        _with_names(per_job, jobs, key)
        .select("job_name", "run_date", "run_count", "avg_duration_min", "max_duration_min", "failure_count")
        .orderBy("job_name", F.desc("run_date"))
    )


# -- cost ------------------------------------------------------------------


def cost_at_list_price(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Usage valued at the price in force, closed at the end: the usage must end by the
    price's end."""
    wanted = prices.select(
        "cloud", "sku_name", "price_start_time", "price_end_time", F.col("pricing.default").alias("unit_price")
    )
    priced = validity_join(
        usage.select(
            "cloud", "sku_name", "workspace_id", "billing_origin_product", "usage_start_time", "usage_end_time",
            "usage_quantity",
        ),
        wanted,
        ["cloud", "sku_name"],
        at=F.col("usage_start_time"),
        start=F.col("price_start_time"),
        end=F.col("price_end_time"),
        ends_before=F.col("usage_end_time"),
    )
    return priced.groupBy("workspace_id", "billing_origin_product", "sku_name").agg(
        F.sum(F.col("usage_quantity") * F.col("unit_price")).alias("list_cost")
    )


def cost_by_sku_day(usage: DataFrame, prices: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Compute usage valued at the effective price of its day (half-open validity)."""
    recent = usage.where((F.col("usage_type") == "COMPUTE_TIME") & (F.col("usage_date") >= F.date_sub(as_of, days)))
    wanted = prices.select(
        "sku_name",
        F.to_date("price_start_time").alias("from_date"),
        F.to_date("price_end_time").alias("to_date"),
        F.col("pricing.effective_list.default").alias("unit_price"),
    )
    priced = validity_join(
        recent.select("workspace_id", "usage_date", "sku_name", "usage_quantity"),
        wanted,
        ["sku_name"],
        at=F.col("usage_date"),
        start=F.col("from_date"),
        end=F.col("to_date"),
    )
    return (
        priced.groupBy("workspace_id", "usage_date", F.col("sku_name").alias("cluster_type"))
        .agg(
            F.sum("usage_quantity").alias("dbus_consumed"),
            F.sum(F.col("usage_quantity") * F.col("unit_price")).alias("dbu_cost_usd"),
        )
        .orderBy("workspace_id", "usage_date", "cluster_type")
    )


def _spend() -> list[Column]:
    return [
        F.sum("usage_quantity").alias("total_dbus"),
        F.sum(F.col("usage_quantity") * F.col("list_price")).alias("estimated_cost_usd"),
    ]


def _recent(usage: DataFrame, as_of: Column, days: int) -> DataFrame:
    return usage.where(F.col("usage_start_time") >= days_before(as_of, days))


def cost_by_cluster_day(usage: DataFrame, as_of: Column, days: int = 30, top: int = TOP) -> DataFrame:
    keys = ["usage_date", "cluster_id", "cluster_name"]
    return (
        _recent(usage, as_of, days)
        .where(F.col("sku_name").like("%JOBS%"))
        .groupBy(F.to_date("usage_start_time").alias("usage_date"), "cluster_id", "cluster_name")
        .agg(*_spend())
        .orderBy(F.desc("estimated_cost_usd"), *keys)
        .limit(top)
    )


def cost_by_team(usage: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return (
        _recent(usage, as_of, days)
        .groupBy(
            F.col("usage_metadata.cluster_tags.Team").alias("team"),
            F.col("usage_metadata.cluster_tags.Project").alias("project"),
        )
        .agg(*_spend())
        .orderBy(F.desc("estimated_cost_usd"), "team", "project")
    )


def cost_by_job(usage: DataFrame, as_of: Column, days: int = 30, top: int = TOP) -> DataFrame:
    named = F.col("usage_metadata.job_name")
    return (
        _recent(usage, as_of, days)
        .where(F.col("sku_name").like("%JOBS%") & named.isNotNull())
        .groupBy(named.alias("job_name"))
        .agg(*_spend())
        .orderBy(F.desc("estimated_cost_usd"), "job_name")
        .limit(top)
    )


def maintenance_cost(ops: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return (
        ops.where(F.col("operation_timestamp") >= days_before(as_of, days))
        .groupBy("operation_type")
        .agg(
            F.count(F.lit(1)).alias("operation_count"),
            (F.sum("optimized_files_size_bytes") / F.lit(1e9)).alias("total_gb_processed"),
        )
        .orderBy(F.desc("total_gb_processed"), "operation_type")
    )
