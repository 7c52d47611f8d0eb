"""Registered queries: job monitoring and cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.operators.joins import overlapping_validity
from stratalake.plans import monitoring as m
from stratalake.queries import entities as e
from stratalake.queries.entities import AS_OF, check
from stratalake.queries.registry import query

SINCE = f"TIMESTAMP '{AS_OF}' - INTERVAL {{}} DAY"
MINUTES = "round((floor(epoch(end_time)) - floor(epoch(start_time))) / 60, 2)"


@query(
    "mon_run_history",
    check(
        "timeline jobs",
        f"""SELECT t.workspace_id, j.name AS job_name, t.job_id, t.run_id, t.result_state,
              t.period_start_time AS run_start, t.period_end_time AS run_end,
              round((epoch(t.period_end_time) - epoch(t.period_start_time)) / 60.0, 2) AS duration_minutes
            FROM timeline t JOIN (SELECT * FROM jobs QUALIFY row_number() OVER (PARTITION BY workspace_id, job_id
              ORDER BY change_time DESC) = 1) j ON t.workspace_id = j.workspace_id AND t.job_id = j.job_id
            WHERE t.period_start_time > {SINCE.format(7)}""",
    ),
)
def mon_run_history(spark, sf):
    return m.run_history(e.job_run_timeline(spark, sf), e.jobs(spark, sf), e.as_of())


@query(
    "mon_run_history_30d",
    check(
        "runs job_names",
        f"""SELECT name AS job_name, run_id, result_state, start_time, end_time, {MINUTES} AS duration_minutes, trigger_type
            FROM runs JOIN job_names USING (job_id) WHERE name = 'job-41' AND start_time >= {SINCE.format(30)}""",
    ),
)
def mon_run_history_30d(spark, sf):
    return m.one_job_history(e.job_runs(spark, sf), e.job_names(spark, sf), "job-41", e.as_of())


@query(
    "mon_success_rate",
    check(
        "timeline",
        f"""SELECT workspace_id, CAST(period_end_time AS DATE) AS run_date, count(*) AS total_completed_runs,
              count(*) FILTER (result_state = 'SUCCEEDED') AS successful_runs,
              count(*) FILTER (result_state <> 'SUCCEEDED') AS failed_or_other_runs,
              round(count(*) FILTER (result_state = 'SUCCEEDED') * 100.0::DOUBLE / count(*), 2) AS success_rate_pct
            FROM timeline WHERE result_state IS NOT NULL AND period_start_time > {SINCE.format(30)} GROUP BY 1, 2""",
    ),
)
def mon_success_rate(spark, sf):
    return m.success_rate(e.job_run_timeline(spark, sf), e.as_of())


#: The newest name of each job.
CURRENT = """, job_names AS (SELECT * FROM job_versions
    QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY change_time DESC, name DESC) = 1)"""


@query(
    "mon_recent_failures",
    check(
        "runs job_versions",
        f"""{CURRENT} SELECT name AS job_name, run_id, start_time, end_time, state_message FROM runs JOIN job_names USING (job_id)
            WHERE result_state = 'FAILED' AND start_time >= {SINCE.format(7)} ORDER BY start_time DESC, run_id LIMIT 20""",
    ),
)
def mon_recent_failures(spark, sf):
    return m.recent_failures(e.job_runs(spark, sf), e.job_versions(spark, sf), e.as_of())


@query(
    "mon_duration_trend",
    check(
        "runs job_versions",
        f"""{CURRENT}, r AS (SELECT *, (floor(epoch(end_time)) - floor(epoch(start_time))) / 60 AS minutes FROM runs
               WHERE start_time >= {SINCE.format(30)})
            SELECT name AS job_name, CAST(start_time AS DATE) AS run_date, count(*) AS run_count,
              round(avg(minutes), 9) AS avg_duration_min, max(minutes) AS max_duration_min,
              count(*) FILTER (result_state = 'FAILED') AS failure_count
            FROM r JOIN job_names USING (job_id) GROUP BY 1, 2""",
    ),
)
def mon_duration_trend(spark, sf):
    trend = m.duration_trend(e.job_runs(spark, sf), e.job_versions(spark, sf), e.as_of())
    return trend.withColumn("avg_duration_min", F.round("avg_duration_min", 9))


@query(
    "cost_list_price",
    check(
        "usage list_prices",
        """, long AS (SELECT * REPLACE (usage_start_time + to_months(CAST(usage_quantity % 6 AS INTEGER)) AS usage_start_time,
             usage_end_time + to_months(CAST(usage_quantity % 6 AS INTEGER)) AS usage_end_time) FROM usage)
           SELECT workspace_id, billing_origin_product, u.sku_name, sum(usage_quantity * default_price) AS list_cost
           FROM long u JOIN list_prices p ON u.cloud = p.cloud AND u.sku_name = p.sku_name
             AND u.usage_start_time >= p.price_start_time
             AND (u.usage_end_time <= p.price_end_time OR p.price_end_time IS NULL) GROUP BY 1, 2, 3""",
    ),
)
def cost_list_price(spark, sf):
    return m.cost_at_list_price(e.long_usage(spark, sf), e.list_prices(spark, sf))


@query(
    "cost_by_sku_day",
    check(
        "usage list_prices",
        f"""SELECT workspace_id, usage_date, u.sku_name AS cluster_type, sum(usage_quantity) AS dbus_consumed,
              sum(usage_quantity * effective_price) AS dbu_cost_usd
            FROM usage u JOIN list_prices p ON u.sku_name = p.sku_name
              AND u.usage_date >= CAST(p.price_start_time AS DATE)
              AND (p.price_end_time IS NULL OR u.usage_date < CAST(p.price_end_time AS DATE))
            WHERE usage_type = 'COMPUTE_TIME' AND usage_date >= DATE '{AS_OF}' - 7 GROUP BY 1, 2, 3""",
    ),
)
def cost_by_sku_day(spark, sf):
    return m.cost_by_sku_day(e.usage(spark, sf), e.list_prices(spark, sf), F.lit(AS_OF).cast("date"))


SPEND = "sum(usage_quantity) AS total_dbus, sum(usage_quantity * list_price) AS estimated_cost_usd"


@query(
    "cost_by_cluster_day",
    check(
        "usage",
        f"""SELECT CAST(usage_start_time AS DATE) AS usage_date, cluster_id, cluster_name, {SPEND} FROM usage
            WHERE usage_start_time >= {SINCE.format(30)} AND sku_name LIKE '%JOBS%' GROUP BY 1, 2, 3
            ORDER BY estimated_cost_usd DESC, usage_date, cluster_id, cluster_name LIMIT 20""",
    ),
)
def cost_by_cluster_day(spark, sf):
    return m.cost_by_cluster_day(e.usage(spark, sf), e.as_of())


@query(
    "cost_by_team",
    check("usage", f"SELECT team, project, {SPEND} FROM usage WHERE usage_start_time >= {SINCE.format(30)} GROUP BY 1, 2"),
)
def cost_by_team(spark, sf):
    return m.cost_by_team(e.usage(spark, sf), e.as_of())


@query(
    "cost_by_job",
    check(
        "usage",
        f"""SELECT job_name, {SPEND} FROM usage WHERE usage_start_time >= {SINCE.format(30)} AND sku_name LIKE '%JOBS%'
              AND job_name IS NOT NULL GROUP BY 1 ORDER BY estimated_cost_usd DESC, job_name LIMIT 20""",
    ),
)
def cost_by_job(spark, sf):
    return m.cost_by_job(e.usage(spark, sf), e.as_of())


@query(
    "cost_maintenance",
    check(
        "ops",
        f"""SELECT operation_type, count(*) AS operation_count,
              CAST(sum(optimized_files_size_bytes) AS DOUBLE) / 1e9 AS total_gb_processed
            FROM ops WHERE operation_timestamp >= {SINCE.format(7)} GROUP BY 1""",
    ),
)
def cost_maintenance(spark, sf):
    return m.maintenance_cost(e.maintenance_ops(spark, sf), e.as_of())


@query(
    "cost_price_overlap",
    """SELECT user_id, event_id, ts AS starts FROM (SELECT *, max(ts + to_hours(6)) OVER (PARTITION BY user_id ORDER BY ts
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM events) WHERE ts < reach""",
)
def cost_price_overlap(spark, sf):
    """The overlap guard on six-hour intervals that start at each event of a user."""
    starts = F.col("ts").cast("timestamp")
    spans = e.load(spark, sf, "events").select(
        "user_id", "event_id", starts.alias("starts"), (starts + F.expr("INTERVAL 6 HOURS")).alias("ends")
    )
    return overlapping_validity(spans, ["user_id"], "starts", "ends").drop("ends")
