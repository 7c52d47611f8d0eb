"""Expectations, quarantine, quality metrics and alerts.

A rule is a named SQL predicate. A row meets a rule only when the predicate is TRUE; a
NULL result counts as a failure.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stratalake.functions.scalars import USD_RATES, percent, usd_rate

# The published rules per table.
SILVER_RULES = {
    "order_items": {
        "valid_order_item_id": "order_item_id IS NOT NULL",
        "valid_order_id": "order_id IS NOT NULL",
        "valid_product_id": "product_id IS NOT NULL",
        "valid_quantity": "quantity > 0",
        "valid_unit_price": "unit_price > 0",
    },
    "orders": {
        "valid_order_id": "order_id IS NOT NULL",
        "valid_customer_id": "customer_id IS NOT NULL",
        "valid_order_total": "total_amount > 0",
    },
    "customers": {"valid_customer_id": "customer_id IS NOT NULL"},
    "products": {
        "valid_product_id": "product_id IS NOT NULL",
        "valid_unit_price": "unit_price > 0",
        "valid_category": "category IS NOT NULL",
    },
}
ORDER_RULES = {
    "valid_order_id": "order_id IS NOT NULL",
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_order_status": "order_status IN ('Delivered', 'Shipped', 'Pending')",
}
ORDER_WARNINGS = {"valid_order_total": "order_total > 0"}
CUSTOMER_RULES = {
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_name": "name IS NOT NULL AND length(name) > 0",
}
CUSTOMER_WARNINGS = {"valid_country": "country IS NOT NULL", "recent_signup": "signup_date >= '2023-01-01'"}

REVENUE_DROP_PCT = -20.0
MIN_DAILY_ORDERS = 10
MIN_PASS_RATE = 95.0
LOW_VOLUME = 100


class ExpectationFailed(ValueError):
    """A rule that must hold was broken."""


def rules_for(table: str, registry: dict[str, dict[str, str]] | None = None) -> dict[str, str]:
    """The rules of a table, or ValueError when none are registered."""
    rules = (SILVER_RULES if registry is None else registry).get(table)
    if not rules:
        raise ValueError(f"no expectations registered for table {table!r}")
    return rules


def meets(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def meets_all(rules: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [meets(r) for r in rules.values()])


def failed_rules(rules: dict[str, str]) -> Column:
    """Names of the broken rules, in rule order."""
    names = F.array(*[F.when(~meets(r), F.lit(n)) for n, r in rules.items()])
    return F.array_compact(names)


# -- expectations ----------------------------------------------------------


def expect(df: DataFrame, rules: dict[str, str], observation: Observation | str | None = None) -> DataFrame:
    """Keep every row; failure counts are observed while the data passes through.

    The counts are for watching, not for decisions: rows of a task that had to be run again
    are counted again. Use `violations` or `require` where the number matters.

    Pass an Observation for a batch, or a name for a stream (the counts then appear in the
    progress of the query).
    """
    if observation is None:
        return df
    counts = [F.count_if(~meets(r)).cast("bigint").alias(n) for n, r in rules.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)


def expect_or_drop(df: DataFrame, name: str, rule: str) -> DataFrame:
    return expect_all_or_drop(df, {name: rule})


def expect_all_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.where(meets_all(rules))


def expect_all_or_fail(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Pass the rows on, but fail the running job (or micro-batch) at the first bad row,
    before anything is committed."""
    why = F.concat(F.lit("expectation failed: "), F.array_join(failed_rules(rules), ", "))
    return df.where(F.when(meets_all(rules), F.lit(True)).otherwise(F.raise_error(why).cast("boolean")))


def violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(rule, failed, total) in rule order of the dict, from one pass over the data."""
    total = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(~meets(r)).alias(f"f{i}") for i, r in enumerate(rules.values())]
    )
    pairs = ", ".join(f"'{n}', f{i}" for i, n in enumerate(rules))
    return total.selectExpr(f"stack({len(rules)}, {pairs}) AS (rule, failed)", "total")


def require(df: DataFrame, rules: dict[str, str]) -> None:
    """Raise ExpectationFailed with the counts when any rule is broken."""
    broken = {r["rule"]: r["failed"] for r in violations(df, rules).collect() if r["failed"]}
    if broken:
        raise ExpectationFailed(f"expectations failed: {broken}")


def split(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(passed, quarantined); quarantined rows carry the names of the rules they broke."""
    tagged = df.withColumn("failed_rules", failed_rules(rules))
    return tagged.where("size(failed_rules) = 0").drop("failed_rules"), tagged.where("size(failed_rules) > 0")


# -- star-schema checks ----------------------------------------------------


def missing_dimensions(fact: DataFrame) -> DataFrame:
    """Number of facts without a product or customer key."""
    lost = F.col("product_sk").isNull() | F.col("customer_sk").isNull()
    return fact.agg(F.count_if(lost).alias("MissingDimensionAttributes"))


def incomplete_rows(dim: DataFrame, columns: list[str]) -> DataFrame:
    """Dimension rows with a NULL in any of the columns."""
    return dim.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def freshness(df: DataFrame, changed: str, as_of: Column, days: int = 3) -> DataFrame:
    """Whether the last change lies more than `days` before `as_of`."""
    return df.agg(F.max(changed).alias("last_altered")).select(
        "last_altered", (F.col("last_altered") < as_of - F.make_dt_interval(F.lit(days))).alias("is_stale")
    )


def primary_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys shared by several rows, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


# -- sales events ----------------------------------------------------------


def _complete() -> Column:
    return F.col("event_id").isNotNull() & F.col("customer_id").isNotNull() & F.col("event_timestamp").isNotNull()


def _valid_amounts() -> Column:
    return F.coalesce((F.col("quantity") > 0) & (F.col("unit_price") > 0), F.lit(False))


def clean_sales(df: DataFrame, execution_date: str, rates: dict[str, float] | None = None) -> DataFrame:
    """Complete rows with positive amounts, standard codes and the revenue in USD."""
    code = F.upper(F.trim(F.col("currency")))
    return df.where(_complete() & _valid_amounts()).select(
        "event_id",
        "customer_id",
        "product_id",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price") * usd_rate(code, rates)).alias("revenue_usd"),
        code.alias("currency"),
        F.upper(F.trim(F.col("region"))).alias("region"),
        F.to_date("event_timestamp").cast("string").alias("event_date"),
        "event_timestamp",
        F.lit(True).alias("is_valid"),
        F.lit(execution_date).alias("processing_date"),
    )


def _clean_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("input_records"),
        F.count_if(_complete() & _valid_amounts()).alias("output_records"),
        F.count_if(~_complete()).alias("null_records_dropped"),
        F.count_if(_complete() & ~_valid_amounts()).alias("invalid_amount_dropped"),
    ]


def _clean_rates(execution_date: str) -> list[Column]:
    return [
        (F.col("input_records") - F.col("output_records")).alias("total_records_dropped"),
        F.coalesce(percent(F.col("output_records"), F.col("input_records")), F.lit(0.0)).alias("pass_rate_pct"),
        F.lit(execution_date).alias("execution_date"),
    ]


def clean_metrics(df: DataFrame, execution_date: str) -> DataFrame:
    """One row of counts for `clean_sales`, from a single pass over the raw rows."""
    return df.agg(*_clean_counts()).select("*", *_clean_rates(execution_date))


def clean_and_enrich_sales(
    df: DataFrame, execution_date: str, exchange_rates: dict[str, float] | None = None
) -> tuple[DataFrame, dict]:
    """(cleaned rows, metrics dict)."""
    rates = USD_RATES if exchange_rates is None else exchange_rates
    return clean_sales(df, execution_date, rates), clean_metrics(df, execution_date).first().asDict()


CRITICAL = ["event_id", "customer_id", "revenue_usd", "event_date"]


def output_checks(df: DataFrame) -> DataFrame:
    """One row: NULL counts of the critical columns, non-positive revenue, total."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL],
        F.count_if(F.col("revenue_usd") <= 0).alias("non_positive_revenue"),
    )


def passes(checks: dict, min_pass_rate: float = MIN_PASS_RATE, pass_rate: float | None = None) -> bool:
    """Verdict on a row of `output_checks`."""
    if checks["total_records"] < LOW_VOLUME:
        low = f"very low record count: {checks['total_records']}, expected at least {LOW_VOLUME}"
        warnings.warn(low, stacklevel=3)
    faults = sum(n for name, n in checks.items() if name != "total_records")
    return faults == 0 and (pass_rate is None or pass_rate >= min_pass_rate)


def validate_output(df: DataFrame, min_pass_rate: float = MIN_PASS_RATE, pass_rate: float | None = None) -> bool:
    """True when no critical value is NULL, every revenue is positive and, when the pass
    rate of the cleaning step is given, it reaches the minimum."""
    return passes(output_checks(df).first().asDict(), min_pass_rate, pass_rate)


def metrics_and_checks(df: DataFrame, execution_date: str, rates: dict[str, float] | None = None) -> tuple[dict, dict]:
    """`clean_metrics` and the `output_checks` of the cleaned rows, from one aggregate over
    the raw rows. (Observed metrics would not do here: they count a re-run task twice.)"""
    ok = _complete() & _valid_amounts()
    revenue = F.col("quantity") * F.col("unit_price") * usd_rate(F.upper(F.trim("currency")), rates)
    value = {
        "event_id": F.col("event_id"),
        "customer_id": F.col("customer_id"),
        "revenue_usd": revenue,
        "event_date": F.to_date("event_timestamp"),
    }
    checks = [F.count_if(ok & value[c].isNull()).alias(f"null_{c}") for c in CRITICAL]
    checks.append(F.count_if(ok & (revenue <= 0)).alias("non_positive_revenue"))
    names = [f"null_{c}" for c in CRITICAL] + ["non_positive_revenue"]
    row = df.agg(*_clean_counts(), *checks).select("*", *_clean_rates(execution_date)).first().asDict()
    found = {name: row.pop(name) for name in names}
    return row, {"total_records": row["output_records"], **found}


# -- alerts ----------------------------------------------------------------


def revenue_change(daily: DataFrame) -> DataFrame:
    """Change against the previous row of the daily series (one row per calendar day, so
    the unpartitioned window sorts a few thousand rows at most per decade)."""
    w = Window.orderBy("date")
    prev = F.lag("total_revenue").over(w)
    return daily.select("date", "total_revenue", prev.alias("prev_revenue")).withColumn(
        "revenue_change_pct", percent(F.col("total_revenue") - F.col("prev_revenue"), F.col("prev_revenue"))
    )


def revenue_alert(daily: DataFrame, threshold: float = REVENUE_DROP_PCT) -> DataFrame:
    """The latest day with its change and whether the drop passes the threshold."""
    newest_two = daily.select("date", "total_revenue").orderBy(F.desc("date")).limit(2)
    latest = revenue_change(newest_two).orderBy(F.desc("date")).limit(1)
    return latest.withColumn("alert", F.coalesce(F.col("revenue_change_pct") < threshold, F.lit(False)))


def order_alert(daily: DataFrame, minimum: int = MIN_DAILY_ORDERS) -> DataFrame:
    """The latest day with its order count and whether it is below the minimum."""
    latest = daily.select("date", "total_orders").orderBy(F.desc("date")).limit(1)
    return latest.withColumn("alert", F.col("total_orders") < minimum)
