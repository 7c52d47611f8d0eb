"""Column masks and row filters, driven by the caller's group set.

A policy is applied by rewriting a DataFrame (`secure_view`), so the masks become
ordinary expressions that the optimizer folds into the scan's projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Group names, mask texts and the regions each group may see.
PII_GROUP = "pii_viewers"
FINANCE_GROUP = "finance_team"
ADMIN_GROUP = "global_admins"
REGION_GROUPS = {
    "emea_team": ["EU", "UK", "EMEA"],
    "na_team": ["US", "CA"],
    "apac_team": ["APAC", "JP", "AU"],
}
EMAIL_MASK = "****@"
PHONE_MASK = "***-***-"


def mask_email(value: Column, groups: Iterable[str]) -> Column:
    """First two characters and the domain; an address without '@' loses both parts."""
    if PII_GROUP in set(groups):
        return value
    domain = F.get(F.split(value, "@"), 1)
    return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.concat(F.left(value, F.lit(2)), F.lit(EMAIL_MASK), domain), F.lit(EMAIL_MASK))
    )


def mask_phone(value: Column, groups: Iterable[str]) -> Column:
    """The last four digits only."""
    if PII_GROUP in set(groups):
        return value
    return F.concat(F.lit(PHONE_MASK), F.right(F.regexp_replace(value, "[^0-9]", ""), F.lit(4)))


def mask_money(value: Column, groups: Iterable[str], data_type: str = "decimal(10,2)") -> Column:
    """NULL for everyone outside finance."""
    if FINANCE_GROUP in set(groups):
        return value.cast(data_type)
    return F.lit(None).cast(data_type)


def region_allowed(region: Column, groups: Iterable[str]) -> Column:
    """True for the regions the groups may see; no matching group sees nothing."""
    held = set(groups)
    if ADMIN_GROUP in held:
        return F.lit(True)
    visible = sorted({r for g, regions in REGION_GROUPS.items() if g in held for r in regions})
    if not visible:
        return F.lit(False)
    return F.coalesce(region.isin(visible), F.lit(False))


@dataclass
class Policy:
    """Masks per column, a row filter on one column, and discovery tags."""

    masks: dict[str, Callable[[Column, Iterable[str]], Column]] = field(default_factory=dict)
    filter_column: str | None = None
    row_filter: Callable[[Column, Iterable[str]], Column] | None = None
    column_tags: dict[str, dict[str, str]] = field(default_factory=dict)
    table_tags: dict[str, str] = field(default_factory=dict)


CUSTOMER_ANALYTICS = Policy(
    masks={"email": mask_email, "phone": mask_phone, "total_revenue": mask_money},
    filter_column="region",
    row_filter=region_allowed,
    column_tags={
        "email": {"pii": "true", "sensitivity": "high"},
        "phone": {"pii": "true", "sensitivity": "high"},
    },
    table_tags={"data_classification": "confidential", "contains_pii": "true"},
)


def secure_view(df: DataFrame, policy: Policy, groups: Iterable[str]) -> DataFrame:
    """The rows and values the groups may see; tags go into the column metadata."""
    held = frozenset(groups)
    if policy.row_filter is not None:
        df = df.where(policy.row_filter(F.col(policy.filter_column), held))
    columns = []
    for name in df.columns:
        value = policy.masks[name](F.col(name), held) if name in policy.masks else F.col(name)
        tags = policy.column_tags.get(name, {})
        columns.append(value.alias(name, metadata={"tags": tags}) if tags else value.alias(name))
    return df.select(*columns)


def column_tags(df: DataFrame) -> dict[str, dict[str, str]]:
    """Tags found in the column metadata."""
    return {f.name: f.metadata["tags"] for f in df.schema.fields if "tags" in f.metadata}


def register_mask_functions(spark: SparkSession, groups: Iterable[str]) -> list[str]:
    """Temporary SQL functions of the same masks, for use in SQL text.

    SQL functions are inlined by the optimizer, so the plan holds plain expressions.
    """
    held = set(groups)
    pii = "TRUE" if PII_GROUP in held else "FALSE"
    finance = "TRUE" if FINANCE_GROUP in held else "FALSE"
    admin = "TRUE" if ADMIN_GROUP in held else "FALSE"
    visible = sorted({r for g, regions in REGION_GROUPS.items() if g in held for r in regions})
    in_region = f"coalesce(v IN ({', '.join(repr(r) for r in visible)}), FALSE)" if visible else "FALSE"
    bodies = {
        "mask_email": (
            "STRING",
            "STRING",
            f"CASE WHEN {pii} OR v IS NULL THEN v ELSE coalesce("
            f"concat(left(v, 2), '{EMAIL_MASK}', get(split(v, '@'), 1)), '{EMAIL_MASK}') END",
        ),
        "mask_phone": (
            "STRING",
            "STRING",
            f"CASE WHEN {pii} THEN v ELSE concat('{PHONE_MASK}', right(regexp_replace(v, '[^0-9]', ''), 4)) END",
        ),
        "mask_revenue": ("DECIMAL(10,2)", "DECIMAL(10,2)", f"CASE WHEN {finance} THEN v ELSE NULL END"),
        "filter_by_region": ("STRING", "BOOLEAN", f"{admin} OR {in_region}"),
    }
    for name, (takes, gives, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v {takes}) RETURNS {gives} RETURN {body}")
    return list(bodies)
