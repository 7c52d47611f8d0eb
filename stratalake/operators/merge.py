"""Keyed upsert, insert-if-absent, conditional update and last-change-wins application.

All return the new content of the target as a DataFrame; `keyed` stores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.dedup import content_order, latest_per_key


class DuplicateSourceKeys(ValueError):
    """The source of a merge holds a key more than once."""


def require_unique(df: DataFrame, keys: list[str], what: str = "source") -> None:
    """Raise when a non-NULL key occurs twice (pre-aggregated count over the keys only)."""
    twice = df.dropna(subset=keys).groupBy(*keys).count().where("count > 1")
    found = twice.take(1)
    if found:
        raise DuplicateSourceKeys(f"{what} has more than one row for key {tuple(found[0])[:-1]}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Update all columns of matched rows, insert the rest.

    The anti join touches the target once; a small source is broadcast by its size, so the
    target is not shuffled. New source columns appear as NULL in untouched rows.
    """
    if check:
        require_unique(source, keys)
    kept = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert the source rows whose key is absent; matched rows stay as they are."""
    new = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """Set columns in the rows that meet the condition; NULL conditions do not."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c) for c in df.columns]
    )


def apply_changes(
    changes: DataFrame,
    keys: list[str],
    sequence_by: str,
    except_columns: list[str] = (),
    tie_breakers: list[Column] | None = None,
) -> DataFrame:
    """Type-1 result of a change feed: the row with the highest sequence per key.

    Late rows with a lower sequence lose whatever their position in the feed. Equal
    sequences are settled by the given columns, or by the whole row.
    """
    lead = F.col(sequence_by).desc_nulls_last()
    order = [lead, *tie_breakers] if tie_breakers else content_order(changes, [lead], (*keys, sequence_by))
    return latest_per_key(changes, keys, order).drop(*except_columns)
