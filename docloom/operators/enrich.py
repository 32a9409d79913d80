"""Dimension lookups with priority, and referential checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def override_lookup(rows: DataFrame, sub_key: str, parent_key: str, subs: DataFrame, parents: DataFrame, columns: list[str]) -> DataFrame:
    """Whole-row override: the sub-code's row if there is one, else the parent's, else empty strings.

    ``subs`` and ``parents`` hold ``key`` and ``columns``. Both joins are left to the optimizer, which broadcasts a dimension
    only where its size is known to be small.
    """
    packed = lambda d, name: d.select(F.col("key").alias(f"__{name}_key"), F.struct(*columns).alias(f"__{name}"))
    out = rows.join(packed(subs, "sub"), F.col(sub_key) == F.col("__sub_key"), "left").join(packed(parents, "parent"), F.col(parent_key) == F.col("__parent_key"), "left")
    row = F.coalesce("__sub", "__parent")
    return out.withColumns({c: F.coalesce(row[c], F.lit("")) for c in columns}).drop("__sub_key", "__sub", "__parent_key", "__parent")


def orphans(facts: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Fact rows whose key the dimension lacks."""
    return facts.join(dimension.select(F.col(dimension_key).alias(key)), key, "left_anti")


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by ``order``: a later record replaces an earlier one."""
    whole = F.struct(*order, *(c for c in rows.columns if c not in order))
    return rows.groupBy(key).agg(F.max(whole).alias("__row")).select("__row.*").select(*rows.columns)
