"""Column quality: fill rates, shares, schema and pattern checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T


def fill_rates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, filled, rows, rate) by one pass; null and blank count as empty."""
    filled = lambda c: F.coalesce(T.strip(F.col(c).cast("string")) != "", F.lit(False))
    one = rows.agg(F.count("*").alias("rows"), *(F.count_if(filled(c)).alias(c) for c in columns))
    long = one.unpivot(["rows"], columns, "column", "filled")
    return long.select("column", "filled", "rows", F.when(F.col("rows") == 0, 0.0).otherwise(F.col("filled") / F.col("rows")).alias("rate"))


def below_floor(rates: DataFrame, floors: dict[str, float]) -> DataFrame:
    floor = F.create_map(*(F.lit(x) for kv in floors.items() for x in kv))
    return rates.withColumn("floor", F.try_element_at(floor, F.col("column"))).where("rate < floor")


def value_shares(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, share); one scan: the total is the sum of the groups' counts, joined back as one row."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("value", "n", (F.col("n") / F.col("total")).alias("share"))  # one row


def empty_cells(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing) for identity columns."""
    rates = fill_rates(rows, columns)
    return rates.select("column", (F.col("rows") - F.col("filled")).alias("missing"))


def schema_problems(rows: DataFrame, expected: list[str], forbidden: list[str] = ()) -> list[str]:
    out = [] if rows.columns == list(expected) else [f"columns differ: {rows.columns}"]
    return out + [f"forbidden column: {c}" for c in rows.columns if c in set(forbidden)]


def within(values: Column, allowed: list[str]) -> Column:
    """All values of an array are among the allowed ones."""
    return F.size(F.array_except(values, F.array(*map(F.lit, allowed)))) == 0


def apart(values: Column, others: Column) -> Column:
    return ~F.arrays_overlap(values, others)


def odd_parents(rows: DataFrame, column: str, pattern: str, allowed: list[str] = ()) -> DataFrame:
    return rows.where(~F.col(column).rlike(pattern) & ~F.col(column).isin(list(allowed)))


def floor_percent(part, whole):
    """Whole percent rounded down, 0 when there is nothing."""
    part, whole = T.col(part), T.col(whole)
    return F.when(whole == 0, F.lit(0)).otherwise(F.floor(part * 100 / whole)).cast("long")
