"""A rule that goes through one ordered sequence row by row, run over the sequence's parts at the same time.

The rows of a key are range-partitioned by their order, so one key of any size lies in many parts. What a part does to whatever state comes in
is summed up; summaries of neighbours are put together ``FAN`` at a time, level by level, and the states go back down the same tree. Then every part
knows the state before its first row and is worked through alone. No task holds more than a part's rows or ``FAN`` summaries.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.sources.files import stored

FAN = 64


@dataclass(frozen=True)
class Rule:
    """``combine(first, second)`` of two summaries is the summary of both in turn; ``apply(state, summary)`` is the state after it."""

    summary: str  # types, as in a schema
    state: str
    start: dict
    combine: Callable[[dict, dict], dict]
    apply: Callable[[dict, dict], dict]


def in_parts(rows: DataFrame, key: str, order: list[str], parts: int | None = None) -> DataFrame:
    """The rows with their ``part``, ascending in (key, order); rows that are equal in these stay in one part."""
    by = [key, *order]
    dealt = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    return dealt.sortWithinPartitions(*by).withColumn("part", F.spark_partition_id().cast("long"))


def rows_of(table: pa.Table, order: list[str]) -> pa.Table:
    """A group's rows in order (groups arrive in none)."""
    return table.sort_by([(c, "ascending") for c in order])


def arrow(schema: str) -> pa.Schema:
    """For use on the driver, which knows the language of schemas."""
    return to_arrow_schema(StructType.fromDDL(schema))


def prefix_states(summaries: DataFrame, key: str, rule: Rule, at: str, fan: int = FAN) -> DataFrame:
    """(key, part, state): the state before each part of ``summaries`` (key, part, summary), a written table."""
    kind = summaries.schema[key].dataType.simpleString()
    up_schema, down_schema = f"{key} {kind}, node long, summary {rule.summary}", f"{key} {kind}, node long, state {rule.state}"
    up_types, down_types = arrow(up_schema), arrow(down_schema)

    def up(table: pa.Table) -> pa.Table:
        rows = rows_of(table, ["node"]).to_pylist()
        whole = rows[0]["summary"]
        for r in rows[1:]:
            whole = rule.combine(whole, r["summary"])
        return pa.Table.from_pylist([{key: rows[0][key], "node": rows[0]["node"] // fan, "summary": whole}], up_types)

    def down(table: pa.Table) -> pa.Table:
        rows, out = rows_of(table, ["node"]).to_pylist(), []
        state = rows[0].get("before") or rule.start
        for r in rows:
            out.append({key: r[key], "node": r["node"], "state": state})
            state = rule.apply(state, r["summary"])
        return pa.Table.from_pylist(out, down_types)

    level, lower = summaries.select(key, F.col("part").alias("node"), "summary"), []
    top = level.agg(F.max("node")).first()[0] or 0
    while top >= fan:
        lower.append(level)
        level = stored(level.groupBy(key, F.floor(F.col("node") / fan).alias("up")).applyInArrow(up, up_schema), f"{at}/{len(lower)}")
        top //= fan
    states = level.groupBy(key).applyInArrow(down, down_schema)
    for rows in reversed(lower):
        above = states.select(F.col(key).alias("__key"), F.col("node").alias("up"), F.col("state").alias("before"))
        below = rows.withColumn("up", F.floor(F.col("node") / fan)).join(above, "up").where(F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
        states = below.groupBy(key, "up").applyInArrow(down, down_schema)
    return states.withColumnRenamed("node", "part")


def with_state(rows: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """The rows of parts with the state that holds before their part."""
    known = states.select(F.col(key).alias("__key"), F.col("part").alias("__part"), "state")
    return rows.join(known, F.col(key).eqNullSafe(F.col("__key")) & (F.col("part") == F.col("__part"))).drop("__key", "__part")
