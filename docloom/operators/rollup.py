"""Grouping and merging in the order of first appearance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from docloom.functions import text as T

BITS = 31  # of a place's low part
LOW = (1 << BITS) - 1


def merged(values: Column, sep: str = "\n\n") -> Column:
    """Values of an ordered array, stripped, without empty ones and repeats, joined."""
    clean = F.filter(F.transform(values, T.strip), lambda x: x != "")
    return F.array_join(F.array_distinct(clean), sep)


def ordered(value: str | Column, *order: str) -> Column:
    """Aggregate: a group's values as an array by ``order``, which must tell all rows apart."""
    item = F.struct(*(F.col(o).alias(f"o{i}") for i, o in enumerate(order)), T.col(value).alias("v"))
    return F.transform(F.sort_array(F.collect_list(item)), lambda s: s.v)


def merge_groups(rows: DataFrame, keys: list[str], order: list[str], fields: dict[str, list[str]], sep: str | dict[str, str] = "\n\n", few: bool = False) -> DataFrame:
    """One row per key in the order of first appearance (column ``first_at``).

    ``fields`` maps an output column to the input fields merged into it: row by row, and within a row in the order given. ``sep`` joins values, by column if
    a dictionary is given. Rows of equal fields are counted out first, at the first place of each, so a group's task gets its different rows; they are
    ranked there, and each value keeps its first rank: what a group gathers is its distinct values. ``few``: keys have few rows each, and rows go to their key's task as they are.
    """
    inputs = list(dict.fromkeys(f for fs in fields.values() for f in fs))
    at, cell = [f"__o{i}" for i in range(len(order))], {f: f if few else f"__f{i}" for i, f in enumerate(inputs)}
    if few:
        placed, by = rows.select(*dict.fromkeys([*keys, *order, *inputs])), order
    else:
        named = rows.select(*keys, *(F.col(o).alias(n) for o, n in zip(order, at)), *(F.col(f).alias(n) for f, n in cell.items()))
        placed, by = _first_places(named, [*keys, *cell.values()], at), at
    ranked = placed.withColumn("__n", F.rank().over(Window.partitionBy(*keys).orderBy(*by)).cast("long"))
    value = lambda f: T.strip(F.coalesce(F.col(cell[f]), F.lit("")))
    step = max(map(len, fields.values()), default=1)
    entries = [F.struct(F.lit(c).alias("c"), (F.col("__n") * step + k).alias("at"), value(f).alias("v")) for c, fs in fields.items() for k, f in enumerate(fs)]
    mark = F.struct(F.lit("").alias("c"), F.col("__n").alias("at"), F.lit("").alias("v"))  # keeps groups without any value, and their first place
    kept = F.filter(F.array(mark, *entries), lambda e: F.when(e.c == "", F.col("__n") == 1).otherwise(e.v != ""))
    each = ranked.select(*keys, *(F.when(F.col("__n") == 1, F.col(o)).alias(n) for o, n in zip(by, at)), F.explode(kept).alias("__e"))
    least = [F.min(n).alias(n) for n in at]  # rows of rank 1 have one place
    once = each.groupBy(*keys, F.col("__e.c").alias("__c"), F.col("__e.v").alias("__v")).agg(F.min("__e.at").alias("__at"), *least)
    whole = once.groupBy(*keys).agg(*least, *(F.sort_array(F.collect_list(F.when(F.col("__c") == c, F.struct("__at", "__v")))).alias(c) for c in fields))
    whole = whole.withColumn("first_at", F.struct(*(F.col(n).alias(o) for o, n in zip(order, at))))
    joint = lambda c: sep[c] if isinstance(sep, dict) else sep
    return whole.select(*keys, "first_at", *(F.array_join(F.transform(c, lambda e: e["__v"]), joint(c)).alias(c) for c in fields))


def _first_places(rows: DataFrame, same: list[str], at: list[str]) -> DataFrame:
    """Rows equal in ``same`` counted out, each at its least place ``at``; a few of them may stay.

    The least of a struct is found by sorting all rows, so one or two whole numbers are put together as one: their low 31 bits make it up, and what
    stands above (null stays null) is grouped by. Such rows are aggregated by hash, and a task holds its different rows only.
    """
    types = {n: rows.schema[n].dataType for n in at}
    if not 0 < len(at) <= 2 or not all(isinstance(t, IntegralType) for t in types.values()):
        return rows.groupBy(*same).agg(F.min(F.struct(*at)).alias("__at")).select(*same, "__at.*")
    low = [F.coalesce(F.col(n).cast("long").bitwiseAND(F.lit(LOW)), F.lit(0)) for n in at]
    high = [F.shiftright(F.col(n).cast("long"), BITS).alias(f"__h{n}") for n in at]
    found = rows.groupBy(*same, *high).agg(F.min(low[0] if len(at) == 1 else F.shiftleft(low[0], BITS).bitwiseOR(low[1])).alias("__least"))
    lows = [F.shiftright("__least", BITS * (len(at) - 1 - i)).bitwiseAND(F.lit(LOW)) for i in range(len(at))]
    return found.select(*same, *(F.shiftleft(f"__h{n}", BITS).bitwiseOR(part).cast(types[n]).alias(n) for n, part in zip(at, lows)))


def capped_lines(c, n: int = 4) -> Column:
    """The first ``n`` lines that are not blank."""
    return F.array_join(F.slice(F.filter(F.split(T.col(c), "\n"), lambda x: T.strip(x) != ""), 1, n), "\n")
