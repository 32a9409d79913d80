"""Line ranges joined with line rows: source text by manual and interval, however long a manual and however many ranges overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BIN = 64


def range_texts(ranges: DataFrame, lines: DataFrame, key: str, ids: list[str], start: str, end: str, number: str = "line_no", line: str = "line", size: int = BIN) -> DataFrame:
    """(ids, n_lines, text): the lines numbered ``start`` to ``end`` (from 1, both included) of each range's manual, joined by line feeds in order.

    Lines are gathered into bins of ``size`` numbers; a range, cut to the numbers its manual has, meets the bins it touches by equality, its
    two edge bins are trimmed, and its bins are put together in order. Lines are copied once per range that holds them, never a whole manual. A bin that
    many ranges touch is one row against many, which adaptive execution splits. Ranges that hold no line, are turned round or null, and those of an
    unknown or null manual, come back with no lines and an empty text; ``ids`` must tell ranges apart, null ids are equal. Null lines count as empty.
    """
    place = lambda c: F.floor((F.col(c) - 1) / size)
    entry = F.struct(F.col(number).cast("long").alias("number"), F.coalesce(F.col(line), F.lit("")).alias("line"))
    numbered = lines.where(F.col(key).isNotNull() & F.col(number).isNotNull())
    bins = numbered.groupBy(F.col(key).alias("__key"), place(number).alias("__bin")).agg(F.sort_array(F.collect_list(entry)).alias("__lines"))
    limits = numbered.groupBy(F.col(key).alias("__key")).agg(F.min(number).alias("__least"), F.max(number).alias("__most"))
    asked = ranges.select(*ids, F.col(key).alias("__of"), F.col(start).cast("long").alias("__from"), F.col(end).cast("long").alias("__to")).where("__from is not null and __to is not null")
    cut = asked.join(limits, F.col("__of") == F.col("__key")).select(*ids, "__of", F.greatest("__from", "__least").alias("__from"), F.least("__to", "__most").alias("__to")).where("__from <= __to")
    touched = cut.withColumn("__at", F.explode(F.sequence(place("__from"), place("__to"))))
    met = touched.join(bins, (F.col("__of") == F.col("__key")) & (F.col("__at") == F.col("__bin")))
    inside = F.filter("__lines", lambda x: x.number.between(F.col("__from"), F.col("__to")))
    trimmed = met.select(*ids, "__at", F.transform(inside, lambda x: x.line).alias("__part")).where(F.size("__part") > 0)
    pieces = trimmed.select(*ids, F.struct("__at", F.array_join("__part", "\n").alias("text"), F.size("__part").alias("n")).alias("__piece"))
    whole = pieces.groupBy(*ids).agg(F.sort_array(F.collect_list("__piece")).alias("__pieces"))
    told = whole.select(*(F.col(c).alias(f"__id{k}") for k, c in enumerate(ids)), F.aggregate("__pieces", F.lit(0), lambda n, p: n + p.n).cast("long").alias("n_lines"), F.array_join(F.transform("__pieces", lambda p: p.text), "\n").alias("text"))
    same = [F.col(c).eqNullSafe(F.col(f"__id{k}")) for k, c in enumerate(ids)]
    out = ranges.select(*ids).distinct().join(told, same, "left")
    return out.select(*ids, F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("text", F.lit("")).alias("text"))
