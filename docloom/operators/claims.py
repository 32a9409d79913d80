"""Claimed values against a source set of any size: which claims the source does not hold.

A Bloom filter over the source's values, made piece by piece in tasks, says of most invented values at once that they are invented. What may be known
is looked up exactly: frequent values once each, by a small table whose size is bounded by how frequent they are, all others by a join on the value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.sources.files import stored

FILTER_BYTES = 16 << 20  # a source too large for a filter of this size does without one
BITS = 12  # of the filter, for each value
HASHES = 4
PIECE = 1 << 16  # bytes of the filter that one group puts together
HOT = 1000  # a value is frequent from one part in so many of all claims, so there are at most so many


def bit_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places of each 64-bit hash in a filter of a power of two of bits, a row per hash function."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(HASHES)]).astype(np.int64)


def value_filter(values: DataFrame, value: str, size: int = FILTER_BYTES) -> np.ndarray | None:
    """The filter's bytes over a column's values, at most ``size``; None for a source that it could not tell apart."""
    n = values.agg(F.approx_count_distinct(value)).first()[0]
    bits = 1 << max(10, int(n * BITS - 1).bit_length()) if n else 1 << 10
    if bits > size * 8:
        return None

    def mark(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(bits // 8, np.uint8)
        for part in parts:
            at = bit_places(part.column(0).to_numpy(), bits).ravel()
            np.bitwise_or.at(mine, at >> 3, (1 << (at & 7)).astype(np.uint8))
        for k in range(0, len(mine), PIECE):
            if mine[k : k + PIECE].any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([mine[k : k + PIECE].tobytes()], pa.binary())], ["piece", "held"])

    def put_together(table: pa.Table) -> pa.Table:
        held = np.bitwise_or.reduce([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("held")])
        return pa.table({"piece": table.column("piece")[:1], "held": pa.array([held.tobytes()], pa.binary())})

    pieces = values.where(F.col(value).isNotNull()).select(F.xxhash64(value).alias("h")).mapInArrow(mark, "piece long, held binary").groupBy("piece").applyInArrow(put_together, "piece long, held binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in pieces.toLocalIterator():  # no more than ``size`` bytes in all
        out[r.piece : r.piece + len(r.held)] = np.frombuffer(r.held, np.uint8)
    return out


def checked(claims: DataFrame, ids: list[str], value: str, source: DataFrame, source_value: str, at: str, size: int = FILTER_BYTES) -> DataFrame:
    """The claims (ids, value) with ``known``: whether the source holds the value. ``at``: a fresh folder. Null values are never known; repeats stay."""
    spark = claims.sparkSession
    values = stored(source.select(F.col(source_value).alias("__v")).where("__v is not null").distinct(), f"{at}/source")
    held = value_filter(values, "__v", size)
    maybe = F.col(value).isNotNull()
    if held is not None:
        shared = spark.sparkContext.broadcast(held)

        @F.pandas_udf("boolean")
        def may_hold(hashes: pd.Series) -> pd.Series:
            bits = shared.value
            at = bit_places(hashes.to_numpy(np.int64), len(bits) * 8)
            return pd.Series((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(0))

        maybe = maybe & may_hold(F.xxhash64(value))
    rows = stored(claims.select(*ids, value, F.coalesce(maybe, F.lit(False)).alias("__maybe")), f"{at}/claims")
    counts = rows.where("__maybe").groupBy(value).agg(F.count("*").alias("n"))
    hot = stored(counts.where(F.col("n") * HOT > F.lit(rows.count())).select(F.col(value).alias("__hot")), f"{at}/hot")
    known_hot = hot.join(values, F.col("__hot") == F.col("__v"), "left").select("__hot", F.col("__v").isNotNull().alias("__known"))
    told = rows.join(F.broadcast(known_hot), F.col(value) == F.col("__hot"), "left")  # HOT rows at most
    # what is settled meets nothing in the join
    asked = F.when(F.col("__maybe") & F.col("__hot").isNull(), F.col(value))
    light = values.select(F.col("__v").alias("__light"))
    settled = F.when(asked.isNull(), F.xxhash64(*ids)).otherwise(0)
    both = told.withColumns({"__asked": asked, "__salt": settled}).join(light.withColumn("__none", F.lit(0).cast("long")), (F.col("__asked") == F.col("__light")) & (F.col("__salt") == F.col("__none")), "left")
    known = F.coalesce(F.col("__known"), F.lit(False)) | F.col("__light").isNotNull()
    return both.select(*ids, value, known.alias("known"))
