"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Rows are dealt to source blocks by a hash of the document.
2. One small matrix says how many rows each source block sends to each shard: it is drawn from the
   multivariate hypergeometric law with the blocks' and the shards' sizes as margins, so it has the
   law of a uniformly random permutation. Only the blocks' counts meet on the driver: one number for
   each ``BLOCK_ROWS`` rows.
3. Each block permutes its rows and sends consecutive runs to the shards; each shard permutes what
   it received. Both permutations are sorts by a keyed hash of stored columns,
   so a lost executor's work is recomputed alike.

The row path holds DataFrame functions only. Null texts count as empty; a null ``doc_id`` is
hashed like any value; rows that repeat are told apart by their place in the input; very long texts are measured whole
(only their size and checksum travel); extra columns are left behind, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm._common import shared_dir, written

N_SHARDS = 40
OVERHEAD = 16
LEAST_BLOCKS = 64
BLOCK_ROWS = 1 << 20  # rows that one task permutes, on average
REACH = 14


def shard_sizes(n: int, shards: int) -> list[int]:
    """As equal as integers allow: they differ by one at most."""
    return [n // shards + (j < n % shards) for j in range(shards)]


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int) -> np.ndarray:
    """How many rows each block sends to each shard; rows sum to ``block_rows``, columns to
    ``shard_rows``. Drawn block by block from what the shards still need."""
    rng, need = np.random.default_rng(seed), np.array(shard_rows, np.int64)
    out = np.zeros((len(block_rows), len(shard_rows)), np.int64)
    for i, n in enumerate(block_rows):
        left = n
        rest = int(need.sum())
        for j, want in enumerate(need):
            want = int(want)
            rest -= want
            if left == 0:
                break
            got = hypergeometric(rng, want, rest, left)
            out[i, j] = got
            left -= got
        need -= out[i]
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` items are good: the inverse of the distribution function, the same way at every size.

    The probabilities come from the ratios of neighbours, outwards from the mode. They are left out only where they are
    below a double's resolution: from ``REACH`` standard deviations on, a tail has less than exp(-REACH ** 2 / 3) of the whole (Hoeffding, Serfling).
    """
    least, most = max(0, drawn - bad), min(good, drawn)
    if least == most:
        return least
    n = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (n + 2), least), most)
    sd = math.sqrt(drawn * (good / n) * (bad / n) * ((n - drawn) / max(n - 1, 1)))
    reach = int(REACH * sd) + 64
    up = np.arange(mode, min(most, mode + reach), dtype=np.float64)  # from k to k + 1
    down = np.arange(mode, max(least, mode - reach), -1, dtype=np.float64)  # from k to k - 1
    above = np.cumprod((good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1)))
    below = np.cumprod(down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1)))
    weights = np.concatenate([below[::-1], [1.0], above])
    total = np.cumsum(weights)
    at = int(np.searchsorted(total, rng.random() * total[-1], "right"))
    return mode - len(below) + min(at, len(weights) - 1)


def shard_rows(
    docs: DataFrame,
    n_shards: int = N_SHARDS,
    seed: int = 20_24,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) under the law ``rows``.

    Blocks and cells (parts of a shard) are as many as keep one task's rows near ``block_rows``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    key = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), "doc_id", "size", "text_crc32")
    # the row's place in the input tells repeated rows apart, so that a hot group of them spreads over all blocks
    at = shared_dir(spark)
    dealt = written(narrow.withColumn("copy", F.monotonically_increasing_id()), f"{at}/rows")
    n = dealt.count()
    blocks = max(LEAST_BLOCKS, -(-n // block_rows))
    cells = max(1, -(-n // (n_shards * block_rows)))
    rows = dealt.withColumn("block", F.pmod(F.xxhash64(key("deal"), "copy"), F.lit(blocks)).cast("int"))
    counts = {r["block"]: r["n"] for r in rows.groupBy("block").agg(F.count("*").alias("n")).collect()}
    per_block = [counts.get(i, 0) for i in range(blocks)]
    matrix = communication_matrix(per_block, shard_sizes(sum(per_block), n_shards), seed)
    sends = spark.createDataFrame(
        [(i, [int(x) for x in np.cumsum(row)]) for i, row in enumerate(matrix)], "block int, upto array<long>"
    )
    local = Window.partitionBy("block").orderBy(F.xxhash64(key("local"), "copy"), "doc_id", "size", "text_crc32", "copy")
    sent = (
        rows.withColumn("rank", F.row_number().over(local) - 1)
        .join(sends, "block")  # one row per block: the planner broadcasts it while it is small
        .withColumn("shard", F.size(F.filter("upto", lambda x: x <= F.col("rank"))).cast("int"))
        .withColumn("cell", F.pmod(F.xxhash64(key("arrive"), "copy"), F.lit(cells)).cast("int"))
        .select("doc_id", "size", "text_crc32", "copy", "shard", "cell")
    )
    sent = written(sent, f"{at}/sent")
    # the second permutation: a random cell, then a random order in it; cells keep a large shard out of one task
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sent.groupBy("shard", "cell").agg(F.count("*").alias("n")).select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("shard", "cell").orderBy(F.xxhash64(key("permute"), "copy"), "doc_id", "size", "text_crc32", "copy")
    return (
        sent.withColumn("at", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "cell"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("base") + F.col("at")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
