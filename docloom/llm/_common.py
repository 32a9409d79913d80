"""Shared helpers: written tables in the cluster's shared folder, byte-level word hashing."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_SHARED_DIR = "/tmp/docloom-shared"  # local masters only (tests): driver and executors are one process there
HEAVY = 200  # a key counts as heavy from one part in so many of all rows, so there are at most so many of them


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder, with its scheme, below the checkpoint folder that driver and executors share. On a cluster that names none this fails."""
    named = spark.sparkContext._jsc.sc().getCheckpointDir()
    base = spark.conf.get("spark.checkpoint.dir", None) or (named.get() if named.isDefined() else None)
    if base is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = LOCAL_SHARED_DIR
    return qualified(spark, f"{base.rstrip('/')}/docloom-{uuid.uuid4().hex}")


def qualified(spark: SparkSession, at: str) -> str:
    """A path with the scheme and authority that Spark's own readers and writers give it."""
    path = _path(spark, at)
    return _filesystem(spark, path).makeQualified(path).toString()


def _path(spark: SparkSession, at: str):
    return spark._jvm.org.apache.hadoop.fs.Path(at)


def _filesystem(spark: SparkSession, path):
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables in the shared folder that no result reads any more."""
    for at in paths:
        path = _path(spark, at)
        _filesystem(spark, path).delete(path, True)


def written(df: DataFrame, at: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, and
    survives lost executors because the files are not on any executor's own disk."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def versions(spark: SparkSession, at: str) -> list[int]:
    """The numbers that name the finished tables in a folder; none without the folder."""
    path = _path(spark, at)
    fs = _filesystem(spark, path)
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path)]
    return [int(p.getName()) for p in found if p.getName().isdigit() and fs.exists(_path(spark, f"{p.toString()}/_SUCCESS"))]


def spread_join(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``facts``, a written table with one row per ``keys`` whose ``weight`` says how many rows have them.

    Keys that hold more than one part in ``HEAVY`` of all rows are at most ``HEAVY`` facts, whatever the data, and are broadcast; their
    rows are then dealt out by the hash of ``by`` and meet nothing in the shuffled join, which serves all other keys. Null keys meet nothing.
    """
    total = facts.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    heavy = F.coalesce(F.col(weight) * HEAVY > F.lit(total), F.lit(False))
    fields = [c for c in facts.columns if c not in keys]
    named = [f"{c}__f" for c in keys]
    light = facts.where(~heavy).select(*(F.col(c).alias(n) for c, n in zip(keys, named)), F.struct(*fields).alias("__light"), F.lit(0).cast("long").alias("__none"))
    big = facts.where(heavy).select(*(F.col(c).alias(n) for c, n in zip(keys, named)), F.struct(*fields).alias("__heavy"))
    same = lambda side: [side[n] == F.col(c) for c, n in zip(keys, named)]
    known = rows.join(F.broadcast(big), _all(same(big)), "left").drop(*named)  # at most HEAVY rows
    lone = F.when(F.col("__heavy").isNotNull() | ~_all([F.col(c).isNotNull() for c in keys]), F.xxhash64(F.lit(5), *by).bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    known = known.withColumn("__lone", lone.cast("long"))
    both = known.join(light, _all([*same(light), light["__none"] == F.col("__lone")]), "left").withColumn("__fact", F.coalesce("__heavy", "__light"))
    if how == "inner":
        both = both.where(F.col("__fact").isNotNull())
    return both.select(*rows.columns, *(F.col("__fact")[c].alias(c) for c in fields))


def _all(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def release(spark: SparkSession) -> None:
    """Let go of finished steps: Spark deletes a shuffle's files once the driver has collected the
    frames that made it, which else happens rarely."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty. No copy unless there are nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def by_bytes(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a single longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


# --- word and n-gram hashes -------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_table(base: np.uint64, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII punctuation and controls also separate words here; bytes of non-ASCII letters never do.
NO_LETTER = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a block of texts, as arrays over all its words.

    start, end: byte positions; first: for each text the index of its first word (one entry more
    than texts); hash: 64 bits per word, optionally of the word with A-Z lower-cased.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _SPACE):
        n = len(raw)
        if lower and n:
            raw = _LOWER[raw]
        self.raw = raw
        inside = np.zeros(n + 2, bool)
        if n:
            inside[1:-1] = ~separators[raw]
        starts = inside[1:] & ~inside[:-1]  # position i starts a word
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        starts[cuts[inside[cuts + 1]]] = True  # a text boundary also ends a word
        self.start = np.flatnonzero(starts[:n])
        ends = ~inside[1:] & inside[:-1]
        ends[cuts[inside[cuts]]] = True
        self.end = np.flatnonzero(ends[: n + 1])
        self.first = np.searchsorted(self.start, offsets)
        if n:
            power, inverse = _power_table(_BASE, "up", n), _power_table(_INVERSE, "down", n)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
            self.hash = mix((sums[self.end] - sums[self.start]) * inverse[self.start])
        else:
            self.hash = np.zeros(0, np.uint64)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, size: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words (also those across texts: see the mask), and
        whether each run lies within one text."""
        h, m = self.hash, len(self.hash) - size + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        if size > 8:
            at = np.arange(m)
            return self.spans(at, at + size, seed), self.whole(size)
        k = np.uint64(((2 * seed + 1) * int(_BASE) | 1) % (1 << 64))
        out = np.zeros(m, np.uint64)
        for i in range(size):
            out *= k
            out += h[i : i + m]
        return mix(out), self.whole(size)

    def spans(self, a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
        """Hashes of the word runs [a, b), in which the length counts."""
        n = len(self.hash)
        base = np.uint64(pow(int(_BASE), 2 * seed + 1, 1 << 64))
        power = _power_table(base, f"up{seed}", max(n, 1))
        inverse = _power_table(np.uint64(pow(int(base), -1, 1 << 64)), f"down{seed}", max(n, 1))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(self.hash + np.uint64(seed)) * power[:n], out=sums[1:])
        return mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))

    def whole(self, size: int) -> np.ndarray:
        m = max(len(self.hash) - size + 1, 0)
        text = np.repeat(np.arange(len(self.first) - 1), self.counts())
        return text[:m] == text[size - 1 :][:m]
