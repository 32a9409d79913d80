"""Summaries of the chunk index by manual and in all, from one scan: tasks keep counts and small heaps, which are merged."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP, PREVIEW = 5, 6
HELD = 20_000  # manuals that a task sums up before it lets its partial sums go
_TOP = "array<struct<away:bigint,place:bigint,chunk_id:string,codes:array<string>>>"
_MEASURES = ("char_count", "table_count", "codes")


def summaries(chunks: DataFrame, key: str, place: str, top: int = TOP, preview: int = PREVIEW) -> DataFrame:
    """(key, all_manuals, chunks, oversized, least, greatest and floor of the mean of sizes, tables and codes, largest): a row per manual and one for all.

    ``largest``: the ``top`` oversized chunks by size, then by ``place`` and id, with their first ``preview`` codes. Null sizes count as zero, null codes as none."""
    kind = chunks.schema[key].dataType.simpleString()
    names = [f"{f}_{m}" for m in _MEASURES for f in ("min", "max", "sum")]
    schema = f"{key} {kind}, chunks long, oversized long, {', '.join(f'{n} long' for n in names)}, largest {_TOP}"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def let_go() -> pa.RecordBatch:
            rows = [(k, *s[:-1], [{"away": -n, "place": -p, "chunk_id": c[0], "codes": c[1]} for n, p, c in sorted(s[-1], reverse=True)]) for k, s in held.items()]
            columns = list(zip(*rows)) if rows else [[]] * (len(names) + 4)
            held.clear()
            types = [key_type, *[pa.int64()] * (len(names) + 2), pa.list_(pa.struct([("away", pa.int64()), ("place", pa.int64()), ("chunk_id", pa.string()), ("codes", pa.list_(pa.string()))]))]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], [key, "chunks", "oversized", *names, "largest"])

        key_type = pa.null()
        for part in parts:
            key_type = part.column(0).type
            for k, size, tables, n, large, at, name, codes in zip(*(part.column(i).to_pylist() for i in range(part.num_columns))):
                s = held.get(k)
                if s is None:
                    if len(held) >= HELD:
                        yield let_go()
                    s = held[k] = [0, 0, *[None, None, 0] * 3, []]
                s[0] += 1
                for i, x in ((2, size), (5, tables), (8, n)):
                    s[i] = x if s[i] is None else min(s[i], x)
                    s[i + 1] = x if s[i + 1] is None else max(s[i + 1], x)
                    s[i + 2] += x
                if large:
                    s[1] += 1
                    entry = (size, -at, _Last((name, codes)))
                    if len(s[-1]) < top:
                        heapq.heappush(s[-1], entry)
                    elif entry > s[-1][0]:
                        heapq.heapreplace(s[-1], entry)
        if held:
            yield let_go()

    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    codes = F.coalesce("codes", F.array().cast("array<string>"))
    given = chunks.select(key, zero("char_count"), zero("table_count"), F.size(codes).cast("long").alias("n"), F.coalesce("oversized", F.lit(False)).alias("oversized"), F.col(place).cast("long").alias("place"), "chunk_id", F.slice(codes, 1, preview).alias("codes"))
    partial = given.mapInArrow(run, schema)
    measures = [f(F.col(f"{n}_{m}")).alias(f"{n}_{m}") for m in _MEASURES for n, f in (("min", F.min), ("max", F.max), ("sum", F.sum))]
    merged = partial.groupingSets([[F.col(key)], []], F.col(key)).agg(F.grouping(F.col(key)).alias("all_manuals"), F.sum("chunks").alias("chunks"), F.sum("oversized").alias("oversized"), *measures, F.slice(F.sort_array(F.flatten(F.collect_list("largest"))), 1, top).alias("largest"))  # top entries of each task
    means = [F.floor(F.col(f"sum_{m}") / F.col("chunks")).alias(f"avg_{m}") for m in _MEASURES]
    return merged.where("chunks is not null").select(key, (F.col("all_manuals") == 1).alias("all_manuals"), "chunks", "oversized", *(f"{f}_{m}" for m in _MEASURES for f in ("min", "max")), *means, F.transform("largest", lambda x: F.struct(x.chunk_id, (-x.away).alias("char_count"), x.codes)).alias("largest"))


class _Last(tuple):
    """Orders the other way round: of chunks that tie, the one with the smaller id is the larger entry."""

    def __new__(cls, pair):
        return super().__new__(cls, pair)

    def __lt__(self, other):
        return self[0] > other[0]

    def __gt__(self, other):
        return self[0] < other[0]
