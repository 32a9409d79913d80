"""Concatenate and cut: all documents' tokens form one stream, cut into fixed windows.

Pass 1 encodes each partition, closes every document with an end id, and notes each document's
offset within its partition. The partitions' totals give, by a prefix sum, each partition's global
offset. Pass 2 cuts the stream at multiples of the window; a document over a boundary gives one
boundary record on each side. Every sequence but the last is full, so there is no padding elsewhere.

Null and empty texts hold the end id alone; repeated rows are packed each; an empty table gives no
pieces; other columns are left behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm._common import shared_dir, written
from docloom.llm.tokens import Encoder, batches

WINDOW = 2048
END_ID = 1


def encode(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(part, doc_id, local_start, n_tokens, width, ids): ids are little-endian, ``width`` bytes each."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, upto = TaskContext.get().partitionId(), 0
        encoder = Encoder(path)
        end = np.array([end_id], encoder.width).tobytes()
        width = len(end)
        for batch in parts:
            for i, j, texts in batches(batch.column(1)):
                ids = [x.astype(encoder.width).tobytes() + end for x in encoder.ids(texts)]
                n = np.fromiter((len(x) // width for x in ids), np.int64, len(ids))
                start = upto + np.cumsum(n) - n
                upto += int(n.sum())
                k = j - i
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, part, np.int32)), batch.column(0).slice(i, k), pa.array(start), pa.array(n), pa.array(np.full(k, width, np.int32)), pa.array(ids, pa.binary())],
                    ["part", "doc_id", "local_start", "n_tokens", "width", "ids"],
                )

    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(
        run, f"part int, doc_id {kind}, local_start long, n_tokens long, width int, ids binary"
    )


def partition_offsets(encoded: DataFrame) -> DataFrame:
    """(part, base): the prefix sum over partition totals, one row per partition of the input."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = encoded.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).cast("long").alias("base"))


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) per piece."""
    at = shared_dir(docs.sparkSession)
    encoded = written(encode(docs, path, end_id), f"{at}/encoded")
    bases = written(partition_offsets(encoded), f"{at}/bases")  # written, so the planner knows its true size
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            g0 = batch.column("base").to_numpy() + batch.column("local_start").to_numpy()
            n = batch.column("n_tokens").to_numpy()
            first = g0 // window
            pieces = (g0 + n - 1) // window - first + 1  # every document has its end id, so n > 0
            row = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            seq = first[row] + nth
            a = np.maximum(seq * window, g0[row])
            b = np.minimum((seq + 1) * window, (g0 + n)[row])
            start = a - g0[row]
            ids, width = batch.column("ids"), batch.column("width").to_numpy()
            out, crc = [], np.zeros(len(row), np.int64)
            last, raw = -1, np.zeros(0, np.uint32)
            for k, (r, s, length) in enumerate(zip(row.tolist(), start.tolist(), (b - a).tolist())):
                if r != last:
                    raw = np.frombuffer(ids[r].as_buffer(), np.uint16 if width[r] == 2 else np.uint32).astype("<u4")
                    last = r
                piece = raw[s : s + length]
                crc[k] = zlib.crc32(piece)
                if with_ids:
                    out.append(piece.astype(np.int64))
            cols = [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(b - a), pa.array(crc), pa.array(n[row]), pa.array(seq), pa.array(a - seq * window)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols, names = [*cols, pa.array(out, pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return encoded.join(bases, "part").mapInArrow(cut, schema + (", ids array<long>" if with_ids else ""))
