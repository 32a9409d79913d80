"""Field blocks in texts that are given as line rows: the blocks of ``blocks.chunk_blocks`` without a text in one cell.

Only lines that hold a mark are looked at for pairing; an opening mark meets the last closing mark of its id, by place, and the lines between
come from the join of line ranges. Blocks may hold other blocks, share lines with them, or stay unclosed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators.blocks import CLOSE, OPEN
from docloom.operators.intervals import range_texts


def marks(lines: DataFrame, key: str, number: str, line: str, opening: str = OPEN, closing: str = CLOSE) -> DataFrame:
    """(key, line_no, at, to, size, mark): every mark with its characters before and up to its end, and those of its line."""
    both = f"(?:{opening})|(?:{closing})"
    x = F.col(line)
    held = lines.where(x.rlike(both)).select(F.col(key), F.col(number).cast("long").alias("line_no"), F.length(x).alias("size"), F.split(x, both, -1).alias("pieces"), T.extract_all(line, both).alias("found"))
    long = lambda a: F.aggregate(F.transform(a, F.length), F.lit(0), lambda n, m: n + m)

    def placed(mark: Column, k: Column) -> Column:
        at = long(F.slice("pieces", F.lit(1), k + 1)) + long(F.slice("found", F.lit(1), k))
        return F.struct(at.alias("at"), (at + F.length(mark)).alias("to"), mark.alias("mark"))

    return held.select(key, "line_no", "size", F.inline(F.transform("found", placed)))


def line_blocks(lines: DataFrame, key: str, number: str = "line_no", line: str = "line", opening: str = OPEN, closing: str = CLOSE) -> DataFrame:
    """(key, first_line, at, last_line, chunk_id, block_hash, start_line, end_line, body) of each opening mark whose id is closed later; ``at``: its place in its line.

    Lines are numbered within a key (null keys hold no blocks); line numbers in marks that are too long are null."""
    found = marks(lines, key, number, line, opening, closing)
    group = lambda k: F.regexp_extract("mark", opening, k)
    opens = found.where(F.col("mark").rlike(opening)).select(
        key, F.col("line_no").alias("first_line"), "at", F.col("to").alias("__skip"), group(1).alias("chunk_id"), group(2).alias("block_hash"), T.integer(group(3)).alias("start_line"), T.integer(group(4)).alias("end_line")
    )
    closes = found.where(F.col("mark").rlike(closing)).groupBy(key, F.regexp_extract("mark", closing, 1).alias("chunk_id")).agg(F.max(F.struct("line_no", "at", "size")).alias("__last"))
    paired = opens.join(closes, [key, "chunk_id"]).where(F.struct("__last.line_no", "__last.at") > F.struct("first_line", "at"))
    pairs = paired.select(*opens.columns, F.col("__last.line_no").alias("last_line"), (F.col("__last.size") - F.col("__last.at")).alias("__drop"))
    ids = [key, "first_line", "at"]
    texts = range_texts(pairs.select(*ids, "last_line"), lines, key, ids, "first_line", "last_line", number, line).select(*ids, "text")
    body = F.substring(F.col("text"), F.col("__skip") + 1, F.length("text") - F.col("__skip") - F.col("__drop"))
    return pairs.join(texts, ids).select(key, "first_line", "at", "last_line", "chunk_id", "block_hash", "start_line", "end_line", body.alias("body"))
